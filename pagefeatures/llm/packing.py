"""Pattern packing: few-document length patterns fitted by non-negative least squares.

Texts become token ids, each with an end id; only a document longer than a
sequence is cut.  Packing needs no more than the histogram of piece lengths
(at most ``capacity`` numbers, so the driver's work does not grow with the
corpus):

1. lengths fall into ``classes`` of equal width (but for rounding); every pattern of up to
   ``depth`` classes that fills a sequence is enumerated;
2. repeat counts of the patterns are fitted to the histogram of classes by
   non-negative least squares (active set), rounded down, and each repeat
   takes the longest pieces left in its classes, the last as long as fits;
3. the residual pieces are packed longest first into the fullest sequence
   that still has room, in bulk: equal sequences and equal lengths are
   handled as one number.

The result is a table of runs, one for each (pattern, length).  Pieces find
their place by their rank among the pieces of the same length: ranks are
local to a task, plus the running counts of the tasks before it.  No length
is ever gathered into one task, however common.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import ROWS, byte_alphabet
from .common import WordCache, ship_code, stored, whole_text


class ChunkTokenizer:
    """Ids by the tokenizers library, with a cache of blank-separated chunks.

    The vocabulary drops white space and never merges across it, so the ids
    of a text are those of its chunks in a row; a chunk's pre-tokens go
    through the library's own BPE model, or, if the chunk is anything but
    letters and punctuation of plain words, through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self.plain = regex.compile(r"\p{L}+|[.,!?;:()]+")
        self.words = WordCache(self._word)
        self.chunks = WordCache(self._chunk)

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else "".join(map(self.alphabet.get, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        if text.isalpha():
            return self.words[text]
        words = self.plain.findall(text)
        if sum(map(len, words)) == len(text):
            return b"".join(map(self.words.__getitem__, words))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.chunks.__getitem__, text.split(" "))) if text else b""


@lru_cache(maxsize=4)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer for each vocabulary and Python worker."""
    return ChunkTokenizer(path)


def cut_pieces(df: DataFrame, vocab_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
               text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenize every text and cut what is longer than a sequence.

    Columns: id_col, piece, start, length, ids_crc32, part and rank (the
    task, and the piece's rank among its pieces of that length), and with
    ``keep_ids`` the ids (binary, little-endian unsigned 32-bit).
    """
    ship_code(df.sparkSession)
    id_type = df.schema[id_col].dataType
    schema = (f"`{id_col}` {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long, "
              "part int, rank long") + ", ids binary" * keep_ids

    def run(batches):
        tool, part = chunk_tokenizer(vocab_path), TaskContext.get().partitionId()
        seen, end, step = np.zeros(capacity + 1, np.int64), array("I", [end_id]).tobytes(), capacity * 4
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                texts = batch.column(1).slice(at, ROWS).to_pylist()
                row, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
                for k, text in enumerate(texts):
                    ids = tool.encode(text) + end
                    for i, a in enumerate(range(0, len(ids), step)):
                        cut = ids[a:a + step]
                        n = len(cut) // 4
                        row.append(at + k), piece.append(i), start.append(a // 4), length.append(n)
                        crc.append(zlib.crc32(cut)), rank.append(seen[n])
                        seen[n] += 1
                        if keep_ids:
                            kept.append(cut)
                arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                          *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                          pa.array([part] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.array(kept, pa.binary())] * keep_ids,
                    names=[id_col, "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * keep_ids)

    return df.select(F.col(id_col), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def class_patterns(classes: int, depth: int) -> np.ndarray:
    """Every pattern of 1 to ``depth`` classes, largest first, whose classes add up to ``classes``.

    Class c holds the lengths over (c-1)/classes and up to c/classes of a
    sequence, rounded down, so such a pattern always fits.  Unused places are 0.
    """
    found = [(classes,)]
    partial = [(a,) for a in range(1, classes)]
    for _ in range(depth - 1):
        partial = [(*p, c) for p in partial for c in range(1, min(p[-1], classes - sum(p)) + 1)]
        found += [p for p in partial if sum(p) == classes]
        partial = [p for p in partial if sum(p) < classes]
    return np.array([(*p, *[0] * (depth - len(p))) for p in found])


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = 600) -> np.ndarray:
    """Repeat counts x >= 0 with least squared error of pattern contents against the histogram.

    Lawson and Hanson's active set: the pattern with the steepest descent
    joins the set, the set is solved, patterns that would turn negative
    leave it.  At most as many patterns as classes stay above zero.
    """
    target = histogram.astype(float)
    scale = max(target.max(), 1.0)
    target = target / scale
    contents = np.zeros((len(target), len(patterns)))
    for place in patterns.T:
        used = place > 0
        np.add.at(contents, (place[used] - 1, np.flatnonzero(used)), 1.0)
    x, active = np.zeros(len(patterns)), np.zeros(len(patterns), bool)
    for _ in range(steps):
        gain = contents.T @ (target - contents @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solved = np.linalg.lstsq(contents[:, chosen], target, rcond=None)[0]
            if (solved > 1e-12).all():
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 1e-12
            now = x[chosen]
            ratio = now[low] / np.maximum(now[low] - solved[low], 1e-300)
            x[chosen] = np.maximum(now + ratio.min() * (solved - now), 0)
            x[chosen[low][ratio <= ratio.min()]] = 0
            active[chosen[x[chosen] <= 1e-12]] = False
            x[~active] = 0
            if not active.any():
                break
    return x * scale


def plan_sequences(histogram: dict[int, int], capacity: int = 4096, classes: int = 128,
                   depth: int = 3) -> list[tuple[int, list[tuple[int, int]]]]:
    """(repeats, [(length, pieces of it), ...]) that use up the histogram."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    limits = [c * capacity // classes for c in range(classes + 1)]
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    by_class = np.add.reduceat(np.append(left, 0), [n + 1 for n in limits])[:-1] if classes <= capacity else np.zeros(classes, np.int64)
    patterns = class_patterns(classes, depth)
    counts = np.floor(fit_counts(patterns, by_class) + 1e-9).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        need = int(counts[k])
        wanted = [int(c) for c in patterns[k] if c]
        while need > 0:
            # the longest pieces left in each class, the last one as long as still fits,
            # as often as all of them last
            got: list[int] = []
            for c in wanted:
                most = limits[c] if len(got) < len(wanted) - 1 else capacity - sum(got)
                length = next((n for n in range(most, limits[c - 1], -1) if left[n] > got.count(n)), 0)
                if not length:
                    break
                got.append(length)
            if len(got) < len(wanted):
                break
            runs = [(n, got.count(n)) for n in sorted(set(got), reverse=True)]
            times = min(need, *(int(left[n]) // m for n, m in runs))
            for n, m in runs:
                left[n] -= times * m
            groups.append((times, runs))
            need -= times
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    for times, runs in groups:
        room.setdefault(capacity - sum(n * m for n, m in runs), []).append((times, runs))
    for length in range(capacity, 0, -1):
        n = int(left[length])
        spaces = sorted(r for r in room if r >= length and room[r])
        for space in [*spaces, capacity]:
            if not n:
                break
            fit, queue = space // length, room.setdefault(space, [])
            if space == capacity and not queue:
                queue.append((-(-n // fit), []))
            while queue and n:
                times, runs = queue.pop()
                full = min(times, n // fit)
                if full:
                    room.setdefault(space - fit * length, []).append((full, [*runs, (length, fit)]))
                n -= full * fit
                if full < times:
                    rest = n if full * fit < times * fit and n < fit else 0
                    if rest:
                        room.setdefault(space - rest * length, []).append((1, [*runs, (length, rest)]))
                        n = 0
                    if times - full - bool(rest):
                        queue.append((times - full - bool(rest), runs))
    return [g for queue in room.values() for g in queue if g[1]]


def place_runs(sequences: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, pieces of it in a sequence, first sequence id, offset), by length and rank."""
    rows, used, base = [], {}, 0
    for times, runs in sequences:
        offset = 0
        for length, n in runs:
            first = used.get(length, 0)
            rows.append((length, first, n, base, offset))
            used[length] = first + n * times
            offset += n * length
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(df: DataFrame, vocab_path: str, capacity: int = 4096, end_id: int = 1, classes: int = 128, depth: int = 3,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens.

    Columns: id_col, piece, start, length, ids_crc32, sequence_id, offset,
    and with ``keep_ids`` the ids.  A null or empty text gives one piece with
    the end id alone, a repeated row is packed again, an empty table gives
    no rows.  Pieces of one length are interchangeable, so which of them
    shares a sequence with which others follows the order of input files.
    """
    spark = df.sparkSession
    pieces = stored(cut_pieces(df, vocab_path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    by_part = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = place_runs(plan_sequences(histogram, capacity, classes, depth))
    shared = spark.sparkContext.broadcast(table)  # bounded by the capacity, not by the corpus

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        runs = shared.value
        rank_bits = 44  # a length takes the bits above
        at = np.searchsorted((runs[:, 0] << rank_bits) + runs[:, 1], (length.to_numpy() << rank_bits) + rank.to_numpy(), "right") - 1
        _, first, n, base, offset = runs[at].T
        k = rank.to_numpy() - first
        return pd.DataFrame({"sequence_id": base + k // n, "offset": offset + k % n * length.to_numpy()})

    # as many rows as tasks x lengths: merged, never broadcast
    placed = (pieces.join(starts.hint("merge"), ["part", "length"])
              .withColumn("place", place("length", F.col("rank") + F.col("before"))))
    return placed.select(id_col, "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset",
                         *["ids"] * keep_ids)
