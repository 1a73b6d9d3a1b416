"""Cross-tokenizer alignment: where the tokens of two vocabularies end together.

A byte-level vocabulary (A) and a piece vocabulary (B) encode the same bytes.
The work on tokens is done on Arrow arrays, for some documents at a time:

1. the id lists are flattened, their parent indices tell the document, the
   vocabularies' byte lengths are taken by id, and segmented cumulative sums
   give every token's end in its document;
2. an Acero hash join of A's and B's tokens on (document, end) finds the
   shared ends; they cut the tokens into groups, and each links two tokens;
3. ``Table.group_by`` counts the linked id pairs of a chunk, a run of
   documents of bounded text; Spark merges the partial counts of all chunks.

A document needs the corpus-wide counts of its own links.  Its links are
therefore written as indexes into its chunk's list of pairs, and the counts go
back to the chunks: rows of (chunk, pair), never of (document, pair), and the
commonest pair has one row in a chunk.  Chunk and counts meet in a co-grouped
Arrow function, where sums are gathers by index.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import byte_alphabet
from .common import ship_code, small_batches, stored, whole_text

#: Text bytes of a chunk, and of the documents that a worker holds as arrays at once (or one document, if larger).
CHUNK_BYTES, BLOCK_BYTES = 16 << 20, 512 << 10
SPACE_MARK = "▁"
#: Words whose ids a worker keeps (two generations).
KEPT_WORDS = 60_000
#: White space at the start, a space at the end, or a space before white space (fixed values: the white space of Unicode).
ODD_SPACE = (r"(?:^| )(?:[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)")


class TwoTokenizers:
    """Ids of both vocabularies, and tables of their tokens' bytes, lengths and printed ids.

    A's file lists a byte-level vocabulary whose ids stand in the order of its
    merges, which is what ``tiktoken`` takes.
    """

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"] for t in spec["added_tokens"]}  # plain text here, so never an id
        ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.n_a, self.n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        a_bytes = [b""] * self.n_a
        for token, i in ranks.items():
            a_bytes[i] = token
        b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.n_b)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.lengths = [pc.cast(pc.binary_length(x), pa.int64()) for x in self.bytes]
        # printed ids: within A's side of a group, A's last; within B's side, B's last, B's last of a document
        ids = lambda n, end: [f"{i}{end}" for i in range(n)]
        self.printed = pa.array(ids(self.n_a, ",") + ids(self.n_a, "|") + ids(self.n_b, ",") + ids(self.n_b, ";")
                                + ids(self.n_b, ""), pa.large_string())
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    @staticmethod
    def _piece(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def _encoded(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Both encodings of space + word for each of different words, as 32-bit integers.

        Recent ones are kept, in two generations of bounded size.
        """
        found = [self.young.get(w) or self.old.get(w) for w in words]
        new = [w for w, x in zip(words, found) if x is None]
        made = {w: (array("i", self.a.encode_ordinary(" " + w)).tobytes(), array("i", b).tobytes()) if w else (b"", b"")
                for w, b in zip(new, self.b.encode(new, num_threads=1))}
        if len(self.young) + len(new) > KEPT_WORDS:
            self.old, self.young = self.young, {}
        self.young.update((w, x) for w, x in made.items() if len(w) <= 64)
        return [x or made[w] for w, x in zip(words, found)]

    def encode(self, texts: pa.Array) -> list[pa.ListArray]:
        """Ids of space + text in A, and in B, which adds the space itself; nothing for an empty text.

        Neither vocabulary joins bytes across a place where a space stands
        before anything but white space.  A text with no other spaces is
        split there, its words are a dictionary, and ids are taken by word.
        """
        marked = pc.match_substring(texts, SPACE_MARK)  # it comes back as a space, so such texts have no tokens
        whole = pc.match_substring_regex(texts, ODD_SPACE)
        cut = pc.if_else(marked, "", pc.if_else(whole, texts, pc.replace_substring(texts, " ", SPACE_MARK)))
        words = pc.split_pattern(cut, SPACE_MARK)
        coded = words.flatten().dictionary_encode()
        both = self._encoded(coded.dictionary.to_pylist())
        out = []
        for ids in ([x[k] for x in both] for k in (0, 1)):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            table = pa.ListArray.from_arrays(pa.array(starts_of(sizes), pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            taken = table.take(coded.indices)
            out.append(pa.ListArray.from_arrays(taken.offsets.take(words.offsets), taken.values))
        return out


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(maxsize=2)
def two_tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    """One pair for each pair of files and Python worker, with its cache."""
    return TwoTokenizers(a_path, b_path)


def spelled(lists: pa.ListArray, table: pa.Array, nothing) -> pa.Array:
    """The strings of each list's entries in ``table``, joined."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pc.cast(lists.offsets, pa.int64()), pc.take(table, lists.values)), nothing)


def token_ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """(key, id, at): each token's document and end in its bytes as one number, its id and its place in the flat list."""
    flat, doc = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
    upto = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.take(lengths, flat))])
    # segmented: less the sum at the end of the document before
    end = pc.subtract(upto.slice(1), pc.take(upto, pc.take(lists.offsets, doc)))
    return pa.table({"key": pc.add(pc.shift_left(doc, 32), end), "id": flat, "at": pa.array(np.arange(len(flat)))})


def align(tool: TwoTokenizers, texts: pa.Array) -> tuple[pa.Table, pa.Table]:
    """(one row a text: n_a, n_b, n_groups, n_links, groups; one row a link in the order of the text: a, b)."""
    lists = tool.encode(texts)
    spaced = pc.cast(pc.binary_join_element_wise("", texts, " "), pa.large_binary())
    fine = pc.and_(*[pc.equal(spelled(x, t, pa.scalar(b"", pa.large_binary())), spaced) for x, t in zip(lists, tool.bytes)])
    good = fine.to_numpy(zero_copy_only=False)
    if not good.all():  # the others have no tokens
        for k, x in enumerate(lists):
            sizes = x.value_lengths().to_numpy()
            lists[k] = pa.ListArray.from_arrays(pa.array(starts_of(np.where(good, sizes, 0)), pa.int32()),
                                                x.flatten().filter(pa.array(np.repeat(good, sizes))))
    n = [x.value_lengths().to_numpy().astype(np.int64) for x in lists]

    a, b = (token_ends(x, t) for x, t in zip(lists, tool.lengths))
    shared = a.join(b, "key", join_type="inner", right_suffix="_b", use_threads=False)
    shared = shared.take(pa.array(np.argsort(shared["at"].to_numpy())))
    n_links = np.bincount(shared["key"].to_numpy() >> 32, minlength=len(texts)).astype(np.int64)

    # each group prints as A's ids, then B's: a token moves behind the other side's tokens of the groups before
    last = [shared["at"].to_numpy(), shared["at_b"].to_numpy()]
    group = [np.repeat(np.arange(len(x)), np.diff(x, prepend=-1)) for x in last]
    before = [starts_of(np.diff(x, prepend=-1)) for x in last]
    kind = [np.zeros(len(x), np.int64) for x in (a, b)]
    kind[0][last[0]], kind[1][last[1]] = tool.n_a, tool.n_b
    kind[1][(np.cumsum(n[1]) - 1)[n[1] > 0]] = 2 * tool.n_b
    line = np.empty(len(a) + len(b), np.int64)
    line[np.arange(len(a)) + before[1][group[0]]] = a["id"].to_numpy() + kind[0]
    line[np.arange(len(b)) + before[0][group[1] + 1]] = b["id"].to_numpy() + kind[1] + 2 * tool.n_a
    groups = spelled(pa.ListArray.from_arrays(pa.array(starts_of(n[0] + n[1]), pa.int32()), pa.array(line)),
                     tool.printed, pa.scalar("", pa.large_string()))
    docs = pa.table({"n_a": n[0], "n_b": n[1], "n_groups": n_links, "n_links": n_links, "groups": groups})
    return docs, shared.select(["id", "id_b"]).rename_columns(["a", "b"])


def pack_codes(codes: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by significance of their bytes, compressed (frequent pairs have small numbers)."""
    return pa.compress(codes.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True) if len(codes) else b""


def unpack_codes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 4, "zstd", asbytes=True), np.uint8) if n else np.empty(0, np.uint8)
    return planes.reshape(4, -1).T.copy().view(np.uint32).ravel()


class Links:
    """The links of a chunk: its distinct pairs with their counts, and for each block its links as places among them.

    A link takes four bytes, and a pair sixteen, until the chunk is written.
    """

    def __init__(self):
        self.pairs, self.counts, self.blocks = pa.array([], pa.int64()), np.empty(0, np.int64), []

    def add(self, links: pa.Table) -> None:
        packed = (links["a"].to_numpy().astype(np.int64) << 32) + links["b"].to_numpy()
        coded = pa.array(packed).dictionary_encode()
        place = pc.index_in(coded.dictionary, self.pairs)
        new = place.is_null().to_numpy(zero_copy_only=False)
        place = pc.fill_null(place, 0).to_numpy().astype(np.uint32)
        place[new] = len(self.pairs) + np.arange(new.sum())
        self.pairs = pa.concat_arrays([self.pairs, coded.dictionary.filter(pa.array(new))])
        self.counts = np.concatenate([self.counts, np.zeros(new.sum(), np.int64)])
        indices = coded.indices.to_numpy()
        self.counts[place] += np.bincount(indices, minlength=len(place))
        self.blocks.append(place[indices])

    def by_count(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, n) of the pairs, the commonest first, then by a and b; and each pair's place in that order."""
        keys = self.pairs.to_numpy()
        order = np.lexsort((keys, -self.counts))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        return keys[order] >> 32, keys[order] & 0xFFFFFFFF, self.counts[order], rank


def aligned_chunks(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, keep_groups: bool) -> DataFrame:
    """Rows of documents and, at the end of each chunk, one row of its pairs (where ``pairs`` isn't null).

    Columns: chunk, id, n_a, n_b, n_groups, n_links, groups, codes (of the
    links, packed) and pairs (array of a, b, n; a code is a place in it).
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"chunk long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, "
              "pairs array<struct<a: int, b: int, n: long>>")
    pair_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))

    def rows_of(chunk: int, parts: list, links: Links) -> pa.RecordBatch:
        ids, docs = ([p[k] for p in parts] for k in range(2))
        a, b, count, rank = links.by_count()
        binary = [pack_codes(x) for d, codes in zip(docs, links.blocks)
                  for x in np.split(rank[codes], np.cumsum(d["n_links"].to_numpy())[:-1])]
        docs = pa.concat_tables(docs)
        n = docs.num_rows
        with_null = lambda x: pa.concat_arrays([x, pa.nulls(1, x.type)])
        pairs = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(count)], ["a", "b", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * (n + 1), pa.int64()), with_null(pa.concat_arrays(ids)),
             *[with_null(docs[c].combine_chunks()) for c in ("n_a", "n_b", "n_groups", "n_links")],
             with_null(pc.cast(docs["groups"], pa.string()).combine_chunks()), with_null(pa.array(binary, pa.binary())),
             pa.concat_arrays([pa.nulls(n, pair_type), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs).cast(pair_type)])],
            names=["chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "pairs"])

    def run(batches):
        tool, task = two_tokenizers(a_path, b_path), TaskContext.get().partitionId()
        parts, links, held, number = [], Links(), 0, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            block = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
            for at in np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else []:
                part = batch.slice(at, int(np.searchsorted(block, block[at], "right")) - int(at))
                docs, found = align(tool, part.column(1))
                if not keep_groups:
                    docs = docs.set_column(4, "groups", pa.array([x and hashlib.sha256(x.encode()).hexdigest() for x in docs["groups"].to_pylist()], pa.string()))
                parts.append((part.column(0), docs))
                links.add(found)
                held += int(sizes[block == block[at]].sum())
                if held >= CHUNK_BYTES:
                    yield rows_of(task << 32 | number, parts, links)
                    parts, links, held, number = [], Links(), 0, number + 1
        if parts:
            yield rows_of(task << 32 | number, parts, links)

    return df.select(F.col(id_col), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, code, count, best) of every chunk's pairs: the corpus-wide count, and whether it is its B id's highest."""
    pairs = (chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("code", "pair"))
             .select("chunk", "code", "pair.*"))
    counted = pairs.withColumn("count", F.sum("n").over(Window.partitionBy("a", "b")))
    highest = counted.groupBy("b").agg(F.max("count").alias("highest"))  # at most one row for each id of B: broadcast
    return (counted.join(F.broadcast(highest), "b")
            .select("chunk", "code", "count", (F.col("count") == F.col("highest")).alias("best")))


def align_tokenizers(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_groups: bool = True) -> DataFrame:
    """Align both encodings of every text, and look up how common its links are.

    Columns: id_col, n_a, n_b, n_groups, n_links, n_best (links whose pair is
    the most frequent of its B id in the corpus, ties included), count_sum
    (the counts of the links' pairs added up) and groups: ids of A and B by
    group, as "a1,a2|b1;a3|b2,b3", or with ``keep_groups`` off their SHA-256
    (for texts without tokens an empty string).

    A null or empty text has no tokens, nor has one that an encoding doesn't
    give back byte by byte; its numbers are 0.  A repeated row counts again, a
    null id stays null, an empty table gives no rows, other columns don't
    matter.  A worker holds a block of documents (512 KiB of text, or one longer
    text) as Arrow arrays, and for a chunk of them (16 MiB) four bytes a link.  Both files must be on every machine.
    """
    ship_code(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    with small_batches(df.sparkSession):
        chunks = stored(aligned_chunks(df, a_path, b_path, id_col, text_col, keep_groups), "aligned")

    def look_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
        n = counts.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        code = counts["code"].to_numpy()
        count[code], best[code] = counts["count"].to_numpy(), counts["best"].to_numpy()
        links = docs["n_links"].to_pylist()
        sums = []
        for data, k in zip(docs["codes"].to_pylist(), links):
            codes = unpack_codes(data, k)
            sums.append((int(best[codes].sum()), int(count[codes].sum())))
        out = [docs[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
        out += [pa.array([x[k] for x in sums], pa.int64()) for k in range(2)]
        return pa.table(out + [docs["groups"]], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    docs = chunks.where("pairs IS NULL").drop("pairs").withColumnRenamed("chunk", "of_chunk")
    rows = docs.groupBy("of_chunk").cogroup(pair_counts(chunks).groupBy("chunk")).applyInArrow(
        look_up, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return rows.withColumnRenamed("id", id_col)
