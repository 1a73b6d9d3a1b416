"""Byte-level BPE encoding and decoding by a contiguous rank array.

A text is split into pre-tokens; each is merged on its own.  For a short
word the part boundaries and the ranks of adjacent parts stand in two flat
lists: the scan finds the least rank (the leftmost of equal ones), one
boundary is deleted, and only the two neighbouring ranks are looked up
again.  The scan is quadratic in the word, which for words of a few bytes
is faster than a heap; words over ``SHORT`` bytes use a heap over a linked
list and the same merge order, so that a text of one huge word stays
n log n.

The vocabulary file (a public ``tokenizers`` JSON file) is a parameter and
is read once in every Python worker; on a cluster it must be present at that
path on every machine, as the tokenizers package puts it.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import WordCache, ship_code, whole_text

# The white space of Unicode, and the split pattern of the vocabulary.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

SHORT = 128
#: Rows that a worker holds as Python objects at once.
ROWS = 512
NONE = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for
    U+0100, U+0101 and so on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class RankEncoder:
    """Encodes and decodes with one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.split_special = regex.compile("|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.split = regex.compile(PATTERN)
        #: two white-space characters in a row, or the mark used below: such texts go to the full pattern
        self.odd = re.compile(r"\s\s|\x00")
        self.words = WordCache(self.merge)
        self.chunks = WordCache(self.encode_chunk)

    def merge(self, word: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        data = word.encode()
        parts = self._merge_short(data) if len(data) <= SHORT else self._merge_long(data)
        return array("I", [self.ids[p] for p in parts]).tobytes()

    def _merge_short(self, data: bytes) -> list[bytes]:
        ranks = self.ranks
        bounds = list(range(len(data) + 1))
        pair = lambda k: ranks.get((data[bounds[k]:bounds[k + 1]], data[bounds[k + 1]:bounds[k + 2]]), NONE)
        adjacent = [pair(k) for k in range(len(data) - 1)]
        while adjacent:
            least = min(adjacent)
            if least == NONE:
                break
            k = adjacent.index(least)
            del bounds[k + 1], adjacent[k]
            if k < len(adjacent):
                adjacent[k] = pair(k)
            if k:
                adjacent[k - 1] = pair(k - 1)
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _merge_long(self, data: bytes) -> list[bytes]:
        n, ranks = len(data), self.ranks
        end, before = [*range(1, n + 1)], [*range(-1, n - 1)]  # by a part's first byte: its end, the part before it
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get((data[i:i + 1], data[i + 1:i + 2]))) is not None]
        heapq.heapify(heap)

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (r := ranks.get((data[a:b], data[b:end[b]]))) is not None:
                heapq.heappush(heap, (r, a, b, end[b]))

        while heap:
            _, a, b, c = heapq.heappop(heap)
            if end[a] != b or b >= n or end[b] != c:
                continue  # a part of this pair has been merged meanwhile
            end[a], end[b] = c, -1
            if c < n:
                before[c] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        parts, a = [], 0
        while a < n:
            parts.append(data[a:end[a]])
            a = end[a]
        return parts

    def encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split.findall(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.special and self.split_special.search(text):
            out, at = [], 0
            for m in self.split_special.finditer(text):
                out += [self._plain(text[at:m.start()]), array("I", [self.special[m.group()]]).tobytes()]
                at = m.end()
            return b"".join([*out, self._plain(text[at:])])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if self.odd.search(text):
            return self.encode_chunk(text)
        # No two spaces in a row: a pre-token begins at every blank and on both sides of a line
        # break, so chunks cut there are encoded on their own, most of them from the cache.
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")))

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; ids outside the vocabulary give nothing."""
        tokens = self.tokens
        return b"".join([tokens.get(i, b"") for i in array("I", ids)]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> RankEncoder:
    """One encoder for each vocabulary and Python worker, with its caches."""
    return RankEncoder(path)


def encode_column(vocab_path: str):
    """Pandas UDF: text -> ids (binary, little-endian unsigned 32-bit)."""
    @F.pandas_udf("binary")
    def encode(texts):
        return texts.map(encoder(vocab_path).encode)
    return lambda col: encode(whole_text(col))


def decode_column(vocab_path: str):
    """Pandas UDF: ids (binary) -> text."""
    @F.pandas_udf("string")
    def decode(ids):
        return ids.map(encoder(vocab_path).decode)
    return decode


def encode_decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids again: (id_col, ids binary, decoded string).

    ``ids`` holds little-endian unsigned 32-bit integers.  A null text counts
    as empty, an empty text has no ids and decodes to an empty text, a
    repeated row gives a repeated row, and a null id stays null.  One pass
    over the rows, no shuffle; each worker holds one batch and two bounded
    word caches.
    """
    ship_code(df.sparkSession)
    id_type = df.schema[id_col].dataType

    def run(batches):
        tool = encoder(vocab_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [tool.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(
                    [tool.decode(x) for x in ids], pa.string())], names=[id_col, "ids", "decoded"])

    return (df.select(F.col(id_col), whole_text(text_col).alias("text"))
            .mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, ids binary, decoded string"))
