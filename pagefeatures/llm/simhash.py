"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected groups.

1. Every whole text gets a 64-bit fingerprint of its word shingles.
2. Equal fingerprints are one from here on (pre-aggregated).
3. The 64 bits are cut into ``blocks`` blocks.  Two fingerprints that differ
   in at most ``distance`` bits agree in ``blocks - distance`` blocks or more,
   so every choice of that many blocks is one block key and close pairs share
   at least one.  With 6 blocks a key has 32 bits or more: buckets stay
   small up to billions of fingerprints.
4. Members of a bucket meet, are verified by Hamming distance, and give a
   spanning forest of the links, not all pairs: the links left out join
   fingerprints that the forest has joined already.
5. A bucket with more than ``bucket_limit`` fingerprints (a dense group) is cut
   again by the pigeonhole rule, over the bits that its key leaves open, into
   ``FINE`` sub-blocks.  A fine bucket fixes all but 12 bits or so, so it can't hold
   more than a few thousand different fingerprints, whatever the data.
6. Groups grow together by alternating star contractions of the links; each
   round is a table in the shared folder.  Nothing is collected.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .bpe import ROWS
from .common import ship_code, stored, whole_text

FINE = 8


def fingerprint_text(text: str, shingle: int = 3) -> int:
    """64-bit SimHash as a signed number; 0 for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    elif shingle == 3:
        led = [w + b" " for w in words]
        shingles = [a + b + c for a, b, c in zip(led, led[1:], words[2:])]
    else:
        shingles = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounded memory for very long texts
        block = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp): the fingerprint of every row; a null text counts as empty."""
    ship_code(df.sparkSession)
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                fps = [fingerprint_text(t, shingle) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    return (df.select(F.col(id_col), whole_text(text_col).alias("text"))
            .mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, fp long"))


def block_masks(blocks: int, keep: int, bits: list[int] | None = None) -> list[int]:
    """Signed 64-bit masks, one for each choice of ``keep`` of ``blocks`` blocks of the given bits."""
    bits = list(range(64)) if bits is None else bits
    parts = [sum(1 << int(b) for b in p) for p in np.array_split(np.array(bits), blocks)]
    masks = [sum(c) for c in combinations(parts, keep)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of at most ``distance`` bits that join whatever such links join, at most one a fingerprint."""
    links, todo = [], np.ones(len(fps), bool)
    while todo.any():
        first = int(todo.argmax())
        todo[first], frontier = False, [first]
        while frontier:
            a = frontier.pop()
            near = np.flatnonzero(todo)
            near = near[np.bitwise_count(fps[near] ^ fps[a]) <= distance]
            todo[near] = False
            links += [(int(fps[a]), int(fps[b])) for b in near]
            frontier += near.tolist()
    return links


def _bucket_links(buckets: DataFrame, distance: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            links = [x for members in batch.column(0) for x in forest(
                np.array(members.values, np.int64).view(np.uint64), distance)]
            sides = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(sides[:, 0]), pa.array(sides[:, 1])], names=["a", "b"])

    return buckets.select("members").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, distance: int = 3, blocks: int = 6, bucket_limit: int = 1024) -> DataFrame:
    """(a, b): links that join every two of the distinct fingerprints ``fp`` that are close, through others or not."""
    masks = block_masks(blocks, blocks - distance)
    key = [F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)]
    keyed = fps.select("fp", F.inline(F.array(*key)))
    sizes = keyed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(keyed.join(sizes, ["block", "key"]), "simhash-blocks")
    small = (shared.where(F.col("n") <= bucket_limit).groupBy("block", "key")
             .agg(F.collect_list("fp").alias("members")))  # bucket_limit at most
    # dense buckets: the bits outside the block key, cut into fine sub-blocks
    fine = None
    for k, m in enumerate(masks):
        bits = [b for b in range(64) if not (m >> b) & 1]
        keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m | x)) for x in block_masks(FINE, FINE - distance, bits)])
        fine = F.when(F.col("block") == k, keys) if fine is None else fine.when(F.col("block") == k, keys)
    dense = (shared.where(F.col("n") > bucket_limit).select("block", "fp", F.posexplode(fine).alias("sub", "fine"))
             .groupBy("block", "sub", "fine").agg(F.collect_list("fp").alias("members"))  # bounded by the open bits
             .where(F.size("members") > 1))
    return _bucket_links(small.select("members").unionByName(dense.select("members")), distance).distinct()


def components(edges: DataFrame, name: str = "simhash") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star rounds; minima are aggregated on
    the map side, so a hub with very many links is no task of its own.
    """
    def star(pairs: DataFrame, both: bool) -> DataFrame:
        down = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        seen = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else down
        least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hung = seen.join(least, "u").where(F.col("v") > F.col("u") if both else F.col("v") != F.col("m"))
        kept = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not both:
            kept = kept.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return kept.where("a <> b").distinct()

    pairs = stored(edges.where("a <> b").select("a", "b"), f"{name}-links")
    before = None
    while True:
        pairs = stored(star(star(pairs, True), False), f"{name}-stars")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(df: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 6, bucket_limit: int = 1024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id): every row with its fingerprint and group.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` bits, the row's own included; null ids count for nothing,
    so it is null where a group has no other.  Texts without words (null,
    empty, blank) have fingerprint 0, which links like any other.  Repeated
    rows give repeated rows, an empty table gives none.
    """
    marked = stored(fingerprints(df, shingle, id_col, text_col), "simhash-fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-distinct")
    roots = components(links(distinct, distance, blocks, bucket_limit))
    rooted = stored(distinct.join(roots, distinct.fp == roots.node, "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = stored(rooted.join(least, "root").select("fp", "component_id"), "simhash-groups")
    return marked.join(groups, "fp").select(id_col, "fp", "component_id")
