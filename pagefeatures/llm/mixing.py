"""Mixing sources to target weights: Sainte-Laguë apportionment of equal blocks of words.

Every source has a weight; together the sources are to give ``share`` times
the words of all documents.  The words come in blocks of one size:

1. *Targets.*  The words wanted are dealt out by weight.  A source whose part
   is above ``cap`` times its size gets that, and the excess is dealt out
   again among the others, until none is above.
2. *Quotas of sources.*  The blocks go to the sources by highest quotients
   target / (2k + 1), k being the blocks a source already has.  The same
   result is reached by a divisor: with the right x every source has
   round(target * x) blocks, and only equal quotients are left to share out.
   So x is searched with sums over the table of sources; no list of sources
   reaches the driver.
3. *Quotas of shards.*  A source's documents are dealt to shards by a seeded
   hash; its blocks go to its shards by the same rule, with the shards' words
   as votes.  No shard holds more than about 1/4096 of all words (or 16,384
   words), and no source has more than 4,096 shards, however large it is.
4. *Seeded selection.*  A shard's documents stand in a seeded order, and its
   words, end joined to start, are cut into blocks.  The quota takes that many
   blocks from a seeded one on, so all documents taken are whole but for the
   ends of the run, and none is taken more than ``cap`` times.

The place of a document in its shard is a running sum of words; what the run
takes of it follows by arithmetic, so blocks are never listed.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship_code, stored, whole_text

WORD = r"[^\x20\x09-\x0D]+"
#: points at which one pass over the sources evaluates a sum
POINTS = 32
MOST_SHARDS = 4096


def bracket(count: Callable[[list], list[int]], want: int, lo, hi) -> tuple:
    """Neighbours (a, b) with count(a) <= want < count(b), or a = b with count(a) = want.

    ``count`` gives a non-decreasing sum at each of several points, ``want``
    lies between its values at ``lo`` and ``hi``.  Whole numbers are narrowed
    to neighbours, floats until no float lies between.
    """
    whole = isinstance(lo, int)
    while True:
        if whole:
            points = sorted({lo + (hi - lo) * k // POINTS for k in range(POINTS + 1)})
        else:
            points = sorted({lo + (hi - lo) * k / POINTS for k in range(POINTS)} | {hi})
        sums = count(points)
        if want in sums:
            p = points[sums.index(want)]
            return p, p
        above = next((k for k, n in enumerate(sums) if n > want), len(points) - 1)
        if len(points) <= 2 or above == 0:
            return points[max(above - 1, 0)], points[above]
        lo, hi = points[above - 1], points[above]
        if not whole and np.nextafter(lo, hi) >= hi:
            return lo, hi


def highest_quotients(votes: Sequence[int], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Laguë seats of each place: the next seat goes to the highest votes / (2 * seats + 1).

    No place gets more than its ``most``; equal quotients go to the first
    place.  Nearly all seats are given at once by a divisor that is a little
    too large, the rest one by one.
    """
    n, total = len(votes), sum(votes)
    if not total or seats <= 0:
        return [0] * n
    share = max(Fraction(2 * seats - n, 2 * total), Fraction(0))
    got = [min(int(v * share + Fraction(1, 2)), m) if v else 0 for v, m in zip(votes, most)]
    queue = [(-Fraction(v, 2 * s + 1), k) for k, (v, s, m) in enumerate(zip(votes, got, most)) if v and s < m]
    heapq.heapify(queue)
    for _ in range(seats - sum(got)):
        if not queue:
            break
        _, k = heapq.heappop(queue)
        got[k] += 1
        if got[k] < most[k]:
            heapq.heappush(queue, (-Fraction(votes[k], 2 * got[k] + 1), k))
    return got


def word_sizes(df: DataFrame, seed: int, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(doc, source, size, key, copies): rows alike in id, source and text count as copies of one."""
    return (df.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), whole_text(text_col).alias("text"))
            .select("doc", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
                    F.xxhash64(F.lit(seed), "doc", "text").alias("key"))
            .groupBy("doc", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies")))


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, total, position): the sources by code point, null last, numbered from 0.

    Sorted by range; a place is the rank in its partition plus the counts of
    the partitions before, of which there are as many as shuffle partitions.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("total"))
    rows = stored(totals.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "sources")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    return rows.join(before, "part").select(
        "source", "total", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("position"))


def weight_of(position: str, weights: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(position, F.lit(len(weights))) + 1).cast("int"))


def water_level(sources: DataFrame, wanted: Fraction, cap: int) -> Fraction:
    """What a source with weight 1 gets once every excess over ``cap`` times a size is dealt out again.

    ``sources`` has total and weight.  Each round takes two sums over them; the
    sources at their cap only become more, mostly in two or three rounds.
    """
    level, last = Fraction(0), None
    while True:
        above = F.lit(float(cap)) * F.col("total") <= F.lit(float(level)) * F.col("weight")
        full, weight = sources.agg(F.sum(F.when(above, F.col("total")).otherwise(0)),
                                   F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not weight or (full, weight) == last:
            return level
        last, level = (full, weight), (wanted - cap * full) / weight


def source_blocks(sources: DataFrame, n_blocks: int) -> Column:
    """Sainte-Laguë blocks of each row of ``sources`` (target, position): a column expression.

    Equal quotients at the last blocks go to the first positions.
    """
    def blocks(x: float) -> Column:
        return F.floor(F.col("target") * F.lit(x) + F.lit(0.5))

    n, total, last = sources.where("target > 0").agg(F.count(F.lit(1)), F.sum("target"), F.max("position")).first()
    if not n:
        return F.lit(0).cast("long")
    sums = lambda cols: [int(x or 0) for x in sources.agg(*[F.sum(c) for c in cols]).first()]
    lo, hi = bracket(lambda points: sums([blocks(x) for x in points]), n_blocks,
                     max(n_blocks - n / 2 - 1, 0.0) / total, (n_blocks + n / 2 + 1) / total)
    if lo == hi:
        return blocks(lo)
    tied, rest = blocks(hi) - blocks(lo), n_blocks - sums([blocks(lo)])[0]
    first = bracket(lambda points: sums([F.when(F.col("position") < p, tied).otherwise(0) for p in points]), rest, 0, int(last) + 1)[0]
    return blocks(lo) + F.when(F.col("position") < first, tied).otherwise(0)


def shard_quotas(shards: DataFrame, block: int, cap: int) -> DataFrame:
    """(position, shard, words, run): words that each shard gives, whole blocks up to ``cap`` times its own.

    ``shards`` has position, shard, words and the blocks of the source; a
    source has at most ``MOST_SHARDS`` rows.
    """
    def deal(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        words = table["words"].to_pylist()
        got = highest_quotients(words, table["blocks"][0].as_py(), [-(-cap * w // block) for w in words])
        run = pa.array([min(g * block, cap * w) for g, w in zip(got, words)], pa.int64())
        return table.select(["position", "shard", "words"]).append_column("run", run)

    return shards.groupBy("position").applyInArrow(deal, "position long, shard long, words long, run long")


def mix(df: DataFrame, weights: Sequence[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), cap: int = 2,
        block_words: int = 64, shard_words: int = 16_384, seed: int = 13, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How many words a mix of all sources takes from each document.

    Columns: id_col, size (words), source_size, target (of the source; double)
    and taken.  ``weights`` go to the sources by code point, null last, and
    repeat.  A block has ``block_words`` words, fewer if the smallest target
    has under 200 of them, so a source's taken words differ from its target
    by about half a block (and where a source is taken ``cap`` times, by the
    part of a block left over in each shard).

    A null or empty text has size 0 and gives nothing.  A null source is one
    source, a null id an ordinary id.  Rows with equal id, source and text
    are copies that follow each other in the order; what the run takes of
    each may differ, and which of them it is can't be told.  An empty table
    gives no rows, other columns don't matter.  The seed and the rows alone
    decide, so a rerun on any cluster agrees.
    """
    ship_code(df.sparkSession)
    sizes = stored(word_sizes(df, seed, id_col, source_col, text_col), "mix-sizes")
    ranked = ranked_sources(sizes).withColumn("weight", weight_of("position", weights))
    total = ranked.agg(F.sum("total")).first()[0] or 0
    wanted = share * total
    level = water_level(ranked, wanted, cap)
    by_weight = F.element_at(F.create_map(*[F.lit(x) for w in sorted(set(weights)) for x in (w, float(level * w))]), F.col("weight"))
    ranked = ranked.withColumn("target", F.least(by_weight, F.lit(float(cap)) * F.col("total")))

    least = ranked.where("target > 0").agg(F.min("target")).first()[0] or 0
    block = max(1, min(block_words, int(least) // 200))
    in_shard = max(shard_words, total // MOST_SHARDS)
    plan = stored(ranked.select(
        F.col("source").alias("of_source"), "position", "total", "target",
        source_blocks(ranked, int(wanted / block + Fraction(1, 2))).alias("blocks"),
        F.greatest(F.least(F.expr(f"total div {in_shard}"), F.lit(MOST_SHARDS)), F.lit(1)).alias("shards")), "mix-plan")

    # empty documents take no place in a shard: groups of their own, which get no quota
    shard = F.when(F.col("size") > 0, F.pmod("key", F.col("shards"))).otherwise(-1 - F.pmod("key", F.lit(MOST_SHARDS)))
    items = (sizes.join(plan, sizes["source"].eqNullSafe(plan["of_source"]))
             .select("doc", "size", "key", "copies", "position", "total", "target", "blocks", shard.alias("shard")))
    shards = items.where("size > 0").groupBy("position", "shard").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.first("blocks").alias("blocks"))
    first_block = F.pmod(F.xxhash64(F.lit(seed), "position", "shard"), F.expr(f"(words + {block - 1}) div {block}"))
    quotas = stored(shard_quotas(shards, block, cap).withColumn("start", first_block * block), "mix-quotas")

    order = Window.partitionBy("position", "shard").orderBy("key", "doc", "size").rowsBetween(Window.unboundedPreceding, 0)
    places = (items.withColumn("end", F.sum(F.col("size") * F.col("copies")).over(order))
              .join(quotas, ["position", "shard"], "left")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
              .withColumn("b", F.col("end") - (F.col("copies") - F.col("copy")) * F.col("size"))
              .withColumn("a", F.col("b") - F.col("size"))
              .withColumn("rest", F.expr("run % words")))
    overlap = lambda lo, hi: F.greatest(F.least(F.col("b"), hi) - F.greatest(F.col("a"), lo), F.lit(0))
    stop = F.col("start") + F.col("rest")
    taken = F.expr("run div words") * F.col("size") + overlap(F.col("start"), stop) + overlap(F.lit(0), stop - F.col("words"))
    return places.select(F.col("doc").alias(id_col), "size", F.col("total").alias("source_size"), "target",
                         F.when(F.col("run") > 0, taken).otherwise(0).cast("long").alias("taken"))
