"""Labelling join: scored impressions x outcomes (one inner equi-join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import config as C
from ..sources.tables import scan_day

INFO_COLUMNS = ("boss_id", "job_id", "geek_id", "exp_id", "sessionid", "page", "rank",
                "list_time", "boss_position", "boss_city", "ctcvr_score", "ctr_score",
                "deal_type")
OUTCOME_COLUMNS = ("deal_type", "boss_position", "boss_city", "list_time")


#: keys are counted in this many parts; a part above one SHARE-th of all rows is labelled with skew in mind
PARTS = 4096
SHARE = 200


def _part(keys: Sequence[str]):
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS))


def _hot_parts(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """(_part): the parts of the keys that hold more than one SHARE-th of the rows; fewer than SHARE of them."""
    counts = [d.groupBy(_part(keys).alias("_part")).agg(F.count(F.lit(1)).alias("_n")) for d in sides]
    sizes = counts[0].unionByName(counts[1]).groupBy("_part").agg(F.sum("_n").alias("_n"))
    # one row for each part, however many keys there are
    share = sizes.withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    return share.where(F.col("_n") * SHARE > F.col("_all")).select("_part")


def label_impressions(scores: DataFrame, outcomes: DataFrame, day: str | None = None,
                      keys: Sequence[str] = C.LABEL_KEYS, day_col: str = "ds") -> DataFrame:
    """Distinct scored impressions joined with their outcomes.

    The outcome side is not made distinct: duplicate outcome rows multiply
    the impression (kept on purpose).  ``day`` restricts both sides to one
    partition; without it every day is labelled, with the day as a join key.

    Plan: each side is shuffled once, on the join keys, and ``distinct``
    works where the rows then lie.  Keys that hold a large share of the rows
    (counted beforehand in parts, no row travels for it) go another way:
    their ``distinct`` shuffles on every column, so they are spread over many
    tasks, and their join shuffles again, where adaptive execution splits a
    skewed key's partition (skew join) instead of giving it to one task.
    Without such keys that branch is empty and falls away at run time.  Keys
    whose types differ between the sides hash differently, so all go that way.
    """
    if day is not None:
        scores, outcomes = scan_day(scores, day, day_col), scan_day(outcomes, day, day_col)
    jk = list(keys) + [day_col]
    b = outcomes.select(*keys, *OUTCOME_COLUMNS, day_col)
    columns = [*INFO_COLUMNS, day_col]
    if any(scores.schema[k].dataType != b.schema[k].dataType for k in jk):
        return scores.distinct().join(b, jk).select(*columns)
    hot = F.broadcast(_hot_parts([scores, b], jk))

    def side(df: DataFrame, how: str) -> DataFrame:
        return df.join(hot, _part(jk) == hot["_part"], how)

    usual = side(scores, "left_anti").repartition(*jk).distinct().join(side(b, "left_anti"), jk)
    spread = side(scores, "left_semi").distinct().join(side(b, "left_semi"), jk)
    return usual.select(*columns).unionByName(spread.select(*columns))
