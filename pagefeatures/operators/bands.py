"""Contact ratio by segment and score band (look-back feature).

One scan and one aggregation replace the original eight scans: every row
gets its band number, then conditional aggregates per segment give all
eight (ratio, count) pairs.  Partial aggregation runs map-side, so a large
segment is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .. import config as C
from ..functions.columns import composite_key, flag_in, score_band


def _band_rows(info: DataFrame, edges, contact, score_col: str, by: Sequence[str] = ()) -> DataFrame:
    return (info
            .select(*by, composite_key("boss_city", "boss_position").alias("cp"),
                    score_band(score_col, edges).alias("band"),
                    flag_in("deal_type", contact).alias("flag"))
            .where(F.col("band").isNotNull()))


def _min_for_band(band: Column, min_count: Sequence[int]) -> Column:
    expr = F.when(band == F.lit(1), F.lit(int(min_count[0])))
    for b, m in enumerate(min_count[1:], start=2):
        expr = expr.when(band == F.lit(b), F.lit(int(m)))
    return expr


def band_ratio(info: DataFrame, edges: Sequence[float] = C.BAND_EDGES,
               min_count: Sequence[int] = C.BAND_MIN_COUNT,
               contact: Sequence[str] = C.CONTACT_TYPES, score_col: str = "ctr_score",
               by: Sequence[str] = ("ds",)) -> DataFrame:
    """Long form: (by..., cp, band, addf_ratio, num) for bands whose count is above its limit.

    ``by`` are extra grouping columns; by default ``ds``, the target day the
    look-back rows serve (see ``plans.daily.lookback_rows``).
    """
    rows = _band_rows(info, edges, contact, score_col, by)
    agg = rows.groupBy(*by, "cp", "band").agg(
        (F.sum("flag") / F.count(F.lit(1))).alias("addf_ratio"),
        F.count(F.lit(1)).alias("num"))
    return agg.where(F.col("num") > _min_for_band(F.col("band"), min_count)).select(
        *by, "cp", F.col("band").cast("int").alias("band"), "addf_ratio", "num")


def band_ratio_wide(info: DataFrame, edges: Sequence[float] = C.BAND_EDGES,
                    min_count: Sequence[int] = C.BAND_MIN_COUNT,
                    contact: Sequence[str] = C.CONTACT_TYPES, score_col: str = "ctr_score",
                    ratio_name: str = "pct{}_ratio", count_name: str = "pct{}_cnt",
                    by: Sequence[str] = ("ds",)) -> DataFrame:
    """Wide form: one row per (by..., cp) with ``pct1_ratio..pct8_ratio`` and counts.

    A band under its limit gives NULL ratio and count; cps with no band
    above its limit are dropped (a left join would give NULL anyway).
    """
    return wide_ratios(band_counts(info, edges, contact, score_col, by), len(edges) + 1, min_count, ratio_name, count_name, by)


def band_counts(info: DataFrame, edges: Sequence[float] = C.BAND_EDGES, contact: Sequence[str] = C.CONTACT_TYPES,
                score_col: str = "ctr_score", by: Sequence[str] = ("ds",)) -> DataFrame:
    """(by..., cp, n1.., s1..): rows and contacts of each band by segment.  Additive over rows, so over days."""
    aggs = []
    for b in range(1, len(edges) + 2):
        inb = F.col("band") == F.lit(b)
        aggs += [F.count_if(inb).alias(f"n{b}"), F.coalesce(F.sum(F.when(inb, F.col("flag"))), F.lit(0)).alias(f"s{b}")]
    return _band_rows(info, edges, contact, score_col, by).groupBy(*by, "cp").agg(*aggs)


def wide_ratios(counts: DataFrame, n_bands: int = C.N_BANDS, min_count: Sequence[int] = C.BAND_MIN_COUNT,
                ratio_name: str = "pct{}_ratio", count_name: str = "pct{}_cnt", by: Sequence[str] = ("ds",),
                add_up: bool = False) -> DataFrame:
    """The wide form of ``band_ratio_wide`` from band counts; ``add_up`` first sums several rows of a segment (days)."""
    bands = range(1, n_bands + 1)
    if add_up:
        counts = counts.groupBy(*by, "cp").agg(*[F.sum(f"{c}{b}").alias(f"{c}{b}") for b in bands for c in "ns"])
    enough = {b: F.col(f"n{b}") > F.lit(int(min_count[b - 1])) for b in bands}
    cols = [F.col(c) for c in (*by, "cp")]
    for b in bands:
        cols.append(F.when(enough[b], F.try_divide(F.col(f"s{b}"), F.col(f"n{b}"))).alias(ratio_name.format(b)))
        cols.append(F.when(enough[b], F.col(f"n{b}")).alias(count_name.format(b)))
    return counts.where(reduce(or_, enough.values())).select(*cols)
