"""Complete pages: one row per page of exactly ``page_size`` scored impressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import config as C
from ..functions.columns import composite_key, flag_in, score_band, weekday_number

PAGE_KEYS = ("boss_id", "job_id", "sessionid", "page", "list_hour", "date", "weekday", "city", "pos")


def page_rows(info: DataFrame, score_col: str = "ctr_score", suc_col: str = "ctcvr_score",
              contact: Sequence[str] = C.CONTACT_TYPES, success: Sequence[str] = C.SUCCESS_TYPES,
              edges: Sequence[float] = C.BAND_EDGES, day_col: str = "ds") -> DataFrame:
    """Impressions with a non-negative score, shaped for page aggregation.

    NaN is dropped explicitly: Spark orders NaN above every number, so
    ``NaN >= 0`` would hold.
    """
    s = F.col(score_col)
    return (info.where((s >= F.lit(0.0)) & ~F.isnan(s))
            .select("boss_id", "job_id", "sessionid", "page",
                    F.hour("list_time").alias("list_hour"),
                    F.to_date("list_time").alias("date"),
                    weekday_number("list_time").alias("weekday"),
                    F.col("boss_city").alias("city"),
                    F.col("boss_position").alias("pos"),
                    F.col(day_col),
                    s.alias("addf_score"),
                    F.col(suc_col).alias("suc_score"),
                    flag_in("deal_type", contact).alias("addf_flag"),
                    flag_in("deal_type", success).alias("suc_flag"),
                    score_band(s, edges).alias("band")))


def page_samples(info: DataFrame, page_size: int = C.PAGE_SIZE,
                 edges: Sequence[float] = C.BAND_EDGES, day_col: str = "ds", **row_opts) -> DataFrame:
    """Aggregate impressions to complete pages.

    A page is a group of the nine page keys (NULL is a group value) within
    one day; only groups of exactly ``page_size`` rows are kept.  Output:
    the keys, cp, the band histogram ``pct1..``, contact / success counts,
    ``num``, average scores, and the sorted scores unpacked to
    ``addf_1..`` / ``suc_1..`` (NULL scores are skipped, so the success list
    may be short: missing positions are NULL).

    Plan: one shuffle.  Rows are numbered by page and those beyond
    ``page_size + 1`` left out, which Spark does before the shuffle too (a
    window group limit): each task sends at most ``page_size + 1`` rows of
    a page, enough to see that it is too large.  So a key that holds a large
    share of the day (a NULL session, say) neither travels nor is collected,
    and the aggregation finds its rows where the window left them.
    """
    rows = page_rows(info, edges=edges, day_col=day_col, **row_opts)
    keyed = rows.withColumn("_page", F.struct(*PAGE_KEYS, day_col))
    number = F.row_number().over(Window.partitionBy("_page").orderBy("addf_score"))
    kept = keyed.withColumn("_number", number).where(F.col("_number") <= page_size + 1).drop("_number")

    nb = len(edges) + 1
    aggs = [F.count_if(F.col("band") == F.lit(b)).alias(f"pct{b}") for b in range(1, nb + 1)]
    aggs += [F.sum("addf_flag").alias("addf_num"),
             F.sum("suc_flag").alias("suc_num"),
             F.count(F.lit(1)).alias("num"),
             F.avg("addf_score").alias("avg_addf_score"),
             F.avg("suc_score").alias("avg_suc_score"),
             F.sort_array(F.collect_list("addf_score")).alias("_addf"),
             F.sort_array(F.collect_list("suc_score")).alias("_suc")]
    agg = kept.groupBy("_page").agg(*aggs).where(F.col("num") == page_size)

    keys = [F.col(f"_page.{k}").alias(k) for k in PAGE_KEYS]
    return agg.select(
        *keys,
        composite_key(F.col("_page.city"), F.col("_page.pos")).alias("cp"),
        *[f"pct{b}" for b in range(1, nb + 1)],
        "addf_num", "suc_num", "num", "avg_addf_score", "avg_suc_score",
        *[F.get(F.col("_addf"), i).alias(f"addf_{i + 1}") for i in range(page_size)],
        *[F.get(F.col("_suc"), i).alias(f"suc_{i + 1}") for i in range(page_size)],
        F.col(f"_page.{day_col}").alias(day_col))


def page_histogram(pages: DataFrame, n_bands: int = C.N_BANDS) -> DataFrame:
    """Band histogram of each page: page keys, ``pct1..``, ``num``."""
    return pages.select(*PAGE_KEYS, *[f"pct{b}" for b in range(1, n_bands + 1)], "num", "ds")
