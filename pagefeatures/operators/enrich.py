"""Left joins of page rows with look-back features, blocks and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import config as C
from ..functions.columns import fallback, ladder, mean_rounded, page_weight, strictness
from ..sources.tables import scan_day
from .features import place_quartiles, quartile_name

PROFILE_KEYS = ("boss_id", "job_id", "sessionid", "page", "date")

def profile_rows(impressions: DataFrame, day: str | None = None,
                 cols: Sequence[str] = C.PROFILE_COLUMNS, source: str = C.PROFILE_SOURCE,
                 rank: str = C.PROFILE_RANK, day_col: str = "ds") -> DataFrame:
    """Distinct profile rows of first-position feed impressions.

    ``rank`` is compared as text (``'01'`` is not ``'1'``).  ``distinct``
    shuffles on all columns (a page key with many rows is still spread);
    the join shuffles on its keys, with adaptive skew splitting.
    """
    rows = impressions if day is None else scan_day(impressions, day, day_col)
    rows = (rows.where((F.col("source") == F.lit(source)) & (F.col("rank").cast("string") == F.lit(rank)))
            .select("boss_id", "job_id", "sessionid", "page", "rank",
                    F.to_date("list_time").alias("date"), *cols, day_col))
    return rows.distinct()


def join_profile(pages: DataFrame, profiles: DataFrame, day_col: str = "ds") -> DataFrame:
    """Left join on boss, job, session, page and date; several profile rows fan out."""
    return pages.join(profiles.drop("rank"), [*PROFILE_KEYS, day_col], "left")


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """Distinct (boss, job, business).

    Copies of a row are combined map-side before any shuffle, so a pair
    repeated many times in the dimension never lands whole in one task.
    """
    return blocks.select("boss_id", "job_id", "business").distinct()


def join_block(pages: DataFrame, blocks: DataFrame, default: int = 0) -> DataFrame:
    """Left join with distinct (boss, job, business); ``business_type`` defaults to 0.

    A (boss, job) with several business values gives several rows.
    """
    out = pages.join(distinct_blocks(blocks), ["boss_id", "job_id"], "left")
    return out.withColumn("business_type", F.coalesce(F.col("business"), F.lit(default))).drop("business")


def join_ratios(pages: DataFrame, ratios_wide: DataFrame, n_bands: int = C.N_BANDS,
                day_col: str = "ds") -> DataFrame:
    """One left join with the wide band-ratio table (adds ``pct1_ratio..``) on (day, cp)."""
    r = ratios_wide.select(day_col, "cp", *[f"pct{b}_ratio" for b in range(1, n_bands + 1)])
    return pages.join(r, [day_col, "cp"], "left")


def place_features(places: DataFrame, ratios_wide: DataFrame, quartiles: DataFrame, blocks: DataFrame,
                   n_bands: int = C.N_BANDS, day_col: str = "ds") -> DataFrame:
    """(_place, features): the distinct places (day, boss, job, cp) with their band ratios, quartiles and blocks.

    Feature tables carry the target day, so every join includes it.
    ``_place`` is one struct: its parts may be NULL, the struct is not.
    """
    place = [day_col, "boss_id", "job_id", "cp"]
    f = place_quartiles(places.select(*place).distinct(), quartiles, day_col=day_col)
    f = join_block(join_ratios(f, ratios_wide, n_bands, day_col), blocks)
    return f.select(F.struct(*place).alias("_place"), *[c for c in f.columns if c not in place])


def join_features(pages: DataFrame, features: DataFrame, day_col: str = "ds") -> DataFrame:
    """Left join of pages with the features of their place (``place_features``)."""
    place = F.struct(day_col, "boss_id", "job_id", "cp")
    return pages.withColumn("_place", place).join(features, "_place", "left").drop("_place")


def joined_rows(pages: DataFrame, ratios_wide: DataFrame, quartiles: DataFrame, blocks: DataFrame,
                profiles: DataFrame, page_size: int = C.PAGE_SIZE, n_bands: int = C.N_BANDS,
                steps=C.PAGE_WEIGHT_STEPS,
                day_col: str = "ds", places: DataFrame | None = None) -> DataFrame:
    """Page rows with every feature joined and the relative features derived.

    Join plan: the features depend on (day, boss, job, cp) alone, so they are
    joined with the distinct ones of these, which is a narrow table, and
    that with the pages once.  Profiles, with their 100 columns, come last.
    The page rows are shuffled twice, however many features there are;
    adaptive execution may still broadcast a side that turns out small.
    ``places`` lists these keys for at least all pages (a caller with a
    cheaper source than the finished pages gives them); the default is the
    pages' own.  A NULL key has the features of its other keys.
    ``quartiles`` has all entities (``features.entity_quartiles``).
    """
    f = place_features(pages if places is None else places, ratios_wide, quartiles, blocks, n_bands, day_col)
    return profiled_rows(join_features(pages, f, day_col), profiles, page_size, n_bands, steps, day_col)


def profiled_rows(featured: DataFrame, profiles: DataFrame, page_size: int = C.PAGE_SIZE, n_bands: int = C.N_BANDS,
                  steps=C.PAGE_WEIGHT_STEPS, day_col: str = "ds") -> DataFrame:
    """Pages with their features (``join_features``): profiles joined, and the relative features derived."""
    x = join_profile(featured, profiles, day_col)
    addf = [F.col(f"addf_{i}") for i in range(1, page_size + 1)]
    derived = []
    for i in (1, 2, 3):
        derived.append(strictness(quartile_name("job", i), quartile_name("boss", i), quartile_name("cp", i)).alias(f"q{i}_strict"))
    for i in (1, 2, 3):
        derived.append(ladder(addf, fallback(quartile_name("job", i), quartile_name("boss", i), quartile_name("cp", i))).alias(f"q{i}_base"))

    return x.select(
        "boss_id", "job_id", "sessionid", "page", "list_hour", "date", "weekday", "city", "pos",
        "cp", "num", *[f"pct{b}" for b in range(1, n_bands + 1)],
        *[f"pct{b}_ratio" for b in range(1, n_bands + 1)],
        "addf_num", "suc_num",
        # round(avg, 3) of the page's scores, computed exactly from its sorted lists
        mean_rounded(addf, 3).alias("avg_addf_score"),
        mean_rounded([f"suc_{i}" for i in range(1, page_size + 1)], 3).alias("avg_suc_score"),
        *[f"suc_{i}" for i in range(1, page_size + 1)],
        *[f"addf_{i}" for i in range(1, page_size + 1)],
        *[quartile_name(e, i) for e in ("job", "boss", "cp") for i in (1, 2, 3)],
        *derived,
        "job_addf_num_3days", "boss_addf_num_3days", "cp_addf_num_3days",
        page_weight("page", steps).alias("page_base"),
        "business_type",
        *C.PROFILE_COLUMNS,
        day_col)
