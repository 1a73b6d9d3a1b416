"""The whole day: inputs -> labelled impressions -> features -> final rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config as C, dates
from ..functions.columns import composite_key
from ..operators.bands import band_counts, wide_ratios
from ..operators.enrich import join_features, joined_rows, place_features, profile_rows, profiled_rows
from ..operators.features import entity_quartiles, entity_scores, score_counts
from ..operators.finalize import final_rows
from ..operators.label import label_impressions
from ..operators.pages import page_samples
from ..session import child_names
from ..sources.tables import finish_publish, materialize, overwrite_day, read_table, run_folder, scan_days


@dataclass
class DayInputs:
    rank_scores: DataFrame
    impressions: DataFrame
    job_blocks: DataFrame


@dataclass
class DayPartials:
    """Additive counts by source day: what any later target needs of the days it looks back to."""
    bands: DataFrame    # ds, cp, n1.., s1..
    scores: DataFrame   # ds, entity, job_id, boss_id, cp, score, n


def day_partials(info: DataFrame) -> DayPartials:
    """The counts of every source day in ``info``."""
    return DayPartials(band_counts(info), score_counts(info))


def lookback_days_of(targets, lookback: int = C.LOOKBACK_DAYS) -> list[str]:
    """All days that some target looks back to."""
    return sorted({d for t in targets for d in dates.lookback_days(t, lookback)})


def lookback_rows(info: DataFrame, targets, lookback: int = C.LOOKBACK_DAYS,
                  day_col: str = "ds") -> DataFrame:
    """Rows (labelled rows, or counts of a source day) re-keyed by the target day they serve.

    A row of day d serves the targets d+1 .. d+lookback; each copy gets that
    target in ``day_col``, and only wanted targets are kept.  So look-back
    features of many target days come from one aggregation grouped by
    (target, key), instead of one scan per day.  Only the needed days are
    read (partition pruning on the original day).
    """
    targets = sorted(set(targets))
    days = lookback_days_of(targets, lookback)
    if len(targets) == 1:
        return scan_days(info, days).withColumn(day_col, F.lit(targets[0]))
    # (source day, target) pairs: lookback rows for each target, whatever the table's size
    pairs = info.sparkSession.createDataFrame(
        [(d, t) for t in targets for d in dates.lookback_days(t, lookback)], f"_source string, `{day_col}` string")
    return (scan_days(info, days).withColumnRenamed(day_col, "_source")
            .join(F.broadcast(pairs), "_source").drop("_source"))


def features_for(info: DataFrame | None, targets, lookback: int = C.LOOKBACK_DAYS,
                 partials: DayPartials | None = None) -> tuple[DataFrame, DataFrame]:
    """Look-back features of every target day: band ratios, and quartiles of all entities.

    Rows are counted by source day first, and the counts go to the targets;
    no row is copied for several targets.  ``partials`` are such counts from
    a table; then ``info`` is not read.  With one target and no table the
    rows themselves are keyed by it, which saves a step.
    """
    targets = sorted(set(targets))
    if partials is None and len(targets) == 1:
        back = lookback_rows(info, targets, lookback)
        return wide_ratios(band_counts(back)), entity_quartiles(entity_scores(back))
    if partials is None:
        partials = day_partials(scan_days(info, lookback_days_of(targets, lookback)))
    return (wide_ratios(lookback_rows(partials.bands, targets, lookback), add_up=True),
            entity_quartiles(lookback_rows(partials.scores, targets, lookback), few=True))


def label_days(inputs: DayInputs, targets, lookback: int = C.LOOKBACK_DAYS,
               spark: SparkSession | None = None) -> DataFrame:
    """Label every day the targets need in one join (ds is a join key), written once."""
    days = sorted({*targets, *lookback_days_of(targets, lookback)})
    labelled = label_impressions(scan_days(inputs.rank_scores, days), scan_days(inputs.impressions, days))
    return materialize(spark or labelled.sparkSession, labelled, "labelled")


def build_days(inputs: DayInputs, targets, info: DataFrame | None = None,
               lookback: int = C.LOOKBACK_DAYS, q3_uses_q1: bool = True,
               spark: SparkSession | None = None, partials: DayPartials | None = None) -> DataFrame:
    """Final rows of several target days (a back-fill).

    ``info`` is the labelled-impression table; when None, the needed days
    are labelled here and written once to the shared folder (five later
    aggregations read it).  Pages, look-back features and profiles are
    computed for all targets together, keyed by day.

    With one target this is one plan.  With several the features of all
    places, and then the pages with them, are written on the way: the disk
    holds the shuffle files of one of these steps at a time, and a reader
    of one day reads that day's pages alone.
    """
    targets = sorted(set(targets))
    if info is None:
        info = label_days(inputs, targets, lookback, spark)
    ratios, quartiles = features_for(info, targets, lookback, partials)
    rows = scan_days(info, targets)
    pages = page_samples(rows)
    places = rows.select("ds", "boss_id", "job_id", composite_key("boss_city", "boss_position").alias("cp"))
    profiles = profile_rows(scan_days(inputs.impressions, targets))
    if len(targets) == 1:
        joined = joined_rows(pages, ratios, quartiles, inputs.job_blocks, profiles, places=places)
    else:
        spark = spark or info.sparkSession
        features = materialize(spark, place_features(places, ratios, quartiles, inputs.job_blocks), "features", day_col=None)
        joined = profiled_rows(materialize(spark, join_features(pages, features), "featured-pages"), profiles)
    return final_rows(joined, q3_uses_q1=q3_uses_q1)


def build_day(inputs: DayInputs, target: str, info: DataFrame | None = None, **kw) -> DataFrame:
    """Final rows of one target day (``build_days`` with one target)."""
    return build_days(inputs, [target], info=info, **kw)


def backfill(spark: SparkSession, inputs: DayInputs, targets, out_path: str, run: str | None = None, **opts) -> DataFrame:
    """Build several target days and publish them; no intermediate table is left.

    A run that fails keeps its tables, and started again under the same
    ``run`` name it goes on from the finished ones.
    """
    with run_folder(spark, run):
        overwrite_day(build_days(inputs, targets, spark=spark, **opts), out_path, days=sorted(set(targets)), rebalance=True)
    return read_table(spark, out_path)


def _partial_paths(info_path: str, partials_path: str | None) -> dict[str, str]:
    root = partials_path or f"{info_path.rstrip('/')}-counts"
    return {name: f"{root}/{name}" for name in ("bands", "scores")}


def write_partials(spark: SparkSession, info_path: str, days, partials_path: str | None = None) -> None:
    """Count the given days of the labelled table and publish their counts."""
    days = sorted(set(days))
    part = day_partials(scan_days(read_table(spark, info_path), days))
    for name, path in _partial_paths(info_path, partials_path).items():
        overwrite_day(getattr(part, name), path, days=days, rebalance=len(days) > 1)


def read_partials(spark: SparkSession, info_path: str, days, partials_path: str | None = None) -> DayPartials:
    """Stored counts; labelled days among ``days`` that have none yet are counted first."""
    paths = _partial_paths(info_path, partials_path)
    for path in (info_path, *paths.values()):
        finish_publish(spark, path)
    there = [{n for n in child_names(spark, p) if n.startswith("ds=")} for p in paths.values()]
    labelled = set(child_names(spark, info_path))
    missing = [d for d in days if f"ds={d}" in labelled and not all(f"ds={d}" in t for t in there)]
    if missing:
        write_partials(spark, info_path, missing, partials_path)
    return DayPartials(*[read_table(spark, p) for p in paths.values()])


def run_day(spark: SparkSession, inputs: DayInputs, target: str, info_path: str, out_path: str,
            lookback: int = C.LOOKBACK_DAYS, partials_path: str | None = None, **opts) -> DataFrame:
    """Run one day as the scheduled job does, writing four tables.

    1. label the target day and replace its partition of ``info_path``
       (earlier days were written by earlier runs, or by a back-fill);
    2. count it (band counts, score counts) and replace its partition of
       the two tables of counts (beside ``info_path`` by default);
    3. build the final rows from the labelled target day and the counts of
       the look-back days, and replace the target partition of ``out_path``.

    Of the labelled table only the target day is read.  All writes replace
    the target day alone, also by an empty day, so a re-run is idempotent;
    the written tables cut the lineage between the steps.  Nothing is
    cached, so the caller's cached tables are left alone.
    """
    overwrite_day(label_impressions(inputs.rank_scores, inputs.impressions, day=target), info_path, days=[target])
    write_partials(spark, info_path, [target], partials_path)
    partials = read_partials(spark, info_path, dates.lookback_days(target, lookback), partials_path)
    out = build_day(inputs, target, info=read_table(spark, info_path), lookback=lookback, partials=partials, **opts)
    overwrite_day(out, out_path, days=[target])
    return read_table(spark, out_path)


def backfill_labels(inputs: DayInputs, days, info_path: str, partials_path: str | None = None) -> None:
    """Label several days in one job (ds joins with the keys), replace them, and count them.

    With more than one day the writes are rebalanced by day, so a long
    back-fill writes files sized per day rather than one per task and day.
    """
    days = sorted(set(days))
    labelled = label_impressions(scan_days(inputs.rank_scores, days), scan_days(inputs.impressions, days))
    overwrite_day(labelled, info_path, rebalance=len(days) > 1, days=days)
    write_partials(labelled.sparkSession, info_path, days, partials_path)
