"""Day-partitioned tables: scans by day and day-level overwrite.

Day filters are literal predicates on the partition column, so Spark prunes
partitions at planning time (``PartitionFilters`` in the scan node) and never
lists or opens files of other days.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, functions as F

from .. import dates
from ..session import (child_names, days_side_by_side, path_exists, remove_path, rename_path, shared_dir, shuffles_freed,
                       swap_in)


def _day(df: DataFrame, day_col: str) -> Column:
    return F.col(day_col)


def scan_day(df: DataFrame, day: str, day_col: str = "ds") -> DataFrame:
    """Rows of one day (``ds = day``)."""
    return df.where(_day(df, day_col) == F.lit(day))


def scan_days(df: DataFrame, days: Iterable[str], day_col: str = "ds") -> DataFrame:
    """Rows of a set of days (``ds IN (...)``)."""
    return df.where(_day(df, day_col).isin(list(days)))


def scan_lookback(df: DataFrame, target: str, n: int = 3, day_col: str = "ds") -> DataFrame:
    """Rows of the ``n`` days before ``target`` (the target day excluded)."""
    return scan_days(df, dates.lookback_days(target, n), day_col)


def scan_range(df: DataFrame, lo: str, hi: str, day_col: str = "ds") -> DataFrame:
    """Rows with ``lo <= ds <= hi`` (string order equals day order for yyyy-MM-dd)."""
    c = _day(df, day_col)
    return df.where((c >= F.lit(lo)) & (c <= F.lit(hi)))


def distinct_rows(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Distinct rows of a dimension, optionally projected first."""
    return (df.select(*cols) if cols else df).distinct()


def overwrite_day(df: DataFrame, path: str, day_col: str = "ds", rebalance: bool = False,
                  days: Iterable[str] | None = None) -> None:
    """Replace days of the table at ``path`` by the rows of ``df``; other days stay.

    ``days`` names the days to replace: one without rows becomes an empty
    day, and a row of any other day is an error.  Without it the days found
    in ``df`` are replaced.  The rows are written to a staging folder that
    readers don't see, and its renaming is the point of no return: a failure
    before it leaves the table as it was, one after it is finished by the
    next call (or ``finish_publish``).  A re-run gives the same table.  One
    writer at a time.  ``rebalance`` (for writes of many days) lets adaptive
    execution size the files per day, at the cost of one shuffle; without it
    every task writes one file per day it holds.
    """
    spark = df.sparkSession
    finish_publish(spark, path)
    if rebalance:
        df = df.hint("rebalance", day_col)
    run = uuid.uuid4().hex
    staging = f"{path}/_staging-{run}"
    with shuffles_freed(spark):
        df.write.partitionBy(day_col).parquet(staging)
    if days is not None:
        wanted, found = {f"{day_col}={d}" for d in days}, {n for n in child_names(spark, staging) if "=" in n}
        if found - wanted:
            remove_path(spark, staging)
            raise ValueError(f"rows of days that are not to be replaced: {sorted(found - wanted)}")
        for name in sorted(wanted - found):
            df.drop(day_col).limit(0).coalesce(1).write.parquet(f"{staging}/{name}")
    rename_path(spark, staging, f"{path}/_ready-{run}")
    finish_publish(spark, path)


def finish_publish(spark, path: str) -> None:
    """Move the days of every complete staging folder of the table into their places.

    Each day is swapped by a rename; days already moved are no longer in the
    folder, so this can be broken off and repeated at any point.
    """
    for ready in (n for n in child_names(spark, path) if n.startswith("_ready-")):
        for day in (n for n in child_names(spark, f"{path}/{ready}") if "=" in n):
            swap_in(spark, f"{path}/{ready}/{day}", f"{path}/{day}")
        remove_path(spark, f"{path}/{ready}")


def read_table(spark, path: str, day_col: str = "ds") -> DataFrame:
    """Read a day-partitioned parquet table with ``ds`` kept as a string.

    Partition discovery would otherwise type yyyy-MM-dd folders as dates.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    inferred = spark.read.parquet(path).schema
    fields = [StructField(f.name, StringType(), True) if f.name == day_col else f for f in inferred.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def _own_tables(spark) -> str:
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def clear_tables(spark) -> None:
    """Delete the tables that this application wrote with ``materialize`` outside of any run.

    Call it when the results built on them are written: until then Spark
    reads them again, also after the loss of an executor.
    """
    remove_path(spark, _own_tables(spark))


#: the run whose folder takes the intermediate tables: its path, and how many it has so far
_RUN: ContextVar[tuple[str, list] | None] = ContextVar("pagefeatures_run", default=None)


@contextmanager
def run_folder(spark, name: str | None = None):
    """Intermediate tables of one run: dropped when the run succeeds, kept when it fails.

    Everything ``materialize`` writes inside the ``with`` block goes to one
    folder, so results built on it must be written before the block ends.
    A run with a ``name`` that failed finds its finished tables again when
    it is started with that name and does not compute them twice; the name
    must therefore stand for the same inputs.
    """
    folder = f"{shared_dir(spark)}/runs/{name or uuid.uuid4().hex}"
    token = _RUN.set((folder, []))
    try:
        yield folder
    finally:
        _RUN.reset(token)
    remove_path(spark, folder)


@contextmanager
def step_folder(spark):
    """Intermediate tables of one step of the run that is under way: dropped when the step succeeds.

    For tables that nothing reads after the step, which a run of many steps
    would otherwise keep until its end.  A step that failed keeps its tables
    with those of the run.
    """
    run = _RUN.get()
    if run:
        run[1].append("step")
        folder = f"{run[0]}/{len(run[1])}-step"
    else:
        folder = f"{_own_tables(spark)}/step-{uuid.uuid4().hex}"
    token = _RUN.set((folder, []))
    try:
        yield folder
    finally:
        _RUN.reset(token)
    remove_path(spark, folder)


def current_run() -> str | None:
    """Folder of the run that is under way, if any."""
    run = _RUN.get()
    return run[0] if run else None


def materialize(spark, df: DataFrame, name: str, day_col: str | None = "ds",
                rebalance: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of
    recomputing the joins behind it) and lets every later reader prune
    columns and days, which an RDD checkpoint would not.  The table belongs
    to the current ``run_folder``; outside of one it is this application's
    own and stays until ``clear_tables``.
    """
    run = _RUN.get()
    if run:
        run[1].append(name)
        path = f"{run[0]}/{len(run[1])}-{name}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            return spark.read.schema(df.schema).parquet(path)
    else:
        path = f"{_own_tables(spark)}/{name}-{uuid.uuid4().hex}"
    partitioned = bool(day_col) and day_col in df.columns
    if partitioned and rebalance:
        df = df.hint("rebalance", day_col)
    w = df.write.mode("overwrite")
    if partitioned:
        # the whole table is new, also where a failed attempt left some of it
        w = w.option("partitionOverwriteMode", "static").partitionBy(day_col)
    with days_side_by_side(spark), shuffles_freed(spark):
        w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
