"""Helpers that several operators share: columns, written tables, word caches."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir, ship_package
from ..sources.tables import current_run

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(col: str | Column) -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays.

    A text without multi-byte characters takes Spark's byte-wise ``lower``,
    which is the same there and several times faster than ``translate``.
    """
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    ship_package(spark)


def clear_shared(spark: SparkSession) -> None:
    """Delete the tables this application wrote with ``stored``.

    Call it when the results built on them are written; until then Spark
    re-reads them, also after the loss of an executor.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm-tables/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, partition_by: str | None = None, result: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: later steps, and retries after the loss of an
    executor, read the table and don't repeat the work behind it.  Within
    ``sources.tables.run_folder`` the table goes with the run, unless it is
    the run's ``result``.
    """
    spark = df.sparkSession
    path = f"{(not result and current_run()) or _root(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, limit: str = "2m"):
    """Python tasks that run within the block get their rows in Arrow batches of about ``limit`` bytes, or one longer row.

    By Spark's default a batch may take 64 MB, which both the executor and
    its Python worker hold, each with copies of their own.  The setting is
    put back at the end of the block.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class WordCache(dict):
    """word -> value, computed on first use and bounded in size.

    It keeps two generations of at most ``limit`` words.  When the young one
    is full it becomes the old one, and words found there move back, so
    frequent words stay while rare ones leave.  Words longer than
    ``longest`` characters are computed each time.
    """

    def __init__(self, compute, limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value
