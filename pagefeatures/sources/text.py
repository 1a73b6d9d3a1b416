"""Training text: one tab-separated folder per day (``<base>/ds=<day>``), NULL written as ``\\N``.

The text has no header and no types; the layout (``config.TEXT_COLUMNS``)
and the types below are the contract between writer and reader.  Reading
with an explicit schema lets the CSV scan parse only the selected columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from .. import config as C, dates
from ..operators.finalize import to_text_layout
from ..session import days_side_by_side, path_exists, shuffles_freed

SEP = "\t"
NULL = "\\N"
_LONG = {"boss_id", "job_id", "page", "num", "addf_num", "suc_num",
         "job_addf_num_3days", "boss_addf_num_3days", "cp_addf_num_3days",
         *(f"pct{b}" for b in range(1, C.N_BANDS + 1))}
_INT = {"list_hour", "weekday", "q1_strict", "q2_strict", "q3_strict", "q1_base", "q2_base",
        "q3_base", "business_type", *C.PROFILE_INT_COLUMNS}
_STRING = {"sessionid", "city", "pos", "position", "cp", *C.PROFILE_STRING_COLUMNS}


def column_type(name: str) -> DataType:
    if name in _LONG:
        return LongType()
    if name in _INT:
        return IntegerType()
    if name in _STRING:
        return StringType()
    if name == "date":
        return DateType()
    return DoubleType()


def text_schema(layout: Sequence[str] = C.TEXT_COLUMNS) -> StructType:
    return StructType([StructField(c, column_type(c), True) for c in layout])


def day_path(base: str, day: str) -> str:
    return f"{base.rstrip('/')}/ds={day}"


def _writable(name: str):
    refused = F.raise_error(F.lit(f"{name}: the text \\N stands for NULL"))
    return F.when(F.col(name) == F.lit(NULL), refused).otherwise(F.col(name)).alias(name)


def write_text(rows: DataFrame, base: str, days=None, day_col: str = "ds") -> None:
    """Write final rows as one text folder per day, in one job.

    Dynamic partition overwrite replaces only the days present in ``rows``
    (or in ``days``); other day folders stay.  The files hold the 190 layout
    columns only: the day is the folder.  A string that equals the mark of
    NULL is an error, since it would come back as NULL.
    """
    if days is not None:
        rows = rows.where(F.col(day_col).isin(list(days)))
    laid_out = to_text_layout(rows)
    out = laid_out.select(*[_writable(c) if isinstance(laid_out.schema[c].dataType, StringType) else F.col(c)
                            for c in C.TEXT_COLUMNS], F.col(day_col).alias("ds"))
    with days_side_by_side(out.sparkSession), shuffles_freed(out.sparkSession):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("sep", SEP).option("nullValue", NULL).option("header", False)
            .option("escape", '"')  # a quote inside a field is doubled, as its other readers expect
            .partitionBy("ds").csv(base))


def write_text_day(rows: DataFrame, base: str, day: str, day_col: str = "ds") -> None:
    """Write (or replace) one day's folder."""
    write_text(rows, base, [day], day_col)


def existing_days(spark: SparkSession, base: str, lo: str, hi: str, shift_days: int = 0) -> list[str]:
    """Days in lo..hi (shifted by ``shift_days``) whose folder exists; missing days are skipped."""
    return [d for d in dates.training_days(lo, hi, shift_days)
            if path_exists(spark, day_path(base, d))]


def read_text(spark: SparkSession, paths: Sequence[str], cols: Sequence[str] | None = None,
              layout: Sequence[str] = C.TEXT_COLUMNS) -> DataFrame:
    """Read day folders in one scan; adds ``ds`` from the folder name."""
    df = (spark.read.schema(text_schema(layout)).option("sep", SEP).option("nullValue", NULL)
          .option("escape", '"').option("header", False).option("mode", "FAILFAST").csv(list(paths)))
    ds = F.regexp_extract(F.col("_metadata.file_path"), r"ds=(\d{4}-\d{2}-\d{2})", 1)
    return df.select(*(cols or layout), ds.alias("ds"))


def read_days(spark: SparkSession, base: str, lo: str, hi: str, shift_days: int = 0,
              cols: Sequence[str] | None = None) -> DataFrame:
    """All existing day folders of lo..hi as one DataFrame."""
    days = existing_days(spark, base, lo, hi, shift_days)
    if not days:
        return spark.createDataFrame([], text_schema()).select(*(cols or C.TEXT_COLUMNS)).withColumn(
            "ds", F.lit(None).cast("string"))
    return read_text(spark, [day_path(base, d) for d in days], cols)
