"""Threshold report: score quantiles by label, for choosing bucket limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import config as C
from .quantiles import grouped_quantiles

PROB_NAMES = ("q25", "q50", "q75", "q90")


def threshold_report(rows: DataFrame, cols: Sequence[str] = C.REPORT_COLUMNS, label: str = "addf_num",
                     probs: Sequence[float] = C.REPORT_PROBS, limit: int = C.REPORT_LIMIT,
                     prob_names: Sequence[str] = PROB_NAMES) -> DataFrame:
    """Per label value and column: quantiles, population std and row count.

    Output: (feature, q25, q50, q75, q90, std, <label>, num), the ``limit``
    smallest labels per feature.  Every label group is large, since
    there are only as many groups as label values; the quantiles are exact
    whatever their size.  The label groups are
    the same for every feature, so the limit is taken once, before the
    unpivot (a top-k of ``limit`` rows, not a global sort).
    """
    names = {c: [f"{c}__{n}" for n in prob_names] for c in cols}
    stats = grouped_quantiles(rows, [label], cols, probs, names=names, count_name="num", std=True)
    top = stats.orderBy(label).limit(limit)
    per_feature = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 *[F.col(names[c][i]).alias(n) for i, n in enumerate(prob_names)],
                 F.col(f"{c}_std").alias("std"))
        for c in cols])
    return (top.select(F.col(label), F.col("num"), F.inline(per_feature))
            .select("feature", *prob_names, "std", label, "num"))


def write_report(report: DataFrame, path: str) -> None:
    """Write the report as one small CSV file (at most ``limit`` x columns rows)."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
