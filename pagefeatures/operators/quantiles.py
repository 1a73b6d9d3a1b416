"""Exact grouped quantiles: one method for every group size.

The quantile of probability p in a group of n values is the smallest value
whose rank reaches ``p * n``.  It is found without sorting a group:

1. rows are counted by (group, value); copies combine on the map side;
2. the counts are dealt out by (group, bucket), a bucket being 1/65,536 of a
   unit of the value; the buckets' sums, run over each group, tell the
   bucket of every rank;
3. only the values inside these buckets are ranked, where they already lie.

No task holds a group: the running sums have one row for each bucket, the
ranking the distinct values of one bucket.  Results don't depend on group
size, partitioning or the run.  NULL and NaN values are missing values.

A group is one struct column: its parts may be NULL, the struct is not, so
joins on it are plain equalities that keep the partitioning of step 2.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS_PER_UNIT = 65_536
_FAR = 1e12  # values beyond share the outermost buckets
_MISSING = -(1 << 62)  # bucket of missing values, before all others


def _present(col: str) -> Column:
    v = F.col(col).cast("double")
    return F.when(~F.isnan(v), v)


def _group(keys: Sequence[str], *more: Column) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *more)


def _rank(p: float, total: str) -> Column:
    """Rank of probability ``p`` among ``total`` values: p * total rounded up, 1 at least (whole numbers only)."""
    share = Fraction(str(p))
    over, of = share.numerator, share.denominator
    return F.greatest(F.expr(f"({total} div {of}) * {over} + ({total} % {of} * {over} + {of - 1}) div {of}"), F.lit(1).cast("long"))


def _ranked(rows: DataFrame, probs: Sequence[float], std: bool = False, few: bool = False) -> DataFrame:
    """(_g, _v, _rows, _hit0, _hit1, ...) from counted rows (_g, _v, _n): the values that a rank falls on.

    ``_hit{i}`` tells whether the i-th probability's rank does, ``_rows``
    counts all rows of the group.  A group without values has one row.
    ``std`` adds ``_std``, the group's population standard deviation, from
    sums that each bucket takes from its lower limit.  ``few``: a group's
    value comes in few rows only, so these are added up in their bucket and
    not before, which saves a shuffle.
    """
    near = F.least(F.greatest(F.col("_v"), F.lit(-_FAR)), F.lit(_FAR))
    bucket = F.coalesce(F.floor(near * F.lit(float(BUCKETS_PER_UNIT))), F.lit(_MISSING))
    added = F.sum("_n").alias("_n")
    if few:
        counts = rows.withColumn("_bucket", bucket).repartition("_g", "_bucket").groupBy("_g", "_bucket", "_v").agg(added)
    else:
        counts = rows.groupBy("_g", "_v").agg(added).withColumn("_bucket", bucket).repartition("_g", "_bucket")
    group = Window.partitionBy("_g")
    upto = Window.unboundedPreceding, Window.currentRow
    places = range(len(probs))

    def hits(n: str) -> list[Column]:
        """Whether each rank is among the ``n`` ranks that end at ``_upto``."""
        return [(F.col(f"_rank{i}") <= F.col("_upto")) & (F.col(f"_rank{i}") > F.col("_upto") - F.col(n)) for i in places]

    low = F.col("_bucket") / F.lit(float(BUCKETS_PER_UNIT))
    sums = [F.sum("_n").alias("_n"), F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("_m")]
    if std:
        sums += [F.sum((F.col("_v") - low) * F.col("_n")).alias("_s"), F.sum((F.col("_v") - low) ** 2 * F.col("_n")).alias("_ss")]
    buckets = (counts.groupBy("_g", "_bucket").agg(*sums)
               .withColumn("_upto", F.sum("_m").over(group.orderBy("_bucket").rowsBetween(*upto)))
               .withColumns({"_rows": F.sum("_n").over(group), "_total": F.sum("_m").over(group)})
               .withColumns({f"_rank{i}": _rank(p, "_total") for i, p in enumerate(probs)}))
    if std:
        within = low + F.try_divide(F.col("_s"), F.col("_m"))
        buckets = (buckets.withColumn("_mean", F.try_divide(F.sum(within * F.col("_m")).over(group), F.col("_total")))
                   .withColumn("_std", F.sqrt(F.try_divide(F.sum(
                       F.greatest(F.col("_ss") - F.try_divide(F.col("_s") ** 2, F.col("_m")), F.lit(0.0))
                       + F.col("_m") * (within - F.col("_mean")) ** 2).over(group), F.col("_total")))))
    shown = ["_rows", *["_std"] * std]
    wanted = (buckets.where(reduce(or_, hits("_m"), F.col("_total") == 0))
              .select("_g", "_bucket", *shown, (F.col("_upto") - F.col("_m")).alias("_before"), *[f"_rank{i}" for i in places]))
    inside = (counts.join(wanted, ["_g", "_bucket"])
              .withColumn("_upto", F.col("_before") + F.sum("_n").over(
                  Window.partitionBy("_g", "_bucket").orderBy("_v").rowsBetween(*upto))))
    return (inside.where(reduce(or_, hits("_n"), F.col("_v").isNull()))
            .select("_g", "_v", *shown, *[h.alias(f"_hit{i}") for i, h in enumerate(hits("_n"))]))


def counted_quantiles(counts: DataFrame, keys: Sequence[str], value: str, n: str, probs: Sequence[float],
                      names: Sequence[str], count_name: str = "num", few: bool = False) -> DataFrame:
    """Quantiles of ``value`` per ``keys`` group from rows that stand for ``n`` rows each.

    Counts of several tables (days, say) may simply be united: the same
    group and value may come in any number of rows.  ``few`` says that they
    come in few (one for each table); it changes the plan, not the result.
    """
    rows = counts.select(_group(keys).alias("_g"), _present(value).alias("_v"), F.col(n).alias("_n"))
    found = _ranked(rows, probs, few=few).groupBy("_g").agg(
        F.max("_rows").alias(count_name),
        *[F.max(F.when(F.col(f"_hit{i}"), F.col("_v"))).alias(name) for i, name in enumerate(names)])
    return found.select(*[F.col(f"_g.k{i}").alias(k) for i, k in enumerate(keys)], *names, count_name)


def grouped_quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                      probs: Sequence[float], *, names: dict | None = None,
                      count_name: str | None = "num", std: bool = False) -> DataFrame:
    """Quantiles of each column in ``values`` per ``keys`` group.

    Output: ``keys``, one column per (value, prob) named by
    ``names[value][i]`` (default ``{value}_q{i}``), optionally the population
    standard deviation ``{value}_std`` of each value, and ``count_name`` =
    rows per group (missing values included, as ``count(1)``).  A group
    without values has NULL quantiles.
    """
    keys, values = list(keys), list(values)
    names = names or {v: [f"{v}_q{i}" for i in range(len(probs))] for v in values}
    # several columns share the steps: one narrow row for each column's value
    each = [F.struct(_group(keys, F.lit(j).alias("of")).alias("_g"), _present(v).alias("_v"), F.lit(1).cast("long").alias("_n"))
            for j, v in enumerate(values)]
    found = _ranked(df.select(F.inline(F.array(*each))) if len(each) > 1 else df.select(each[0].alias("x")).select("x.*"), probs, std)
    out = found.groupBy(*[F.col(f"_g.k{i}").alias(f"_k{i}") for i in range(len(keys))]).agg(
        F.max("_rows").alias("_rows"),
        *[F.max(F.when(F.col("_g.of") == j, F.col("_std"))).alias(f"_std{j}") for j in range(len(values)) if std],
        *[F.max(F.when((F.col("_g.of") == j) & F.col(f"_hit{i}"), F.col("_v"))).alias(f"_q{j}_{i}")
          for j in range(len(values)) for i in range(len(probs))])
    cols = [F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]
    for j, v in enumerate(values):
        cols += [F.col(f"_q{j}_{i}").alias(n) for i, n in enumerate(names[v])]
        cols += [F.col(f"_std{j}").alias(f"{v}_std")] if std else []
    if count_name:
        cols.append(F.col("_rows").alias(count_name))
    return out.select(*cols)
