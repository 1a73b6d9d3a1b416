"""Column -> Column helpers (scalar expressions of the pipeline).

All are built-in Catalyst expressions, so they compile into whole-stage
code; none needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import config as C

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weekday_number(ts: ColumnOrName) -> Column:
    """Day of week, 0 = Sunday ... 6 = Saturday.

    Same as ``pmod(datediff(t, '1920-01-01') - 3, 7)``: 1920-01-01 was a
    Thursday.
    """
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def composite_key(*cols: ColumnOrName, sep: str = "-") -> Column:
    """``concat_ws(sep, ...)``: NULL parts are skipped, never NULL itself."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def flag_in(col: ColumnOrName, values: Sequence[str]) -> Column:
    """1 when ``col`` is one of ``values``, else 0 (NULL gives 0)."""
    return F.when(_c(col).isin(list(values)), F.lit(1)).otherwise(F.lit(0))


def outcome_flags(col: ColumnOrName, contact: Sequence[str] = C.CONTACT_TYPES,
                  success: Sequence[str] = C.SUCCESS_TYPES) -> tuple[Column, Column]:
    """(contact flag, success flag) of an outcome column."""
    return flag_in(col, contact), flag_in(col, success)


def score_band(score: ColumnOrName, edges: Sequence[float] = C.BAND_EDGES) -> Column:
    """Band 1..len(edges)+1 of a score, half-open ``lo <= s < hi``.

    Band 1 has no lower limit (negative scores fall in it), the last band no
    upper limit; a NULL or NaN score has no band (NULL).
    """
    s = F.when(~F.isnan(_c(score)), _c(score))
    expr = F.when(s < F.lit(float(edges[0])), F.lit(1))
    for i, e in enumerate(edges[1:], start=2):
        expr = expr.when(s < F.lit(float(e)), F.lit(i))
    return expr.when(s >= F.lit(float(edges[-1])), F.lit(len(edges) + 1))


def fallback(*cols: ColumnOrName) -> Column:
    """First non-NULL value (``nvl(a, nvl(b, c))``)."""
    return F.coalesce(*[_c(c) for c in cols])


def strictness(job_q: ColumnOrName, boss_q: ColumnOrName, cp_q: ColumnOrName) -> Column:
    """Relative strictness ``nvl(job_q, boss_q) / cp_q - 1``.

    No fallback to the cp quantile in the numerator; a zero or NULL divisor
    gives NULL (``try_divide``) instead of an ANSI error.
    """
    return F.try_divide(F.coalesce(_c(job_q), _c(boss_q)), _c(cp_q)) - F.lit(1)


def ladder(scores: Sequence[ColumnOrName], q: ColumnOrName) -> Column:
    """How many of the page's scores are >= the reference quantile ``q``.

    A NULL ``q`` gives 0.  For ascending, non-NULL scores this equals the
    original ladder of comparisons from the highest score down.
    """
    qc = _c(q)
    hits = [F.when(_c(s) >= qc, F.lit(1)).otherwise(F.lit(0)) for s in scores]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return F.when(qc.isNull(), F.lit(0)).otherwise(total).cast("int")


def page_weight(page: ColumnOrName, steps: Sequence[tuple[int, float]] = C.PAGE_WEIGHT_STEPS,
                default: float = C.PAGE_WEIGHT_DEFAULT) -> Column:
    """Weight of a page number: first step whose limit is >= page."""
    p = _c(page)
    (lim0, w0), rest = steps[0], steps[1:]
    expr = F.when(p <= F.lit(lim0), F.lit(float(w0)))
    for lim, w in rest:
        expr = expr.when(p <= F.lit(lim), F.lit(float(w)))
    return expr.otherwise(F.lit(float(default)))


def strictness_class(ratio: ColumnOrName, lower: float, upper: float,
                     test: ColumnOrName | None = None) -> Column:
    """Class 1 (below ``lower``), 2 (below ``upper``), 3 (above ``upper``), else 0.

    Equality with ``upper`` and NULL fall to 0.  ``test`` is the column of the
    first comparison; it defaults to ``ratio`` (see ``strictness_classes``).
    """
    r = _c(ratio)
    t = r if test is None else _c(test)
    return (F.when(t < F.lit(float(lower)), F.lit(1))
             .when(r < F.lit(float(upper)), F.lit(2))
             .when(r > F.lit(float(upper)), F.lit(3))
             .otherwise(F.lit(0)))


def strictness_classes(q1: ColumnOrName, q2: ColumnOrName, q3: ColumnOrName,
                       limits: dict = C.STRICT_LIMITS, q3_uses_q1: bool = True) -> tuple[Column, Column, Column]:
    """Classes of the three strictness ratios.

    ``q3_uses_q1=True`` keeps the original rule, whose first q3 branch tests
    the q1 ratio; ``False`` tests q3 throughout.
    """
    c1 = strictness_class(q1, *limits["q1"])
    c2 = strictness_class(q2, *limits["q2"])
    c3 = strictness_class(q3, *limits["q3"], test=q1 if q3_uses_q1 else None)
    return c1, c2, c3


def band_products(counts: Sequence[ColumnOrName], ratios: Sequence[ColumnOrName]) -> list[Column]:
    """``nvl(count_i * ratio_i, 0)`` per band."""
    return [F.coalesce(_c(n) * _c(r), F.lit(0.0)) for n, r in zip(counts, ratios)]


def expected_contacts(counts: Sequence[ColumnOrName], ratios: Sequence[ColumnOrName]) -> Column:
    """Sum of the band products, left to right (expected contacts of a page)."""
    prods = band_products(counts, ratios)
    total = prods[0]
    for p in prods[1:]:
        total = total + p
    return total


def hash_bucket(col: ColumnOrName, n: int) -> Column:
    """Stable bucket of a value's text: first 60 bits of its MD5, modulo ``n``.

    Any engine with MD5 can reproduce the bucket, so a serving system and the
    training rows agree.  NULL hashes as the text "0" (the fill default).
    """
    s = F.coalesce(_c(col).cast("string"), F.lit("0"))
    return F.pmod(F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint"), F.lit(n))


def mean_rounded(cols: Sequence[ColumnOrName], digits: int = 3) -> Column:
    """Mean of the non-NULL values of ``cols``, rounded half-up to ``digits``.

    Summed as decimals, so the result does not depend on the order of a
    floating-point sum (a mean of exactly x.xxx5 always rounds up).
    NaN counts as missing, like NULL; NULL when every value is missing.
    """
    dec = "decimal(30,15)"
    total = None
    count = None
    for c in cols:
        v = F.when(~F.isnan(_c(c)), _c(c))
        s = F.coalesce(v.cast(dec), F.lit(0).cast(dec))
        n = F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = s if total is None else total + s
        count = n if count is None else count + n
    return F.round(F.try_divide(total, count), digits).cast("double")
