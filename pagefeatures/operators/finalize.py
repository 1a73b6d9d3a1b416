"""Final training rows: band products, strictness classes, fixed layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import config as C
from ..functions.columns import band_products, expected_contacts, strictness_classes


def final_rows(joined: DataFrame, layout: Sequence[str] = C.FINAL_COLUMNS,
               limits: dict = C.STRICT_LIMITS, q3_uses_q1: bool = True,
               n_bands: int = C.N_BANDS, day_col: str = "ds") -> DataFrame:
    """The 190-column rows (plus the day) in ``layout`` order.

    Adds ``multi_pct{b} = nvl(pct{b} * pct{b}_ratio, 0)`` and their sum
    ``pct_sum``, and replaces the three strictness ratios by their classes.
    Columns are resolved by name and then ordered, so the output order is
    the layout's whatever the input order.
    """
    counts = [f"pct{b}" for b in range(1, n_bands + 1)]
    ratios = [f"pct{b}_ratio" for b in range(1, n_bands + 1)]
    prods = band_products(counts, ratios)
    c1, c2, c3 = strictness_classes("q1_strict", "q2_strict", "q3_strict", limits, q3_uses_q1)
    derived = {f"multi_pct{b}": prods[b - 1] for b in range(1, n_bands + 1)}
    derived["pct_sum"] = expected_contacts(counts, ratios)
    derived["q1_strict"], derived["q2_strict"], derived["q3_strict"] = c1, c2, c3
    cols = [(derived[c] if c in derived else F.col(c)).alias(c) for c in layout]
    return joined.select(*cols, day_col)


def to_text_layout(rows: DataFrame) -> DataFrame:
    """Rename ``pos`` to ``position``, the name the training text uses."""
    return rows.withColumnRenamed("pos", "position")
