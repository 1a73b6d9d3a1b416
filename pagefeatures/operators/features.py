"""Score quartiles of contacted impressions by job, boss or segment.

``score_counts`` is the additive form: how often each score occurs, by day
and key, for the three key sets at once.  It is computed once for a source
day and can be stored; the quartiles of any look-back come from the united
counts of its days (``entity_quartiles``), one histogram for all three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import config as C
from ..functions.columns import composite_key
from .quantiles import counted_quantiles, grouped_quantiles

# entity -> (key column, name used in the output columns)
ENTITIES = {"job": "job_id", "boss": "boss_id", "cp": "cp"}


def score_quartiles(info: DataFrame, entity: str = "job", probs: Sequence[float] = (0.25, 0.5, 0.75),
                    types: Sequence[str] = C.QUARTILE_TYPES, score_col: str = "ctr_score",
                    by: Sequence[str] = ("ds",)) -> DataFrame:
    """Quartiles and count of contacted scores per job / boss / cp.

    Output: by..., key, ``addf_{entity}_score_q{1..3}_3days``, ``num``
    (``by`` defaults to ``ds``, the target day of look-back rows).  Rows are
    those whose outcome is in ``types`` (``p_success`` is not one of them,
    unlike the contact flag).  NaN scores count as rows but not as values.
    """
    key = ENTITIES[entity]
    rows = _quartile_rows(info, types, score_col, by).select(*by, key, score_col)
    names = {score_col: [f"addf_{entity}_score_q{i + 1}_3days" for i in range(len(probs))]}
    return grouped_quantiles(rows, [*by, key], [score_col], probs, names=names, count_name="num")


def _quartile_rows(info: DataFrame, types: Sequence[str], score_col: str, by: Sequence[str]) -> DataFrame:
    return (info.where(F.col("deal_type").isin(list(types)))
            .select(*by, "job_id", "boss_id", composite_key("boss_city", "boss_position").alias("cp"), score_col))


def entity_scores(info: DataFrame, types: Sequence[str] = C.QUARTILE_TYPES, score_col: str = "ctr_score",
                  by: Sequence[str] = ("ds",)) -> DataFrame:
    """(by..., entity, job_id, boss_id, cp, score, n = 1): each contacted row once for each of its three keys.

    Of the three keys only the entity's own is filled.  A NULL key is a
    key, a NULL or NaN score counts as a NULL one.
    """
    rows = _quartile_rows(info, types, score_col, by)
    kinds = {k: rows.schema[k].dataType for k in ENTITIES.values()}
    each = [F.struct(F.lit(e).alias("entity"), *[(F.col(k) if k == key else F.lit(None).cast(kinds[k])).alias(k)
                                                 for k in ENTITIES.values()]) for e, key in ENTITIES.items()]
    score = F.when(~F.isnan(score_col), F.col(score_col)).alias("score")
    return rows.select(*by, score, F.lit(1).cast("long").alias("n"), F.inline(F.array(*each)))


def score_counts(info: DataFrame, types: Sequence[str] = C.QUARTILE_TYPES, score_col: str = "ctr_score",
                 by: Sequence[str] = ("ds",)) -> DataFrame:
    """``entity_scores`` counted: how often contacted rows of a key have a score.  Additive over rows."""
    return (entity_scores(info, types, score_col, by)
            .groupBy(*by, "entity", *ENTITIES.values(), "score").agg(F.sum("n").alias("n")))


def entity_quartiles(counts: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75),
                     by: Sequence[str] = ("ds",), few: bool = False) -> DataFrame:
    """(by..., entity, job_id, boss_id, cp, q1.., num) of all three entities from their united score counts.

    ``few``: a key's score comes in few rows only, one for each source day (``score_counts``, not ``entity_scores``).
    """
    return counted_quantiles(counts, [*by, "entity", *ENTITIES.values()], "score", "n", probs,
                             [f"q{i + 1}" for i in range(len(probs))], few=few)


def quartile_name(entity: str, i: int) -> str:
    return f"addf_{entity}_score_q{i}_3days"


def place_quartiles(places: DataFrame, quartiles: DataFrame, n_probs: int = 3, day_col: str = "ds") -> DataFrame:
    """``places`` (day, job_id, boss_id, cp; distinct) with the quartiles and counts of their three keys.

    A place asks for three keys, so one join serves all entities; its answers
    come together again by place.  A NULL key has no quartiles: it asks for
    none.  Leaving NULL keys out of ``quartiles`` instead would be a filter
    that Spark moves into one of the two reads of their counts, which could
    then not share their stages, and all rows would be counted twice.
    """
    keys = list(ENTITIES.values())
    place = F.struct(day_col, *keys)
    asked = F.array(*[F.struct(F.lit(e).alias("entity"), *[F.when(F.lit(k == key), F.col(k)).alias(k) for k in keys])
                      for e, key in ENTITIES.items()])
    key = F.struct(day_col, "entity", *keys)
    known = quartiles.select(key.alias("_key"), *[f"q{i + 1}" for i in range(n_probs)], "num")
    named = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()
    rows = places.select(place.alias("_place"), day_col, F.inline(asked)).select("_place", "entity", F.when(named, key).alias("_key"))
    own = lambda e, c: F.max(F.when(F.col("entity") == e, F.col(c)))
    wide = rows.join(known, "_key", "left").groupBy("_place").agg(
        *[own(e, f"q{i + 1}").alias(quartile_name(e, i + 1)) for e in ENTITIES for i in range(n_probs)],
        *[own(e, "num").alias(f"{e}_addf_num_3days") for e in ENTITIES])
    return wide.select("_place.*", *[c for c in wide.columns if c != "_place"])
