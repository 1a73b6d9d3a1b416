import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagefeatures.operators.bands import band_ratio, band_ratio_wide
from pagefeatures.operators.quantiles import _rank, grouped_quantiles

SCHEMA = "boss_city string, boss_position string, ctr_score double, deal_type string"


def rows_for(city, n, score, contacts):
    return [(city, "eng", score, "addf" if i < contacts else "list") for i in range(n)]


def test_ratio_threshold_strict(spark):
    rows = (rows_for("A", 300, 0.15, 30) + rows_for("B", 301, 0.15, 30)
            + rows_for("A", 150, 0.45, 15) + rows_for("B", 151, 0.45, 151))
    df = spark.createDataFrame(rows, SCHEMA)
    long = {(r.cp, r.band): (r.addf_ratio, r.num) for r in band_ratio(df, by=()).collect()}
    assert long == {("B-eng", 2): (30 / 301, 301), ("B-eng", 5): (1.0, 151)}
    wide = {r.cp: r for r in band_ratio_wide(df, by=()).collect()}
    assert set(wide) == {"B-eng"}
    assert wide["B-eng"].pct2_ratio == 30 / 301 and wide["B-eng"].pct1_ratio is None


def disc(vals, p):
    v = sorted(vals)
    return v[max(0, math.ceil(p * len(v)) - 1)]


def test_quantiles_exact(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.random()) for k in range(20) for _ in range(rnd.randint(1, 400))]
    rows += [(None, 0.25), (None, 0.75), (21, -3.5), (21, 1e300), (21, -1e300), (21, float("inf"))]
    df = spark.createDataFrame(rows, "k long, v double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: r for r in grouped_quantiles(df, ["k"], ["v"], probs).collect()}
    for k in {k for k, _ in rows}:
        vals = [v for kk, v in rows if kk == k]
        assert got[k].num == len(vals)
        assert [got[k][f"v_q{i}"] for i in range(5)] == [disc(vals, p) for p in probs]


def test_quantiles_of_a_large_group_are_exact_and_repeatable(spark):
    n = 300_000
    df = spark.range(n).select(F.lit(1).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)).alias("v"))
    want = df.select(F.percentile("v", F.lit(0.5)).alias("m")).first().m
    runs = [tuple(grouped_quantiles(df.repartition(p), ["k"], ["v"], [0.25, 0.5, 0.75]).first()) for p in (3, 16)]
    assert runs[0] == runs[1] and runs[0][-1] == n and abs(runs[0][2] - want) < 1e-5
    below = df.select(*[F.count_if(F.col("v") <= runs[0][i]).alias(f"n{i}") for i in (1, 2, 3)]).first()
    assert tuple(below) == (n // 4, n // 2, n * 3 // 4)


def test_nan_is_missing(spark):
    rows = [(1, float("nan")), (1, 1.0), (1, 2.0), (1, 3.0), (2, float("nan")), (2, None)]
    got = {r.k: r for r in grouped_quantiles(spark.createDataFrame(rows, "k long, v double"), ["k"], ["v"], [0.5], std=True).collect()}
    assert (got[1].v_q0, got[1].num) == (2.0, 4) and got[1].v_std == pytest.approx(np.std([1, 2, 3]))
    assert (got[2].v_q0, got[2].v_std, got[2].num) == (None, None, 2)


def test_std_matches_population_std(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.gauss(k, 1 + k)) for k in range(3) for _ in range(500)] + [(3, None)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    got = {r.k: r for r in grouped_quantiles(df, ["k"], ["v"], [0.5], std=True).collect()}
    for k in range(3):
        vals = np.array([v for kk, v in rows if kk == k])
        assert got[k].v_std == pytest.approx(vals.std(), rel=1e-9)
    assert got[3].v_std is None and got[3].v_q0 is None and got[3].num == 1


def test_quantiles_shuffle_the_counts_once_for_both_uses(spark):
    df = spark.createDataFrame([(i % 5, float(i)) for i in range(100)], "k long, v double")
    out = grouped_quantiles(df, ["k"], ["v"], [0.25, 0.5])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count(" ReusedExchange ") == 1
    assert plan.count("Exchange hashpartitioning") - 1 == 4  # by value, by bucket, by group, by key


def test_whole_number_ranks(spark):
    for n in (1, 2, 3, 7, 100, 10**15 + 1):
        for p in (0.0, 0.1, 0.25, 0.75, 0.9, 1.0):
            got = spark.range(1).select(_rank(p, f"{n}L").alias("r")).first().r
            assert got == max(1, math.ceil(Fraction(str(p)) * n))


def test_place_quartiles_count_rows_once(spark, tmp_path):
    """Both reads of the score counts share their stages; a NULL key has no quartiles, though its rows have some."""
    from pagefeatures.operators.features import entity_quartiles, place_quartiles
    spark.sql("""SELECT '2020-07-25' AS ds, e.entity, IF(e.entity = 'job', id % 3, NULL) AS job_id,
                        IF(e.entity = 'boss' AND id % 2 = 0, id % 4, NULL) AS boss_id, IF(e.entity = 'cp', 'c', NULL) AS cp,
                        id / 40D AS score, 1L AS n
                 FROM range(40) LATERAL VIEW explode(array('job', 'boss', 'cp')) e AS entity""").write.parquet(f"{tmp_path}/counts")
    places = spark.createDataFrame([("2020-07-25", 0, 0, "c"), ("2020-07-25", 1, None, "c"), ("2020-07-25", None, 2, None)],
                                   "ds string, job_id long, boss_id long, cp string")
    out = place_quartiles(places, entity_quartiles(spark.read.parquet(f"{tmp_path}/counts")))
    rows = {(r.job_id, r.boss_id, r.cp): r for r in out.collect()}
    assert rows[0, 0, "c"].boss_addf_num_3days == 10 and rows[0, 0, "c"].job_addf_num_3days == 14
    assert rows[1, None, "c"].boss_addf_num_3days is None and rows[1, None, "c"].addf_boss_score_q1_3days is None
    assert rows[1, None, "c"].cp_addf_num_3days == 40
    assert rows[None, 2, None].job_addf_num_3days is None and rows[None, 2, None].cp_addf_num_3days is None
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_united_counts_need_one_shuffle_less(spark):
    """Rows that are counts of a few tables are added up in their bucket, with the same result."""
    from pyspark.sql import functions as F
    from pagefeatures.operators.quantiles import counted_quantiles

    rows = spark.range(900).select(F.when(F.col("id") % 5 != 0, F.col("id") % 5).alias("k"),
                                   F.when(F.col("id") % 11 != 0, (F.col("id") % 37) / 37).alias("v"),
                                   (F.col("id") % 4 + 1).alias("n"))
    rows = rows.unionByName(spark.sql("SELECT 9L AS k, CAST('NaN' AS DOUBLE) AS v, 2L AS n"))
    a, b = [counted_quantiles(rows, ["k"], "v", "n", (0.25, 0.5, 0.75), ["q1", "q2", "q3"], few=few) for few in (False, True)]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and b.count() == 6
    exchanges = [d._jdf.queryExecution().sparkPlan().toString().count("Exchange")
                 + d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (a, b)]
    assert exchanges[1] < exchanges[0]
