from datetime import datetime

import pytest

from pagefeatures.operators.pages import page_samples

SCHEMA = ("boss_id long, job_id long, geek_id long, exp_id int, sessionid string, page long, rank string, "
          "list_time timestamp, boss_position string, boss_city string, ctcvr_score double, ctr_score double, "
          "deal_type string, ds string")
T = datetime(2020, 7, 25, 13, 15)


def impressions(job, n, scores=None, suc=None, pos="eng", city="A", session="s1", deal=None):
    scores = scores or [round(0.05 * (i + 1), 2) for i in range(n)]
    suc = suc or [0.01 * (i + 1) for i in range(n)]
    deal = deal or ["addf" if i % 3 == 0 else ("success" if i % 3 == 1 else "list") for i in range(n)]
    return [(1, job, 100 + i, 1, session, 1, str(i + 1), T, pos, city, suc[i], scores[i], deal[i], "2020-07-25")
            for i in range(n)]


def run(spark, rows, **kw):
    out = page_samples(spark.createDataFrame(rows, SCHEMA), **kw)
    return {r.job_id: r for r in out.collect()}


def test_full_page(spark):
    r = run(spark, impressions(1, 15))[1]
    assert r.num == 15 and r.addf_1 == 0.05 and r.addf_15 == 0.75
    assert [r[f"pct{b}"] for b in range(1, 9)] == [1, 2, 2, 2, 2, 2, 2, 2]
    assert r.addf_num == 10 and r.suc_num == 5
    assert r.weekday == 6 and r.list_hour == 13 and r.cp == "A-eng"
    assert sum(r[f"pct{b}"] for b in range(1, 9)) == 15


@pytest.mark.parametrize("n", [14, 16])
def test_wrong_size_dropped(spark, n):
    assert run(spark, impressions(1, n)) == {}


def test_negative_and_null_score_dropped(spark):
    neg = impressions(1, 15, scores=[-0.5] + [0.1] * 14)
    nul = impressions(2, 15, scores=[None] + [0.1] * 14)
    assert run(spark, neg + nul) == {}


def test_short_success_list(spark):
    suc = [0.1 * (i + 1) for i in range(12)] + [None] * 3
    r = run(spark, impressions(1, 15, suc=suc))[1]
    assert r.suc_12 == pytest.approx(1.2) and r.suc_13 is None and r.suc_15 is None
    assert r.avg_suc_score == pytest.approx(sum(0.1 * (i + 1) for i in range(12)) / 12)


def test_null_key_is_a_group_value(spark):
    r = run(spark, impressions(1, 15, pos=None))[1]
    assert r.pos is None and r.cp == "A"


def test_oversized_key_is_cut_before_the_shuffle(spark):
    """A key with a million rows sends page_size + 1 of them from each task, in a plan with one shuffle."""
    from pyspark.sql import functions as F

    whole = spark.createDataFrame(impressions(1, 15), SCHEMA)
    hot = (spark.range(0, 1_000_000, 1, 8).join(F.broadcast(spark.createDataFrame(impressions(2, 1, session=None), SCHEMA)))
           .drop("id").select(*whole.columns))
    out = page_samples(whole.unionByName(hot))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan.replace("BroadcastNestedLoopJoin", "")
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert {r.job_id for r in out.collect()} == {1}


def test_a_page_of_the_limit_plus_one(spark):
    assert run(spark, impressions(1, 16) + impressions(2, 15) + impressions(3, 200), page_size=15).keys() == {2}
