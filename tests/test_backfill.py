"""Multi-day back-fill: look-back rows keyed by target day."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from pagefeatures.operators import bands  # noqa: E402
from pagefeatures.plans import daily  # noqa: E402
from pagefeatures.plans.registry import Ctx  # noqa: E402
from pagefeatures.sources.fixtures import DAYS  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_lookback_rows_targets(spark):
    days = ["2020-07-20", "2020-07-21", "2020-07-22", "2020-07-23"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "x long, ds string")
    got = sorted((r.x, r.ds) for r in daily.lookback_rows(df, ["2020-07-23", "2020-07-24"]).collect())
    # day 07-20 serves 07-23; 07-21 serves 07-23, 07-24; 07-22 serves both; 07-23 serves 07-24
    assert got == [(0, "2020-07-23"), (1, "2020-07-23"), (1, "2020-07-24"), (2, "2020-07-23"),
                   (2, "2020-07-24"), (3, "2020-07-24")]


def test_many_targets_equal_single_targets(spark):
    c = Ctx.get(spark, SF)
    info = c.info()
    together = bands.band_ratio_wide(daily.lookback_rows(info, DAYS), min_count=[0] * 8)
    for d in DAYS:
        alone = bands.band_ratio_wide(daily.lookback_rows(info, [d]), min_count=[0] * 8)
        a = sorted(tuple(r) for r in together.where(together.ds == d).collect())
        b = sorted(tuple(r) for r in alone.collect())
        assert a == b


def test_backfill_contains_single_day(spark):
    full = E.queries()["final_rows_backfill"](spark, SF)
    one = E.queries()["final_rows"](spark, SF)
    day = DAYS[-1]
    a = sorted(map(str, full.where(full.ds == day).collect()))
    b = sorted(map(str, one.collect()))
    assert a == b
    assert {r.ds for r in full.select("ds").distinct().collect()} <= set(DAYS)


def test_single_target_has_no_row_copies(spark):
    c = Ctx.get(spark, SF)
    plan = daily.lookback_rows(c.info(), DAYS[:1])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_whole_day_plan_prunes_and_stays_in_jvm(spark):
    f = E.queries()["final_rows"](spark, SF)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    # the wide impressions table is never read whole: every scan lists its columns
    for line in plan.split("\n"):
        if "FileScan parquet" in line and "ReadSchema" in line:
            assert line.count(":double") < 100 or "boss_title_type" in line
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_run_day_writes_tables_idempotently(spark, tmp_shared):
    import uuid

    from pagefeatures import dates
    c = Ctx.get(spark, SF)
    inputs = daily.DayInputs(c.scores, c.impressions, c.blocks)
    t = DAYS[-1]
    info_path = f"{tmp_shared}/labelled-{uuid.uuid4().hex}"
    out_path = f"{tmp_shared}/final-{uuid.uuid4().hex}"
    daily.backfill_labels(inputs, dates.lookback_days(t), info_path)
    first = daily.run_day(spark, inputs, t, info_path, out_path)
    rows1 = sorted(map(str, first.collect()))
    again = daily.run_day(spark, inputs, t, info_path, out_path)
    rows2 = sorted(map(str, again.collect()))
    lazy = sorted(map(str, E.queries()["final_rows"](spark, SF).collect()))
    assert rows1 == rows2 == lazy and len(rows1) > 0


def _joined(spark, **more):
    from pagefeatures.operators.enrich import joined_rows, profile_rows
    c = Ctx.get(spark, SF)
    t = DAYS[-1]
    info = c.info()
    return joined_rows(c.pages(), *daily.features_for(info, [t]), c.blocks, profile_rows(c.impressions, t), **more)


def test_feature_places_may_be_more_than_the_pages(spark):
    c = Ctx.get(spark, SF)
    places = c.pages().select("ds", "boss_id", "job_id", "cp")
    more = places.unionByName(places.withColumn("job_id", F.lit(None).cast("long"))).unionByName(places)
    a, b = (sorted(map(str, d.collect())) for d in (_joined(spark), _joined(spark, places=more)))
    assert a == b and a


def test_null_keys_have_the_features_of_the_others(spark):
    from pagefeatures.operators.enrich import joined_rows, profile_rows
    c = Ctx.get(spark, SF)
    t = DAYS[-1]
    pages = c.pages().withColumn("boss_id", F.lit(None).cast("long"))
    features = daily.features_for(c.info(), [t])
    out = joined_rows(pages, *features, c.blocks, profile_rows(c.impressions, t))
    seen = out.agg(F.count(F.lit(1)).alias("n"), F.count("boss_addf_num_3days").alias("boss"),
                   F.count("cp_addf_num_3days").alias("cp"), F.count("job_addf_num_3days").alias("job")).first()
    assert seen.n == pages.count() and seen.boss == 0 and seen.cp > 0 and seen.job > 0


def test_page_rows_are_shuffled_twice_for_all_features(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(_joined(spark)._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning", plan)
    assert sum("addf_15#" in columns for columns in moved) == 2


def test_stored_counts_give_the_same_features(spark):
    """Look-back from day counts, for one target and for several, against rows counted directly."""
    c = Ctx.get(spark, SF)
    info = c.info()
    partials = daily.day_partials(info)
    for targets in (DAYS[-1:], DAYS):
        direct = [daily.features_for(info, [t]) for t in targets]
        counted = daily.features_for(None, targets, partials=partials)
        together = daily.features_for(info, targets)
        for k in range(2):
            want = sorted(str(r) for d in direct for r in d[k].collect())
            assert sorted(map(str, counted[k].collect())) == sorted(map(str, together[k].collect())) == want and want


def test_backfill_copies_counts_and_not_rows(spark):
    """Several targets: what is joined with the days they serve are counts by day."""
    c = Ctx.get(spark, SF)
    for feature in daily.features_for(c.info(), DAYS):
        plan = feature._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.split("\n")
        join = next(k for k, line in enumerate(lines) if "_source" in line and "Join" in line)
        assert any("Aggregate" in line for line in lines[join:])


def test_one_lookback_scan_for_all_quartiles(spark):
    c = Ctx.get(spark, SF)
    _, quartiles = daily.features_for(c.info(), DAYS[-1:])
    plan = spark._jvm.PythonSQLUtils.explainString(quartiles._jdf.queryExecution(), "formatted")
    tree = plan.split("(1)")[0]
    assert tree.count("Exchange") - tree.count("ReusedExchange") <= 5  # the counts' exchange shows twice before it is reused
    quartiles.collect()
    done = quartiles._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert done.count("Exchange hashpartitioning") - done.count(" ReusedExchange ") <= 4
    assert done.count("FileScan parquet") <= 2


def test_run_day_reads_one_raw_day(spark, tmp_shared):
    """With counts stored, the look-back days of the labelled table may be gone."""
    import uuid

    from pagefeatures import dates
    from pagefeatures.session import remove_path
    c = Ctx.get(spark, SF)
    inputs, t = daily.DayInputs(c.scores, c.impressions, c.blocks), DAYS[-1]
    info_path, out_path = (f"{tmp_shared}/{n}-{uuid.uuid4().hex}" for n in ("labelled", "final"))
    daily.backfill_labels(inputs, dates.lookback_days(t), info_path)
    for d in dates.lookback_days(t):
        remove_path(spark, f"{info_path}/ds={d}")
    got = sorted(map(str, daily.run_day(spark, inputs, t, info_path, out_path).collect()))
    assert got == sorted(map(str, E.queries()["final_rows"](spark, SF).collect()))
    # a day whose counts were never written is counted from its labelled rows
    daily.backfill_labels(inputs, dates.lookback_days(t), info_path)
    for n in ("bands", "scores"):
        remove_path(spark, f"{info_path}-counts/{n}/ds={dates.lookback_days(t)[0]}")
    assert got == sorted(map(str, daily.run_day(spark, inputs, t, info_path, out_path).collect()))


def test_an_empty_day_re_run_is_empty(spark, tmp_shared):
    import uuid

    c = Ctx.get(spark, SF)
    t = DAYS[-1]
    info_path, out_path = (f"{tmp_shared}/{n}-{uuid.uuid4().hex}" for n in ("labelled", "final"))
    assert daily.run_day(spark, daily.DayInputs(c.scores, c.impressions, c.blocks), t, info_path, out_path).count() > 0
    nothing = daily.DayInputs(c.scores.where("false"), c.impressions, c.blocks)
    assert daily.run_day(spark, nothing, t, info_path, out_path).collect() == []


def test_backfill_leaves_no_intermediate_table(spark, tmp_shared):
    import uuid

    from pagefeatures.session import child_names
    c = Ctx.get(spark, SF)
    before = child_names(spark, f"{tmp_shared}/runs"), child_names(spark, tables_of(spark))
    out = daily.backfill(spark, daily.DayInputs(c.scores, c.impressions, c.blocks), DAYS, f"{tmp_shared}/final-{uuid.uuid4().hex}")
    assert sorted(map(str, out.collect())) == sorted(map(str, E.queries()["final_rows_backfill"](spark, SF).collect()))
    assert (child_names(spark, f"{tmp_shared}/runs"), child_names(spark, tables_of(spark))) == before


def tables_of(spark):
    from pagefeatures.sources.tables import _own_tables
    return _own_tables(spark)


def test_backfill_moves_pages_once_more_and_reads_one_day_alone(spark):
    """Features, and pages with them, are written on the way; what is left moves the pages to their profiles."""
    from pagefeatures.sources import tables
    c = Ctx.get(spark, SF)
    info = c.info()
    with tables.run_folder(spark):
        rows = daily.build_days(daily.DayInputs(c.scores, c.impressions, c.blocks), DAYS, info=info)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = spark._jvm.PythonSQLUtils.explainString(rows.where(F.col("ds") == DAYS[1])._jdf.queryExecution(), "formatted")
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        day = sorted(map(str, rows.where(F.col("ds") == DAYS[1]).collect()))
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning", plan)
    assert sum("addf_15#" in columns for columns in moved) == 1 and len(moved) == 3
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 2
    assert len(re.findall(r"PartitionFilters: \[.*?= %s\)" % DAYS[1], plan)) == 2
    assert day and day == sorted(map(str, daily.build_day(daily.DayInputs(c.scores, c.impressions, c.blocks), DAYS[1], info=info).collect()))


def test_written_features_of_null_and_repeated_places(spark):
    """Places with NULL parts keep their features when these are written; a place with two blocks gives two rows."""
    from pagefeatures.operators import enrich
    from pagefeatures.sources import tables
    place = "ds string, boss_id long, job_id long, cp string"
    pages = spark.createDataFrame([("d1", 1, 10, "a"), ("d1", None, 10, "a"), ("d1", 1, None, None), ("d2", 1, 10, "a"), ("d2", 1, 10, "a")], place)
    kinds = "ds string, entity string, job_id long, boss_id long, cp string, q1 double, q2 double, q3 double, num long"
    quartiles = spark.createDataFrame([("d1", "job", 10, None, None, 1.0, 2.0, 3.0, 7), ("d1", "boss", None, 1, None, 4.0, 5.0, 6.0, 8),
                                       ("d1", "boss", None, None, None, 9.0, 9.0, 9.0, 9), ("d2", "cp", None, None, "a", 7.0, 8.0, 9.0, 9)], kinds)
    ratios = spark.createDataFrame([("d1", "a", *[0.1 * b for b in range(1, 9)])], "ds string, cp string, " + ", ".join(f"pct{b}_ratio double" for b in range(1, 9)))
    blocks = spark.createDataFrame([(1, 10, 2), (1, 10, 11), (1, 10, 2)], "boss_id long, job_id long, business int")
    features = enrich.place_features(pages, ratios, quartiles, blocks)
    with tables.run_folder(spark):
        written = tables.materialize(spark, features, "features", day_col=None)
        got = sorted(map(str, enrich.join_features(pages, written).collect()))
        shown = [(r.ds, r.boss_id, r.job_id, r.addf_job_score_q1_3days, r.addf_boss_score_q1_3days, r.addf_cp_score_q1_3days, r.pct1_ratio, r.business_type)
                 for r in enrich.join_features(pages, written).collect()]
    assert got == sorted(map(str, enrich.join_features(pages, features).collect()))
    assert sorted(map(str, shown)) == sorted(map(str, [
        ("d1", 1, 10, 1.0, 4.0, None, 0.1, 2), ("d1", 1, 10, 1.0, 4.0, None, 0.1, 11), ("d1", None, 10, 1.0, None, None, 0.1, 0),
        ("d1", 1, None, None, 4.0, None, None, 0), *[("d2", 1, 10, None, None, 7.0, None, k) for k in (2, 11)] * 2]))


def test_training_text_is_written_a_day_at_a_time(spark, tmp_shared, monkeypatch):
    """No job holds the shuffle files of several days beside the text, and no table between is left."""
    from pagefeatures.plans import registry
    from pagefeatures.session import child_names
    c, fresh = Ctx.get(spark, SF), Ctx(spark, SF)
    fresh._parts.update(info=c.info(), tables=c.tables)
    folders = lambda: (child_names(spark, tables_of(spark)), child_names(spark, f"{tmp_shared}/runs"))
    before, write, days = folders(), registry.text.write_text, []
    monkeypatch.setattr(registry.text, "write_text", lambda rows, base, some=None, *a, **kw: (days.append(some), write(rows, base, some, *a, **kw))[1])
    fresh.text_base()
    assert days == [[d] for d in DAYS] and folders() == before
    keys = ["boss_id", "job_id", "sessionid", "page", "addf_15", "job_addf_num_3days", "ds"]
    got, want = (sorted(map(str, d.select(*keys).collect())) for d in (fresh.text_rows(), E.queries()["final_rows_backfill"](spark, SF)))
    assert got == want and want
