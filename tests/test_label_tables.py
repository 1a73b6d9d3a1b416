import uuid
from datetime import datetime

from pagefeatures import dates
from pagefeatures.operators.label import label_impressions
from pagefeatures.sources import tables

SC = "boss_id long, job_id long, geek_id long, exp_id int, sessionid string, page long, rank string, ctr_score double, ctcvr_score double, ds string"
OC = ("boss_id long, job_id long, geek_id long, exp_id int, sessionid string, deal_type string, "
      "boss_position string, boss_city string, list_time timestamp, ds string")
T = datetime(2020, 7, 25, 1)


def test_label_distinct_scores_and_fanout(spark):
    s = spark.createDataFrame([(1, 1, 1, 1, "s", 1, "1", 0.2, 0.1, "d1")] * 2 +
                              [(1, 1, 2, 1, "s", 1, "2", 0.3, 0.1, "d1"),
                               (1, 1, 1, 1, "s", 1, "1", 0.2, 0.1, "d2")], SC)
    o = spark.createDataFrame([(1, 1, 1, 1, "s", "addf", "eng", "A", T, "d1"),
                               (1, 1, 1, 1, "s", "chat", "eng", "A", T, "d1"),
                               (1, 1, 2, 1, "s", "addf", "eng", "A", T, "d2")], OC)
    out = label_impressions(s, o).collect()
    # duplicate score rows collapse; two outcome rows multiply; ds must match
    assert sorted((r.geek_id, r.deal_type, r.ds) for r in out) == [(1, "addf", "d1"), (1, "chat", "d1")]
    assert label_impressions(s, o, day="d2").count() == 0


def test_overwrite_day_idempotent(spark, tmp_shared):
    path = f"{tmp_shared}/t-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d2")], "x long, ds string")
    tables.overwrite_day(df, path)
    d2 = spark.createDataFrame([(9, "d2")], "x long, ds string")
    tables.overwrite_day(d2, path)
    tables.overwrite_day(d2, path)
    got = sorted(tuple(r) for r in tables.read_table(spark, path).collect())
    assert got == [(1, "d1"), (9, "d2")]
    assert dict(tables.read_table(spark, path).dtypes)["ds"] == "string"


def test_scans_prune_partitions(spark, tmp_shared):
    path = f"{tmp_shared}/t-{uuid.uuid4().hex}"
    days = dates.day_range("2020-07-20", "2020-07-25")
    tables.overwrite_day(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "x long, ds string"), path)
    t = tables.read_table(spark, path)
    assert [r.ds for r in tables.scan_lookback(t, "2020-07-25").orderBy("ds").collect()] == days[2:5]
    assert tables.scan_range(t, "2020-07-21", "2020-07-22").count() == 2
    plan = tables.scan_day(t, "2020-07-25")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2020-07-25" in plan


def test_dates():
    assert dates.target_day("2020-07-26") == "2020-07-25"
    assert dates.lookback_days("2020-07-25") == ["2020-07-24", "2020-07-23", "2020-07-22"]
    assert dates.training_days("2020-07-01", "2020-07-02") == ["2020-07-01", "2020-07-02"]
    assert dates.training_days("2020-07-01", "2020-07-02", shift_days=1) == ["2020-07-02", "2020-07-03"]
    assert dates.day_range("2020-02-28", "2020-03-01") == ["2020-02-28", "2020-02-29", "2020-03-01"]


def test_label_join_splits_a_hot_key(spark):
    """A key holding a third of the rows: adaptive execution splits its join partition."""
    from pyspark.sql import functions as F
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 30000
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        base = spark.range(n).select(hot.alias("boss_id"), hot.alias("job_id"), hot.alias("geek_id"),
                                     F.lit(1).alias("exp_id"), F.lit("s").alias("sessionid"),
                                     F.lit("d").alias("ds"), "id")
        scores = base.select("boss_id", "job_id", "geek_id", "exp_id", "sessionid", F.lit(1).alias("page"),
                             F.lit("1").alias("rank"), (F.col("id") / n).alias("ctr_score"),
                             F.lit(0.1).alias("ctcvr_score"), "ds")
        outs = base.where(F.col("id") % 3 != 0).select(
            "boss_id", "job_id", "geek_id", "exp_id", "sessionid", F.lit("addf").alias("deal_type"),
            F.lit("eng").alias("boss_position"), F.lit("A").alias("boss_city"),
            F.lit(None).cast("timestamp").alias("list_time"), "ds")
        df = label_impressions(scores, outs)
        qe = df._jdf.queryExecution()
        rows = df.collect()
        plan = qe.executedPlan().toString()
        # 20,000 ordinary rows plus the hot key's 10,000 score rows, all matching
        # the one outcome row that carries the hot key (id 7)
        assert len(rows) == n
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rebalanced_day_write_has_fewer_files(spark, tmp_shared):
    from pyspark.sql import functions as F
    df = spark.range(4000).select(F.col("id"), F.concat(F.lit("d"), (F.col("id") % 4).cast("string")).alias("ds"))
    df = df.repartition(16)
    plain = tables.materialize(spark, df, "plain")
    reb = tables.materialize(spark, df, "reb", rebalance=True)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, reb.collect()))
    assert len(reb.inputFiles()) < len(plain.inputFiles())


def test_clear_tables_removes_only_own_tables(spark, tmp_shared):
    from pagefeatures.session import path_exists
    kept = f"{tmp_shared}/other-{uuid.uuid4().hex}"
    spark.range(3).write.parquet(kept)
    mine = tables.materialize(spark, spark.range(3), "mine", day_col=None)
    folder = mine.inputFiles()[0].rsplit("/", 1)[0]
    # other tests' tables of this application may still be in use: remove this one the same way
    assert f"/tables/{spark.sparkContext.applicationId}/" in folder and path_exists(spark, folder)
    tables.remove_path(spark, folder)
    assert not path_exists(spark, folder) and path_exists(spark, kept)


def _days(spark, path):
    return sorted((r.x, r.ds) for r in tables.read_table(spark, path).collect())


def test_an_empty_re_run_empties_the_day(spark, tmp_shared):
    path = f"{tmp_shared}/t-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "x long, ds string")
    tables.overwrite_day(df, path)
    tables.overwrite_day(df.where("false"), path, days=["d1"])
    assert _days(spark, path) == [(2, "d2")]
    tables.overwrite_day(df.where("false"), path, days=["d2"])
    assert _days(spark, path) == [] and tables.read_table(spark, path).columns == ["x", "ds"]
    tables.overwrite_day(df, path, days=["d1", "d2"])
    assert _days(spark, path) == [(1, "d1"), (2, "d2")]


def test_rows_of_other_days_are_refused(spark, tmp_shared):
    import pytest
    path = f"{tmp_shared}/t-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "x long, ds string")
    tables.overwrite_day(df, path)
    with pytest.raises(ValueError, match="ds=d2"):
        tables.overwrite_day(df, path, days=["d1"])
    assert _days(spark, path) == [(1, "d1"), (2, "d2")]
    assert [n for n in tables.child_names(spark, path) if n.startswith("_")] == []


def test_a_crash_while_publishing(spark, tmp_shared, monkeypatch):
    """Before the commit point the table is as it was; after it the next call finishes, from any step."""
    import pytest
    path = f"{tmp_shared}/t-{uuid.uuid4().hex}"
    old = spark.createDataFrame([(1, "d1"), (2, "d2")], "x long, ds string")
    new = spark.createDataFrame([(8, "d1"), (9, "d2")], "x long, ds string")
    tables.overwrite_day(old, path)

    def broken(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "rename_path", broken)
        tables.overwrite_day(new, path)
    assert _days(spark, path) == [(1, "d1"), (2, "d2")]

    real, calls = tables.swap_in, []

    def once(spark, new, place):
        calls.append(place)
        if len(calls) > 1:
            tables.remove_path(spark, place)  # the swap's first step, and then the crash
            raise RuntimeError("lost")
        real(spark, new, place)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "swap_in", once)
        tables.overwrite_day(new, path)
    assert _days(spark, path) == [(8, "d1")]  # d2 is still in the complete staging folder
    tables.finish_publish(spark, path)
    assert _days(spark, path) == [(8, "d1"), (9, "d2")]


def test_run_folder_is_dropped_on_success_and_kept_for_a_retry(spark, tmp_shared):
    import pytest
    from pagefeatures.session import path_exists
    name, made = uuid.uuid4().hex, []

    def work(fail):
        with tables.run_folder(spark, name) as folder:
            for k in range(2):
                df = spark.range(3).select((tables.F.col("id") + k).alias("x"), tables.F.lit(f"d{k}").alias("ds"))
                out = tables.materialize(spark, df, "part")
                made.append(sorted(out.inputFiles()))
                if fail and k == 0:
                    raise RuntimeError("lost")
            return folder, sorted(map(tuple, out.collect()))
    with pytest.raises(RuntimeError):
        work(True)
    folder, rows = work(False)
    assert made[0] == made[1] != made[2]  # the retry read the finished table
    assert rows == [(1, "d1"), (2, "d1"), (3, "d1")] and not path_exists(spark, folder)


def _plain(scores, outs):
    from pagefeatures.operators.label import INFO_COLUMNS, OUTCOME_COLUMNS
    keys = ["boss_id", "job_id", "geek_id", "exp_id", "sessionid", "ds"]
    return scores.distinct().join(outs.select(*keys, *OUTCOME_COLUMNS), keys).select(*INFO_COLUMNS, "ds")


def _label_rows(spark, n, hot=0):
    """n impressions, each twice, every ninth session NULL; the first ``hot`` share a key but not a score."""
    from pyspark.sql import functions as F
    i = F.when(F.col("id") < hot, F.lit(0)).otherwise(F.col("id"))
    base = spark.range(n).crossJoin(spark.range(2).select(F.col("id").alias("copy"))).select(
        i.alias("boss_id"), (i % 7).alias("job_id"), i.alias("geek_id"), F.lit(1).alias("exp_id"),
        F.when(F.col("id") % 9 != 8, F.lit("s")).alias("sessionid"), F.concat(F.lit("d"), i % 3).alias("ds"), "id", "copy")
    scores = base.select("boss_id", "job_id", "geek_id", "exp_id", "sessionid", F.lit(1).cast("long").alias("page"),
                         F.lit("1").alias("rank"), (F.col("id") / n).alias("ctr_score"), F.lit(0.1).alias("ctcvr_score"), "ds")
    outs = base.where((F.col("id") >= hot) | (F.col("id") == 0)).select(
        "boss_id", "job_id", "geek_id", "exp_id", "sessionid", F.concat(F.lit("t"), "copy").alias("deal_type"),
        F.lit("eng").alias("boss_position"), F.lit("A").alias("boss_city"), F.lit(None).cast("timestamp").alias("list_time"), "ds")
    return scores.localCheckpoint(), outs.localCheckpoint()  # stored rows: no column is a constant to the planner


def test_label_shuffles_usual_keys_once(spark):
    """Without a hot key no row is shuffled on all its columns: the distinct works where the join's shuffle put it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores, outs = _label_rows(spark, 3000)
        df = label_impressions(scores, outs)
        qe = df._jdf.queryExecution()
        got = sorted(map(str, df.collect()))
        final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        assert got == sorted(map(str, _plain(scores, outs).collect())) and len(got) > 5000
        assert not [x for x in final.splitlines() if "hashpartitioning" in x and "ctr_score" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_label_of_hot_and_differently_typed_keys(spark):
    from pyspark.sql import functions as F
    scores, outs = _label_rows(spark, 2000, hot=700)
    want = sorted(map(str, _plain(scores, outs).collect()))
    assert len(want) > 3000 and sorted(map(str, label_impressions(scores, outs).collect())) == want
    # an int key joins a long one, though their hashes differ
    wide = outs.withColumn("exp_id", F.col("exp_id").cast("long"))
    assert label_impressions(scores, wide).count() == len(want)
    assert label_impressions(scores.where("false"), outs).isEmpty()


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    """Every write that later steps read drops its shuffle files at once, not when garbage is collected."""
    import time

    from pyspark.sql import functions as F
    from pagefeatures import config as C
    from pagefeatures.sources import fixtures, text
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    rows = spark.range(500).select(F.col("id").alias("x"), F.concat(F.lit("2020-07-1"), F.col("id") % 3).alias("ds"))
    counted = rows.repartition(3, "ds").groupBy("x", "ds").agg(F.count(F.lit(1)).alias("n"))  # one shuffle
    schema = text.text_schema(C.FINAL_COLUMNS)
    final = counted.select(*[(F.col("x") if f.name == "boss_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields], "ds")
    writes = {"materialize": lambda: len(tables.materialize(spark, counted, "freed").collect()),
              "overwrite_day": lambda: (tables.overwrite_day(counted, f"{tmp_path}/day"), len(tables.read_table(spark, f"{tmp_path}/day").collect()))[1],
              "write_once": lambda: len(fixtures._write_once(spark, counted, f"{tmp_path}/once").collect()),
              "write_text": lambda: (text.write_text(final, f"{tmp_path}/text"), 500)[1]}
    for what, write in writes.items():
        old = _shuffle_files(spark)
        assert write() == 500, what
        left, until = {1}, time.time() + 10
        while left and time.time() < until:  # they are dropped in the background
            time.sleep(0.1)
            left = _shuffle_files(spark) - old
        assert not left, what
    assert spark.conf.get(name, None) == before
