"""Input tables: numbered once, the three tables are columns of that result."""

from pyspark.sql import functions as F

from pagefeatures import config as C
from pagefeatures.sources import fixtures, text


def raw_folder(spark, tmp_path):
    tables = {
        "lineitem": spark.sql("SELECT id AS l_orderkey, CAST(id % 7 AS INT) AS l_linenumber, id % 11 AS l_partkey, "
                              "CAST(id * 1.37 AS DOUBLE) AS l_extendedprice, id % 3 AS l_suppkey FROM range(400)"),
        "supplier": spark.sql("SELECT id AS s_suppkey, id % 2 AS s_nationkey FROM range(3)"),
        "nation": spark.sql("SELECT id AS n_nationkey, id AS n_regionkey FROM range(2)"),
        "region": spark.sql("SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(2)"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_inputs_are_numbered_once(spark, tmp_path, monkeypatch):
    folder, plans = raw_folder(spark, tmp_path), {}
    write = fixtures._write_once

    def seen(session, df, path):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        return write(session, df, path)

    monkeypatch.setattr(fixtures, "_write_once", seen)
    got = fixtures.input_tables(spark, folder)
    assert [name for name, plan in plans.items() if "Window" in plan or "Exchange" in plan] == ["expo"]
    plain = fixtures._derive(spark, fixtures._expo(spark, folder))
    for name, df in plain.items():
        assert got[name].columns == df.columns and got[name].count() > 0
        assert got[name].exceptAll(df).isEmpty() and df.exceptAll(got[name]).isEmpty()


def test_days_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Inputs and training text are not sorted by day before they are written; the setting is put back."""
    from pyspark.sql.readwriter import DataFrameWriter

    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name, None)
    for kind in ("parquet", "csv"):
        def write(self, path, *args, _write=getattr(DataFrameWriter, kind), **kw):
            seen.append(int(spark.conf.get(name, "0")))
            return _write(self, path, *args, **kw)
        monkeypatch.setattr(DataFrameWriter, kind, write)
    rows = spark.sql("SELECT id AS x, concat('2020-07-', 10 + id % 11) AS ds FROM range(200)")  # more days than are kept open
    got = fixtures._write_once(spark, rows, f"{tmp_path}/days")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    kinds = {f.name: f.dataType.simpleString() for f in text.text_schema()}
    final = spark.range(40).select(*[F.lit(None).cast(kinds[c]).alias(c) if c != "boss_id" else F.col("id").alias(c)
                                     for c in C.TEXT_COLUMNS], F.concat(F.lit("2020-07-1"), F.col("id") % 3).alias("ds"))
    text.write_text(final, f"{tmp_path}/text")
    back = text.read_days(spark, f"{tmp_path}/text", "2020-07-10", "2020-07-12", cols=["boss_id"])
    assert sorted(map(tuple, back.collect())) == sorted((i, f"2020-07-1{i % 3}") for i in range(40))
    assert seen and min(seen) > 1 and spark.conf.get(name, None) == before


def test_only_the_numbered_rows_are_written(spark, tmp_path):
    """The three tables are selections of one written table: pruned by day and by column, written no second time."""
    from pagefeatures.session import child_names
    from pagefeatures.sources import tables

    got = fixtures.input_tables(spark, raw_folder(spark, tmp_path))
    (folder,) = {f.split("/ds=")[0] for df in got.values() for f in df.inputFiles()}
    assert folder.endswith("/expo") and child_names(spark, folder.rsplit("/", 1)[0]) == ["expo"]
    day = tables.scan_day(got["impressions"], fixtures.TARGET_DAY).select("boss_id", "deal_type")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "ReadSchema: struct<boss_id:bigint,deal_type:string>" in plan


def test_materialized_days_are_written_side_by_side(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from pagefeatures.sources import tables

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet",
                        lambda self, *a, **kw: (seen.append(int(spark.conf.get(name, "0"))), write(self, *a, **kw))[1])
    rows = spark.sql("SELECT id AS x, concat('2020-07-', 10 + id % 11) AS ds FROM range(200)")
    back = tables.materialize(spark, rows, "side")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect())) and min(seen) > 1
