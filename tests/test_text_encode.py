import uuid

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pagefeatures import config as C
from pagefeatures.operators import encode, metrics
from pagefeatures.sources import text


def final_like(spark, n=3, nulls=False):
    schema = text.text_schema(C.FINAL_COLUMNS)
    rows = []
    for i in range(n):
        row = []
        for f in schema.fields:
            t = f.dataType.simpleString()
            if nulls and f.name in ("job_degree", "boss_addf_rate_2d", "city", "suc_3"):
                row.append(None)
            elif t == "bigint" or t == "int":
                row.append(i + 1)
            elif t == "string":
                row.append(f"v{i}")
            elif t == "date":
                import datetime
                row.append(datetime.date(2020, 7, 25))
            else:
                row.append(0.1 * (i + 1))
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ds", F.lit("2020-07-25"))


def with_template(df, template):
    """``df`` plus the columns of a one-row ``template`` (typed literals), for test rows."""
    row = template.first()
    extra = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in template.schema.fields
             if f.name not in df.columns]
    return df.select("*", *extra)


def test_text_schema_matches_final_rows():
    assert len(text.text_schema()) == 190
    assert text.text_schema().fieldNames()[8] == "position"


def test_tsv_roundtrip_with_nulls_and_missing_days(spark, tmp_shared):
    base = f"{tmp_shared}/txt-{uuid.uuid4().hex}"
    df = final_like(spark, nulls=True)
    text.write_text_day(df, base, "2020-07-25")
    assert text.existing_days(spark, base, "2020-07-20", "2020-07-26") == ["2020-07-25"]
    back = text.read_days(spark, base, "2020-07-20", "2020-07-26")
    assert back.count() == 3
    r = back.orderBy("boss_id").first()
    assert r.job_degree is None and r.city is None and r.position == "v0" and r.ds == "2020-07-25"
    raw = spark.read.text(text.day_path(base, "2020-07-25")).first()[0]
    assert "\\N" in raw and raw.count("\t") == 189
    # shifted day list as in the original loop: 07-24..07-25 reads 07-25..07-26
    assert text.existing_days(spark, base, "2020-07-24", "2020-07-25", shift_days=1) == ["2020-07-25"]


def test_fill_defaults_and_null_label(spark):
    df = encode.feature_select(final_like(spark, nulls=True).withColumnRenamed("pos", "position"))
    filled = encode.fill_defaults(df).first()
    assert filled.job_degree == 0 and filled.city == "0" and filled.suc_3 == 0.0
    bad = df.withColumn("addf_num", F.lit(None).cast("long"))
    with pytest.raises(Exception):
        encode.fill_defaults(bad).collect()


def test_vocab_oov_all_zero_and_widths(spark):
    df = encode.fill_defaults(encode.feature_select(final_like(spark).withColumnRenamed("pos", "position")))
    df = df.withColumn("job_degree", F.lit(210)).withColumn("boss_title_type", F.lit(2))
    idx = encode.index_rows(df, hash_sizes={"boss_id": 50, "city": 7, "position": 9, "boss_l1code": 4})
    r = idx.first()
    assert r.job_degree_index == len(C.VOCABULARIES["job_degree"]) and r.boss_title_type_index == 2
    model = encode.encoding_pipeline().fit(idx)
    out = model.transform(idx).select(vector_to_array("job_degree_index_vec").alias("a"),
                                      vector_to_array("features").alias("f")).first()
    assert sum(out.a) == 0 and len(out.a) == len(C.VOCABULARIES["job_degree"])
    assert len(out.f) == 26 + 26 + 4 * 17 + 51 + (50 + 7 + 9 + 4)


def test_bucket_index_left_closed(spark):
    lim = C.BUCKET_LIMITS["addf_1"]
    df = spark.createDataFrame([(0.0,), (lim[0],), (lim[-1],), (9.0,)], "addf_1 double")
    got = [r[0] for r in df.select(encode.bucket_index("addf_1", lim)).collect()]
    assert got == [0, 1, 16, 16]


def test_date_split(spark):
    df = spark.createDataFrame([(d,) for d in ["2020-07-01", "2020-07-02", "2020-07-03", "2020-07-09"]], "ds string")
    got = {r.ds: r.split for r in encode.date_split(df, "2020-07-01", "2020-07-03", "2020-07-03").collect()}
    assert got == {"2020-07-01": "train", "2020-07-02": "train", "2020-07-03": "test"}


def test_clipped_mse(spark):
    df = spark.createDataFrame([(20.0, 12)], "prediction double, addf_num long")
    r = metrics.eval_metrics(df).first()
    assert r.mse_clipped == 9.0 and r.mse == 64.0 and r.mae == 8.0 and r.rmse == 8.0


def test_threshold_report_and_write(spark, tmp_shared):
    from pagefeatures.operators import report
    rows = [(float(i % 7) / 10, float(i % 5) / 10, float(i % 3) / 10, float(i % 11) / 20, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "addf_1 double, addf_8 double, addf_15 double, avg_addf_score double, addf_num long")
    rep = report.threshold_report(df, limit=3)
    got = rep.collect()
    assert {r.feature for r in got} == {"addf_1", "addf_8", "addf_15", "avg_addf_score"}
    assert sorted({r.addf_num for r in got}) == [0, 1, 2] and all(r.num == 100 for r in got)
    path = f"{tmp_shared}/report-{uuid.uuid4().hex}"
    report.write_report(rep, path)
    files = [f for f in spark.read.text(path).inputFiles()]
    assert len(files) == 1 and spark.read.option("header", True).csv(path).count() == 12
