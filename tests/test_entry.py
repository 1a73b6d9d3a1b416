"""Driver contract, plan properties, and every oracle at sf0.001."""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from tools.check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"fit_and_score", "train_evaluate"}  # fitted models: test_network.py


def own(names):
    """Names of this part of the library (the training-data operators have their own tests)."""
    return sorted(n for n in names if not re.match(r"op\d+_|pipeline$", n))


def test_keys():
    q, o = own(E.queries()), own(E.oracle_sql())
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 191 and df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_final_plan_has_no_python(spark):
    p = _plan(E.queries()["final_rows"](spark, SF))
    assert "Python" not in p and "ArrowEval" not in p


def test_band_ratio_single_aggregation(spark):
    p = _plan(E.queries()["band_ratio_wide"](spark, SF))
    assert p.count("FileScan") == 1


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


@pytest.mark.parametrize("name", own(E.oracle_sql()))
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall())


def test_text_schema_equals_final_rows_types(spark):
    from pagefeatures import config as C
    from pagefeatures.sources.text import text_schema
    final = E.queries()["final_rows"](spark, SF)
    got = [(f.name, f.dataType.simpleString()) for f in final.schema.fields if f.name != "ds"]
    exp = [(f.name, f.dataType.simpleString()) for f in text_schema(C.FINAL_COLUMNS).fields]
    assert got == exp
