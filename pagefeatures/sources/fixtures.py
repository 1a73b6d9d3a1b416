"""Test inputs derived from the supplied TPC-H-like tables.

The daily job reads three tables: scored impressions (``rank_scores``),
impressions with outcomes and profile columns (``impressions``) and a job
dimension (``job_blocks``).  None ships with test data, so we derive them
from ``lineitem supplier nation region`` with one SQL text that Spark and
DuckDB both run (the DuckDB oracle rebuilds them from the same text).

The impressions that all three are columns of are numbered once (``expo``).
Spark writes them once per input folder as ``ds``-partitioned parquet under
the session's shared folder; the tables are selections of it, written no
second time, and read as production tables are: partition pruning on
``ds``, column pruning of the 100 profile columns, filter pushdown.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..session import days_side_by_side, path_exists, shared_dir, shuffles_freed

DAYS = ("2020-07-22", "2020-07-23", "2020-07-24", "2020-07-25")
TARGET_DAY = "2020-07-25"

# Four days, four jobs per boss, pages of at most 15 impressions; scores in
# thousandths and between, negative and NULL ones, NULL positions, out-of-vocabulary categories on purpose.
EXPO_SQL = """
WITH base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice,
         l.l_suppkey AS boss_id,
         l.l_suppkey * 4 + l.l_partkey % 4 AS job_id,
         CASE l.l_orderkey % 4 WHEN 0 THEN '2020-07-22' WHEN 1 THEN '2020-07-23'
              WHEN 2 THEN '2020-07-24' ELSE '2020-07-25' END AS ds,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents,
         r.r_name AS boss_city
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
       JOIN {nation} n ON s.s_nationkey = n.n_nationkey
       JOIN {region} r ON n.n_regionkey = r.r_regionkey),
num AS (
  SELECT *, row_number() OVER (PARTITION BY ds, boss_id, job_id
             ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS rn
  FROM base),
pg AS (
  SELECT *, CAST(floor(rn / 15) AS BIGINT) + 1 AS page, rn % 15 + 1 AS pos_in_page FROM num)
SELECT boss_id, job_id, l_orderkey AS geek_id, l_linenumber AS exp_id,
       concat('s', CAST(job_id % 7 AS STRING)) AS sessionid,
       page, CAST(pos_in_page AS STRING) AS rank,
       CASE WHEN cents % 211 = 0 THEN CAST(-0.5 AS DOUBLE)
            ELSE CAST(cents % 1000 * 1000 + (l_partkey % 3) * (l_partkey % 333) AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS ctr_score,
       CASE WHEN (l_partkey + l_orderkey) % 50 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST((cents + 7 * l_partkey) % 1000 AS DOUBLE) / CAST(2000 AS DOUBLE) END AS ctcvr_score,
       CASE (l_orderkey * 3 + l_linenumber * 7 + l_partkey) % 10
            WHEN 0 THEN 'success' WHEN 1 THEN 'p_success' WHEN 2 THEN 'addf' WHEN 3 THEN 'addf'
            WHEN 4 THEN 'chat' WHEN 5 THEN 'det' ELSE 'list' END AS deal_type,
       CASE WHEN job_id % 10 <= 5 THEN 'eng' WHEN job_id % 10 <= 8 THEN 'ops'
            ELSE CAST(NULL AS STRING) END AS boss_position,
       boss_city,
       CAST(concat(ds, ' ', lpad(CAST((page * 3 + boss_id) % 24 AS STRING), 2, '0'), ':15:00') AS TIMESTAMP) AS list_time,
       CASE WHEN job_id % 5 = 4 THEN 'search' ELSE 'f1_rec' END AS source,
       ds
FROM pg
"""

JOB_BLOCKS_SQL = """
SELECT boss_id, job_id, CAST(CASE job_id % 6 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 9 ELSE 10 END AS INT) AS business
FROM {expo} WHERE job_id % 3 <> 0
UNION ALL
SELECT boss_id, job_id, CAST(11 AS INT) AS business FROM {expo} WHERE job_id % 50 = 7
"""

SCORE_COLUMNS = ("boss_id", "job_id", "geek_id", "exp_id", "sessionid", "page", "rank",
                 "ctr_score", "ctcvr_score")
IMPRESSION_COLUMNS = ("boss_id", "job_id", "geek_id", "exp_id", "sessionid", "page", "rank",
                      "deal_type", "boss_position", "boss_city", "list_time", "source")

# Fixed rules of the six category / code profile columns.
_PROFILE_SPECIAL = {
    "boss_title_type": "CAST(boss_id % 5 AS INT)",
    "job_degree": "CAST(CASE WHEN job_id % 11 = 0 THEN 0 ELSE 200 + job_id % 11 END AS INT)",
    "job_workyears": "CAST(101 + job_id % 9 AS INT)",
    "boss_comp_scale": "CAST(300 + boss_id % 8 AS INT)",
    "boss_comp_stage": "CAST(800 + boss_id % 10 AS INT)",
    "boss_l1code": "concat('l', CAST(boss_id % 40 AS STRING))",
}


def profile_expr(i: int, name: str) -> str:
    """SQL expression of profile column ``i`` (same text for both engines)."""
    if name in _PROFILE_SPECIAL:
        return _PROFILE_SPECIAL[name]
    key = "boss_id" if name.startswith("boss_") else "job_id"
    return (f"CASE WHEN ({key} + {i}) % 17 = 0 THEN CAST(NULL AS DOUBLE) "
            f"ELSE CAST(({key} * ({i} + 3)) % 101 AS DOUBLE) / CAST(101 AS DOUBLE) END")


def _select_list(cols) -> str:
    return ", ".join(cols)


def rank_scores_sql(expo: str) -> str:
    return f"SELECT {_select_list(SCORE_COLUMNS)}, ds FROM {expo}"


def impressions_sql(expo: str) -> str:
    prof = ",\n       ".join(f"{profile_expr(i, c)} AS {c}" for i, c in enumerate(C.PROFILE_COLUMNS))
    return f"SELECT {_select_list(IMPRESSION_COLUMNS)},\n       {prof},\n       ds FROM {expo}"


def oracle_prelude() -> str:
    """``WITH`` clause defining the derived tables over the raw views (DuckDB)."""
    expo = EXPO_SQL.format(lineitem="lineitem", supplier="supplier", nation="nation", region="region")
    return ("WITH expo AS (" + expo + "),\n"
            "rank_scores AS (" + rank_scores_sql("expo") + "),\n"
            "impressions AS (" + impressions_sql("expo") + "),\n"
            "job_blocks AS (" + JOB_BLOCKS_SQL.format(expo="expo") + ")\n")


_VERSION = hashlib.md5((EXPO_SQL + JOB_BLOCKS_SQL + impressions_sql("e")).encode()).hexdigest()[:10]


def _write_once(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` read back from parquet; written unless its ``_SUCCESS`` marker is there."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        w = df.write.mode("overwrite")
        if "ds" in df.columns:
            w = w.partitionBy("ds")
        with days_side_by_side(spark), shuffles_freed(spark):
            w.parquet(path)
    # explicit schema: ds stays a string (no partition type inference)
    return spark.read.schema(df.schema).parquet(path)


def _expo(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
           for t in ("lineitem", "supplier", "nation", "region")}
    return spark.sql(EXPO_SQL, **raw)


def _derive(spark: SparkSession, expo: DataFrame) -> dict[str, DataFrame]:
    return {
        "rank_scores": spark.sql(rank_scores_sql("{expo}"), expo=expo),
        "impressions": spark.sql(impressions_sql("{expo}"), expo=expo),
        "job_blocks": spark.sql(JOB_BLOCKS_SQL, expo=expo),
    }


def input_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three input tables for one supplied folder, selected from the numbered impressions in parquet.

    These are written once (idempotent: an interrupted write is redone because
    the ``_SUCCESS`` marker is missing) under ``<shared>/inputs/<folder>-<ver>``.
    """
    sf_dir = os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir
    tag = sf_dir.rstrip("/").replace("/", "_").replace(":", "_").strip("_")
    root = f"{shared_dir(spark)}/inputs/{tag}-{_VERSION}"
    # the numbering is the only shuffle; the tables are columns of its result
    return _derive(spark, _write_once(spark, _expo(spark, sf_dir), f"{root}/expo"))
