"""Registered queries: one Spark callable and one DuckDB oracle per key.

Every callable takes ``(spark, sf_dir)``, derives the input tables from the
supplied parquet (``sources.fixtures``) and returns a lazy DataFrame over
all of them; the target day is the fixture's last day and the look-back its
three predecessors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config as C, dates
from ..functions import columns as FC
from ..operators import bands, encode, enrich, features, finalize, label, metrics, network, pages, report
from ..session import shared_dir
from ..sources import tables, text
from ..sources.fixtures import DAYS, TARGET_DAY, input_tables
from . import daily

T = TARGET_DAY
LOOKBACK = dates.lookback_days(T, C.LOOKBACK_DAYS)
#: days asked for when training text is read; some have no folder
TEXT_RANGE = ("2020-07-20", "2020-07-26")
PAGE_KEY_COLS = list(pages.PAGE_KEYS) + ["ds"]
ROW_KEYS = ["boss_id", "job_id", "geek_id", "exp_id", "sessionid", "ds"]


class Ctx:
    """Lazily built, shared pieces of the plan for one session and folder."""

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._parts: dict = {}

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Ctx":
        # a new session (or a restarted context) gets fresh state
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        if key not in cls._cache:
            cls._cache[key] = Ctx(spark, sf_dir)
        return cls._cache[key]

    def _memo(self, name, fn):
        if name not in self._parts:
            self._parts[name] = fn()
        return self._parts[name]

    @property
    def tables(self):
        return self._memo("tables", lambda: input_tables(self.spark, self.sf_dir))

    @property
    def scores(self) -> DataFrame:
        return self.tables["rank_scores"]

    @property
    def impressions(self) -> DataFrame:
        return self.tables["impressions"]

    @property
    def blocks(self) -> DataFrame:
        return self.tables["job_blocks"]

    def labelled(self) -> DataFrame:
        """Labelled impressions of all fixture days (one join, ds as a key), lazy."""
        return label.label_impressions(self.scores, self.impressions)

    def info(self) -> DataFrame:
        """The labelled table as later steps read it: written once, then scanned."""
        return self._memo("info", lambda: tables.materialize(self.spark, self.labelled(), "labelled"))

    def lookback(self) -> DataFrame:
        """Look-back rows of the target day, keyed by it (ds = target)."""
        return daily.lookback_rows(self.info(), [T])

    def pages(self) -> DataFrame:
        return pages.page_samples(tables.scan_day(self.info(), T))

    def profiles(self) -> DataFrame:
        return enrich.profile_rows(tables.scan_day(self.impressions, T))

    def quartiles(self, entity: str) -> DataFrame:
        return self._memo(f"quartiles-{entity}", lambda: features.score_quartiles(self.lookback(), entity))

    def joined(self) -> DataFrame:
        return enrich.joined_rows(self.pages(), *daily.features_for(self.info(), [T]), self.blocks, self.profiles())

    def final(self) -> DataFrame:
        return finalize.final_rows(self.joined())

    def text_base(self) -> str:
        """Folder of the training text: final rows of every back-filled day, one folder a day."""
        def build():
            base = f"{shared_dir(self.spark)}/text/{uuid.uuid4().hex}"
            info = self.info()
            with tables.run_folder(self.spark):
                rows = daily.build_days(daily.DayInputs(self.scores, self.impressions, self.blocks), DAYS, info=info)
                for day in DAYS:  # so the disk holds one day's shuffle files beside the text
                    text.write_text_day(rows, base, day)
            return base
        return self._memo("text_dir", build)

    def text_rows(self) -> DataFrame:
        """The training text of all days, read back."""
        return text.read_days(self.spark, self.text_base(), *TEXT_RANGE)


def _ctx(spark, sf_dir) -> Ctx:
    return Ctx.get(spark, sf_dir)


# ---------------------------------------------------------------- scans

def q_scan_day(spark, sf):
    return tables.scan_day(_ctx(spark, sf).scores, T)


def q_scan_lookback(spark, sf):
    return tables.scan_lookback(_ctx(spark, sf).scores, T, C.LOOKBACK_DAYS)


def q_scan_range(spark, sf):
    return tables.scan_range(_ctx(spark, sf).scores, *C.REPORT_RANGE)


def q_scan_dim(spark, sf):
    return _ctx(spark, sf).blocks


def q_distinct_rows(spark, sf):
    return tables.distinct_rows(_ctx(spark, sf).blocks)


def q_overwrite_day(spark, sf):
    """Write all days, overwrite the target day twice, empty the day before it, read the table back."""
    c = _ctx(spark, sf)
    path = f"{shared_dir(spark)}/tables/scores-{uuid.uuid4().hex}"
    tables.overwrite_day(c.scores, path)
    day = tables.scan_day(c.scores, T)
    tables.overwrite_day(day, path, days=[T])
    tables.overwrite_day(day, path, days=[T])
    tables.overwrite_day(c.scores.where("false"), path, days=[LOOKBACK[0]])
    return tables.read_table(spark, path)


# ---------------------------------------------------------------- scalar columns

def q_weekday_number(spark, sf):
    return _ctx(spark, sf).impressions.select(
        *ROW_KEYS, F.to_date("list_time").alias("date"), F.hour("list_time").alias("list_hour"),
        FC.weekday_number("list_time").alias("weekday"))


def q_composite_key(spark, sf):
    return _ctx(spark, sf).impressions.select(
        *ROW_KEYS, FC.composite_key("boss_city", "boss_position").alias("cp"))


def q_outcome_flags(spark, sf):
    addf, suc = FC.outcome_flags("deal_type")
    return _ctx(spark, sf).impressions.select(
        *ROW_KEYS, "deal_type", addf.alias("addf_flag"), suc.alias("suc_flag"))


def q_score_band(spark, sf):
    return _ctx(spark, sf).scores.select(*ROW_KEYS, "ctr_score", FC.score_band("ctr_score").alias("band"))


# ---------------------------------------------------------------- label, features, pages

def q_label_impressions(spark, sf):
    return _ctx(spark, sf).labelled()


def q_band_ratio(spark, sf):
    return bands.band_ratio(_ctx(spark, sf).lookback())


def q_band_ratio_wide(spark, sf):
    return bands.band_ratio_wide(_ctx(spark, sf).lookback())


def q_quartiles_by_job(spark, sf):
    return _ctx(spark, sf).quartiles("job")


def q_quartiles_by_boss(spark, sf):
    return _ctx(spark, sf).quartiles("boss")


def q_quartiles_by_cp(spark, sf):
    return _ctx(spark, sf).quartiles("cp")


# Doubles that come from floating sums (averages, standard deviations,
# metrics) depend on summation order, which differs between engines and
# between runs; registered results show them at this many decimals, and the
# oracle SQL rounds the same columns the same way.
SHOWN_DIGITS = 9


def _shown(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), SHOWN_DIGITS) for c in cols})


def q_page_samples(spark, sf):
    return _shown(_ctx(spark, sf).pages(), ["avg_addf_score", "avg_suc_score"])


def q_page_histogram(spark, sf):
    return pages.page_histogram(_ctx(spark, sf).pages())


# ---------------------------------------------------------------- scores that are not numbers

def _with_nan(df: DataFrame) -> DataFrame:
    """Every 17th score, and every 19th success score, is NaN."""
    nan = F.lit(float("nan"))
    return df.withColumns({"ctr_score": F.when((F.col("geek_id") + F.col("exp_id")) % 17 == 0, nan).otherwise(F.col("ctr_score")),
                           "ctcvr_score": F.when((F.col("geek_id") + F.col("exp_id")) % 19 == 0, nan).otherwise(F.col("ctcvr_score"))})


def q_nan_band_ratio(spark, sf):
    return bands.band_ratio(_with_nan(_ctx(spark, sf).lookback()))


def q_nan_quartiles(spark, sf):
    """Quartiles of all three entities from one histogram."""
    return features.entity_quartiles(features.score_counts(_with_nan(_ctx(spark, sf).lookback())))


def q_nan_pages(spark, sf):
    """Complete pages of the other scores, and their rounded means."""
    rows = pages.page_samples(_with_nan(tables.scan_day(_ctx(spark, sf).info(), T)))
    return rows.select(*PAGE_KEY_COLS, "num", "addf_1", "addf_15", *[
        FC.mean_rounded([f"{k}_{i}" for i in range(1, C.PAGE_SIZE + 1)], 3).alias(f"avg_{k}_score") for k in ("addf", "suc")])


# ---------------------------------------------------------------- joins and derived columns

def q_ratio_join(spark, sf):
    c = _ctx(spark, sf)
    j = enrich.join_ratios(c.pages(), bands.band_ratio_wide(c.lookback()))
    return j.select(*PAGE_KEY_COLS, *[f"pct{b}_ratio" for b in range(1, C.N_BANDS + 1)])


def q_block_join(spark, sf):
    c = _ctx(spark, sf)
    return enrich.join_block(c.pages(), c.blocks).select(*PAGE_KEY_COLS, "business_type")


def q_profile_rows(spark, sf):
    return _ctx(spark, sf).profiles().drop("ds")


def q_profile_join(spark, sf):
    c = _ctx(spark, sf)
    return enrich.join_profile(c.pages(), c.profiles()).select(*PAGE_KEY_COLS, *C.PROFILE_COLUMNS)


def _with_quartiles(c: Ctx) -> DataFrame:
    return (c.pages().select(*PAGE_KEY_COLS, "cp", *[f"addf_{i}" for i in range(1, 16)])
            .join(c.quartiles("job").drop("num"), ["ds", "job_id"], "left")
            .join(c.quartiles("boss").drop("num"), ["ds", "boss_id"], "left")
            .join(c.quartiles("cp").drop("num"), ["ds", "cp"], "left"))


def _q(e, i):
    return f"addf_{e}_score_q{i}_3days"


def q_fallback_quantile(spark, sf):
    x = _with_quartiles(_ctx(spark, sf))
    return x.select(*PAGE_KEY_COLS, *[FC.fallback(_q("job", i), _q("boss", i), _q("cp", i)).alias(f"q{i}_ref")
                                      for i in (1, 2, 3)])


def q_strictness_ratio(spark, sf):
    x = _with_quartiles(_ctx(spark, sf))
    return x.select(*PAGE_KEY_COLS, *[FC.strictness(_q("job", i), _q("boss", i), _q("cp", i)).alias(f"q{i}_strict")
                                      for i in (1, 2, 3)])


def q_ladder_position(spark, sf):
    x = _with_quartiles(_ctx(spark, sf))
    addf = [f"addf_{i}" for i in range(1, 16)]
    return x.select(*PAGE_KEY_COLS, *[FC.ladder(addf, FC.fallback(_q("job", i), _q("boss", i), _q("cp", i)))
                                      .alias(f"q{i}_base") for i in (1, 2, 3)])


def q_page_weight(spark, sf):
    return _ctx(spark, sf).pages().select(*PAGE_KEY_COLS, FC.page_weight("page").alias("page_base"))


def q_joined_rows(spark, sf):
    return _ctx(spark, sf).joined()


def q_strictness_class(spark, sf):
    j = _ctx(spark, sf).joined()
    c1, c2, c3 = FC.strictness_classes("q1_strict", "q2_strict", "q3_strict")
    return j.select(*PAGE_KEY_COLS, "business_type", c1.alias("q1_class"), c2.alias("q2_class"),
                    c3.alias("q3_class"))


def q_expected_contacts(spark, sf):
    j = _ctx(spark, sf).joined()
    counts = [f"pct{b}" for b in range(1, 9)]
    ratios = [f"pct{b}_ratio" for b in range(1, 9)]
    prods = FC.band_products(counts, ratios)
    return j.select(*PAGE_KEY_COLS, "business_type", *[p.alias(f"multi_pct{b}") for b, p in enumerate(prods, 1)],
                    FC.expected_contacts(counts, ratios).alias("pct_sum"))


def q_final_rows(spark, sf):
    return _ctx(spark, sf).final()


def q_final_rows_backfill(spark, sf):
    """Final rows of every fixture day, each with its own look-back (one plan)."""
    c = _ctx(spark, sf)
    return c._memo("backfill", lambda: daily.build_days(
        daily.DayInputs(c.scores, c.impressions, c.blocks), DAYS, info=c.info()))


def q_threshold_report(spark, sf):
    f = tables.scan_range(q_final_rows_backfill(spark, sf), *C.REPORT_RANGE)
    # the report reads its rows several times: five columns of them, written once
    f = tables.materialize(spark, f.select("ds", "addf_num", *C.REPORT_COLUMNS), "report-rows")
    return _shown(report.threshold_report(f), ["std"])


def q_report_file(spark, sf):
    """The threshold report as its one file has it."""
    rows = q_threshold_report(spark, sf)
    path = f"{shared_dir(spark)}/reports/{uuid.uuid4().hex}"
    report.write_report(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


# ---------------------------------------------------------------- text, model rows

def q_tsv_roundtrip(spark, sf):
    return _ctx(spark, sf).text_rows()


def q_read_days_existing(spark, sf):
    c = _ctx(spark, sf)
    days = text.existing_days(spark, c.text_base(), *TEXT_RANGE)
    return c.text_rows().select(*MODEL_KEYS, F.lit(",".join(days)).alias("days_found"))


def q_feature_select(spark, sf):
    return encode.feature_select(_ctx(spark, sf).text_rows(), keep=["ds"])


def q_fill_defaults(spark, sf):
    return encode.fill_defaults(encode.feature_select(_ctx(spark, sf).text_rows(), keep=["ds"]))


def q_date_split(spark, sf):
    info = _ctx(spark, sf).info()
    return encode.date_split(info, DAYS[0], DAYS[1], T).select(*ROW_KEYS, "split")


def _model_rows(spark, sf) -> DataFrame:
    return encode.fill_defaults(encode.feature_select(_ctx(spark, sf).text_rows(),
                                                      keep=["sessionid", "page", "job_id", "ds"]))


MODEL_KEYS = ["boss_id", "job_id", "sessionid", "page", "ds"]


def q_bucketize(spark, sf):
    rows = _model_rows(spark, sf)
    return encode.bucket_indices(rows).select(*MODEL_KEYS, *[f"{c}_bucket" for c in C.BUCKET_LIMITS])


def q_vocab_onehot(spark, sf):
    rows = _model_rows(spark, sf)
    return encode.vocab_indices(rows).select(*MODEL_KEYS, *[f"{c}_index" for c in C.CATEGORICAL_FEATURES])


def q_hash_bucket(spark, sf):
    rows = _model_rows(spark, sf)
    return encode.hash_indices(rows).select(*MODEL_KEYS, *[f"{c}_hash" for c in C.HASH_FEATURES])


def q_encoded_rows(spark, sf):
    rows = encode.index_rows(_model_rows(spark, sf))
    model = encode.encoding_pipeline().fit(rows)
    out = encode.vector_summary(model.transform(rows), MODEL_KEYS)
    return out.withColumn("feature_sum", F.round("feature_sum", 6))


def q_wide_deep_vectors(spark, sf):
    """Width, non-zero numbers and sum of the two input vectors, embeddings included."""
    rows = encode.lookup_embeddings(encode.hash_indices(_model_rows(spark, sf)), encode.initial_embeddings(spark))
    out = rows.select(*MODEL_KEYS, encode.wide_vector().alias("wide"), encode.deep_vector().alias("deep"))
    shown = [c for v in ("wide", "deep") for c in (
        F.size(v).alias(f"n_{v}"), F.size(F.filter(v, lambda x: x != 0)).alias(f"{v}_nnz"),
        F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 6).alias(f"{v}_sum"))]
    return out.select(*MODEL_KEYS, *shown)


def q_embedding_lookup(spark, sf):
    """First, last and summed value of each hashed field's embedding."""
    rows = encode.lookup_embeddings(encode.hash_indices(_model_rows(spark, sf)), encode.initial_embeddings(spark))
    return rows.select(*MODEL_KEYS, *[c for f in C.HASH_SIZES for c in (
        F.round(F.get(f"{f}_embedding", F.lit(0)), 9).alias(f"{f}_first"), F.round(F.get(f"{f}_embedding", F.lit(31)), 9).alias(f"{f}_last"),
        F.round(F.aggregate(f"{f}_embedding", F.lit(0.0), lambda a, x: a + x), 9).alias(f"{f}_sum"))])


#: the defaults of ``network.fit``, but for the seed
FIT = {"seed": 7}


def _fit(spark, sf):
    """Fitted on all days but the target day."""
    def build():
        with tables.run_folder(spark):
            return network.fit(_model_rows(spark, sf).where(F.col("ds") != T), MODEL_KEYS, **FIT)
    return _ctx(spark, sf)._memo("network", build)


def q_fit_and_score(spark, sf):
    """Label and prediction of the held-out target day."""
    rows = _model_rows(spark, sf).where(F.col("ds") == T)
    return network.score(_fit(spark, sf), rows).select(*MODEL_KEYS, "addf_num", "prediction")


def given_state() -> network.State:
    """A network with given weights: a fixed pattern over blocks and places, which SQL can repeat."""
    shape = network.Shape()
    block, place = np.indices((shape.blocks, network.BLOCK))
    params = ((block * 31 + place * 17) % 101 - 35) / 1000.0
    return network.State(shape, params, np.zeros_like(params))


def _given_scores(spark, sf) -> DataFrame:
    return network.score(given_state(), _model_rows(spark, sf))


def q_score_rows(spark, sf):
    """Predictions of all days by the network with given weights."""
    return _shown(_given_scores(spark, sf).select(*MODEL_KEYS, "prediction"), ["prediction"])


def q_evaluate_splits(spark, sf):
    """Metrics of these predictions on the train and test splits."""
    rows = encode.date_split(_given_scores(spark, sf), DAYS[0], DAYS[2], T)
    return _shown(metrics.eval_metrics(rows, label="addf_num", by=["split"]), ["rmse", "mae", "mse", "mse_clipped"])


def q_shuffled_rows(spark, sf):
    """Place of every row in a seeded random order, and its batch of 1,000 rows."""
    return encode.permuted(_model_rows(spark, sf), MODEL_KEYS, seed=11, batch_rows=1000).select(*MODEL_KEYS, "place", "batch")


def q_train_evaluate(spark, sf):
    """Back-filled days as text -> fit on all days but the target -> metrics on the train and test splits."""
    from . import training
    res = training.train(spark, _ctx(spark, sf).text_base(), DAYS[0], DAYS[2], T,
                         f"{shared_dir(spark)}/models/{uuid.uuid4().hex}", **FIT)
    return _shown(res.metrics, ["rmse", "mae", "mse", "mse_clipped"])


def q_eval_metrics(spark, sf):
    f = q_final_rows_backfill(spark, sf)
    return _shown(metrics.eval_metrics(f, label="addf_num", prediction="pct_sum"),
                  ["rmse", "mae", "mse", "mse_clipped"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
