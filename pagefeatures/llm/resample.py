"""Quality classifier by importance resampling.

Two bag-of-n-grams models (words and word pairs, hashed into ``buckets``) are
counted: one over the target texts, one over all raw texts.  A text's log
importance weight is the sum over its n-grams of log p_target - log p_raw.
Adding independent Gumbel noise and taking the k largest sums is sampling k
texts without replacement in proportion to their weights.  Noise comes
from a hash of the id, so a retried task draws the same numbers.

The k largest are found without a global sort: four small histograms of the
keys, each inside one bin of the last, give the k-th key exactly.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import WordCache, ship_code, small_batches, stored, whole_text

#: keys are compared at this many steps to one
STEPS = 1_000_000


@lru_cache(maxsize=1)
def _word_hashes() -> WordCache:
    return WordCache(lambda word: xxhash.xxh64_intdigest(word), limit=50_000)


def ngram_buckets(text: str, buckets: int) -> np.ndarray:
    """The bucket of every word and of every pair of neighbouring words (A-Z in lower case)."""
    cache = _word_hashes()
    words = np.array([cache[w] for w in text.encode().lower().split()], np.uint64)
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    pairs ^= pairs >> np.uint64(29)
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def ngram_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts: counted in each task, summed by bucket."""
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts += np.bincount(ngram_buckets(text, buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    with small_batches(texts.sparkSession):
        rows = (texts.select(whole_text("text").alias("text")).mapInArrow(run, "bucket long, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    counts = np.zeros(buckets, np.int64)
    for r in rows:
        counts[r.bucket] = r.n
    return counts


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each bucket, each count plus one."""
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def log_weights(texts: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(id, log_weight) of rows (id, text): the ratios of a text's n-grams added up.

    A task passes on ids and sums alone, so no row with its text waits for a result.
    """
    shared = texts.sparkSession.sparkContext.broadcast(ratios)
    id_col, kind = texts.columns[0], texts.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sums = [float(shared.value[ngram_buckets(t, len(shared.value))].sum()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.float64())], names=[id_col, "log_weight"])

    return texts.mapInArrow(run, f"`{id_col}` {kind}, log_weight double")


def kth_largest(rows: DataFrame, k: int, col: str = "step") -> int | None:
    """The k-th largest value of a long column, by histograms of ever finer bins; None if there is none."""
    if k < 1:
        return None
    base, shift = None, 64
    for bits in (40, 26, 13, 0):
        inside = rows if base is None else rows.where(F.shiftright(col, shift) == base)
        bins = inside.groupBy(F.shiftright(col, bits).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(bins, key=lambda r: -r.bin):
            if k <= r.n:
                base, shift = r.bin, bits
                break
            k -= r.n
        else:  # fewer than k rows: the least value bounds them all
            return rows.agg(F.min(col)).first()[0]
    return base


def importance_sample(docs: DataFrame, target: DataFrame, share: float, buckets: int = 10_000,
                      seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, log_weight, sample_key, kept) of every row; ``share`` of the rows are kept.

    ``target`` lists the ids of the target texts; the target model counts all
    of them, the raw model all rows.  A null or empty text has weight 0 (log), repeated
    rows have equal keys, and rows that tie with the last one kept are all
    kept.  An empty table gives no rows; without target texts all weights
    come from the smoothing alone.
    """
    ship_code(docs.sparkSession)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col), whole_text(text_col).alias("text"))
    chosen = stored(target.select(id_col).where(F.col(id_col).isNotNull()).distinct(), "resample-target")
    raw_counts = ngram_counts(texts, buckets)
    # a merge join at every size: the list of targets grows with the corpus
    target_counts = ngram_counts(texts.join(chosen.hint("merge"), id_col, "left_semi"), buckets)
    weights = log_weights(texts, log_ratios(target_counts, raw_counts))
    # 52 bits of the hash: uniform in (0, 1), never 0 or 1
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    noise = -F.log(-F.log(uniform))
    with small_batches(spark):
        rows = stored(weights.withColumn("sample_key", F.col("log_weight") + noise)
                      .withColumn("step", F.floor(F.col("sample_key") * STEPS).cast("long")), "resample-weights")
    least = kth_largest(rows, round(rows.count() * share))
    kept = F.lit(False) if least is None else F.col("step") >= F.lit(least)
    return rows.select(id_col, "log_weight", "sample_key", kept.alias("kept"))
