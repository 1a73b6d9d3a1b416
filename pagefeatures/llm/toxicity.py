"""Toxicity: character n-gram linear classifier scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of a whole text (lower case, runs
of white space as one blank), hashed into ``1 << BITS`` buckets.  Labelled
texts give each bucket the ratio r = log(share of toxic texts with it / share
of other texts with it); the buckets whose ratio is best supported are kept.
A text's vector holds r for each kept bucket that it has, over the fourth root
of their number: long texts then score little by length, and a few toxic words
in a long text still count.  A logistic regression over these vectors is the
classifier.  How many buckets are kept, the root and the decay were chosen with a
fourth of the learning rows of sf0.1 for validation; with all buckets it finds fewer.

The fit reads a bounded sample of labelled rows (``max_rows``, a parameter).
Everything that reaches the driver is bounded by it and by ``max_features``;
the model that is broadcast is one number for each bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship_code, stored, whole_text

BITS = 18
SIZES = (3, 4, 5)
#: a vector is divided by the number of its features to this power
POWER = 0.25


def ngram_buckets(text: str) -> np.ndarray:
    """The bucket of every character n-gram of a text, repeats included."""
    chars = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le"), np.uint32)
    found, h = [], np.zeros(len(chars), np.uint32)
    for n in range(1, SIZES[-1] + 1):
        if len(chars) < n:
            break
        h = h[:len(chars) - n + 1] * np.uint32(0x9E3779B1) + chars[n - 1:] + np.uint32(1)
        if n >= SIZES[0]:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            found.append((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is never learned from: the CRC-32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def _bucket_counts(batches):
    """Of one task: for each bucket the toxic and the other texts that have it."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label][np.unique(ngram_buckets(text))] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (used, counts[1][used], counts[0][used])],
                                     names=["bucket", "toxic", "other"])


@dataclass
class Model:
    """``weight`` of each bucket (NaN where it isn't kept) and the score's offset."""

    weight: np.ndarray
    offset: float

    def score(self, text: str) -> float:
        weights = self.weight[np.unique(ngram_buckets(text))]
        weights = weights[~np.isnan(weights)]
        z = self.offset + (weights.sum(dtype=np.float64) / len(weights) ** POWER if len(weights) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_logistic(row: np.ndarray, feature: np.ndarray, value: np.ndarray, labels: np.ndarray, features: int,
                 rounds: int = 200, step: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression on sparse rows, by Adam on the whole sample."""
    w = np.zeros(features + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    share = (labels.sum() + 0.5) / (len(labels) + 2)
    w[-1] = np.log(share / (1 - share))
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[feature], len(labels)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / max(len(labels), 1)
        g = np.append(np.bincount(feature, value * error[row], features) + decay * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_features: int = 1400,
          least_texts: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          learn: Column | None = None) -> Model:
    """Fit on at most ``max_rows`` labelled rows, chosen by the hash of their id.

    ``learn`` says which ids may be learned from (default: not ``held_out``).
    Null labels and labels without a document are ignored; an id with
    several labels counts as toxic if one of them says so.  Without usable
    rows every text scores 0.25, with one class only its smoothed share.
    """
    ship_code(docs.sparkSession)
    spark = docs.sparkSession
    learn = ~held_out(id_col) if learn is None else learn
    known = (labels.where(F.col(label_col).isNotNull() & learn).groupBy(id_col)
             .agg((F.max(label_col) > 0).cast("int").alias("label")))
    known = stored(known.withColumn("hash", F.xxhash64(id_col)), "toxicity-labels")
    # the least hashes, of which nearly no others are sent to the sort (a share that falls short is a matter of 1e-14)
    n = known.count()
    share = min(1.0, (max_rows + 8 * max_rows ** 0.5 + 64) / max(n, 1))
    few = known if share == 1.0 else known.where(F.col("hash") <= int((2 * share - 1) * 2 ** 63))
    chosen = stored(few.orderBy("hash", id_col).limit(max_rows).drop("hash"), "toxicity-rows")
    texts = (docs.select(F.col(id_col), whole_text(text_col).alias("text")).join(F.broadcast(chosen), id_col)
             .select("label", "text").repartition(16))  # max_rows texts
    counts = (texts.mapInArrow(_bucket_counts, "bucket long, toxic long, other long")
              .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    counts = stored(counts, "toxicity-counts")  # 1 << BITS rows at most
    rows = chosen.groupBy().agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, other = rows.toxic or 0, rows.n - (rows.toxic or 0)
    ratio = F.log(((F.col("toxic") + 1) * F.lit(float(other + 2))) / ((F.col("other") + 1) * F.lit(float(toxic + 2))))
    seen = F.col("toxic") + F.col("other")
    best = (counts.where(seen >= least_texts).select("bucket", ratio.alias("ratio"), seen.alias("seen"))
            .orderBy((F.abs("ratio") * F.sqrt("seen")).desc(), "bucket").limit(max_features).collect())
    place = np.full(1 << BITS, -1, np.int32)
    ratios = np.array([b.ratio for b in best] or [0.0])
    for k, b in enumerate(best):
        place[b.bucket] = k
    shared = spark.sparkContext.broadcast(place)

    def kept_features(batches):
        for batch in batches:
            found = [(k := shared.value[np.unique(ngram_buckets(t))])[k >= 0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["label", "features"])

    sample = texts.mapInArrow(kept_features, "label int, features array<int>").toArrow()
    y = sample.column("label").to_numpy().astype(float)
    sizes = np.array([len(x) for x in sample.column("features")], np.int64)
    feature = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x.values, np.int64) for x in sample.column("features"))])
    row = np.repeat(np.arange(len(y)), sizes)
    value = ratios[feature] / sizes[row] ** POWER if len(feature) else np.zeros(0)
    weights, offset = fit_logistic(row, feature, value, y, len(ratios))
    weight = np.full(1 << BITS, np.nan, np.float32)
    for k, b in enumerate(best):
        weight[b.bucket] = weights[k] * b.ratio
    return Model(weight, offset)


def score_column(docs: DataFrame, model: Model):
    """Function of a text column that gives its score (0 to 1); null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(shared.value.score).astype("float64")
    return lambda col: score(whole_text(col))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text", **fit) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row; repeated rows repeat, an empty table gives none."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **fit)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score_column(docs, model)(text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
