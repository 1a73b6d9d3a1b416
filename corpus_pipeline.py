"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
stage before kept.  ``run`` writes each stage's rows to the shared folder
and reads them again, so a lost executor costs no more than its tasks.  All
stages but the last return the columns of ``documents``.  Rows that share a
doc_id are one document.  Nulls, empty texts and empty tables pass through
every stage as its operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagefeatures.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from pagefeatures.llm.common import ascii_lower, stored, whole_text
from pagefeatures.sources.tables import run_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5; it learns from the labels of ``documents`` still here."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_column(docs, model)("text") < 0.5)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the document with the largest id."""
    gone = (exact_dedup.exact_duplicates(docs).where(~F.col("kept"))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha")))
    sha = F.sha2(ascii_lower(whole_text(docs["text"])), 256)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (sha == gone["gone_sha"]), "left_anti")


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link (3-word shingles, 3 bits) the one with the smallest id."""
    groups = simhash.near_duplicates(docs, shingle=3, distance=3)
    stays = groups.groupBy("doc_id").agg(F.max(F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))).alias("stays"))
    gone = stays.where(~F.col("stays")).select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced by a mark and n_chars counted again."""
    rows = secret_scan.scan_rows(docs, keep=tuple(docs.columns))
    text = secret_scan.redact(F.col("row").getField("text"), F.col("spans"))
    rows = rows.select("row", (F.size("spans") > 0).alias("changed"), text.alias("text"))
    kept = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept["n_chars"] = F.when(F.col("changed"), count).otherwise(kept["n_chars"])
    return rows.select(*[kept[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact), ("SimHash near-dedup", drop_near),
          ("secret scans", redact_secrets), ("best-fit packing", pack_sequences)]

#: A trained classifier, random-access fingerprints and a tokenizer are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all of ``documents``.

    Tables between and within the stages are dropped when the last one is written, and stay if a stage fails.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with run_folder(spark):
        for k, (_, stage) in enumerate(STAGES[:-1]):
            docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
        return stored(STAGES[-1][1](spark, docs, sf_dir), "pipeline", result=True)
