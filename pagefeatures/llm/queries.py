"""Registered queries of the operators: (spark, sf_dir) -> DataFrame, and their SQL where SQL can express it."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, bpe, exact_dedup, line_dedup, mixing, packing, quality_rules, resample, secret_scan, simhash,
               toxicity, url_rules, vector_codes)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled quality 1; as large a share stays as they have among the labelled ones."""
    labels = table(spark, sf_dir, "labels").where("quality IS NOT NULL")
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    return resample.importance_sample(table(spark, sf_dir, "documents"), labels.where("quality = 1"), share)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{secret_scan.KINDS[k]}") for k in range(3)],
                       F.sha2(secret_scan.spans_text("base"), 256).alias("base_sha256"),
                       secret_scan.spans_text("spans").alias("spans"))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_rules.judge_urls(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "host", "path", F.when(F.col("rank") == 1, F.col("rule")).alias("rule"), "verdict",
                       F.when(F.col("rank") == 0, F.col("rule")).alias("word_rule"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes("v1").alias("kept"),
                       "failed")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", F.expr("CAST(octet_length(ids) div 4 AS LONG)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False)
    return rows.withColumnRenamed("groups", "groups_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(vector_codes.codebook_text(books).encode()).hexdigest()
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_importance_resampling, op2_secret_scan, op3_pattern_packing, op4_url_rules, op5_quality_rules,
    op6_exact_dedup, op7_line_dedup, op8_toxicity, op9_simhash, op10_bpe, op11_tokenizer_alignment,
    op12_vector_codes, op13_source_mix)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PATTERNS = ", ".join(["(NULL, NULL)", *(f"('{r.name}', '{r.pattern}')" for r in url_rules.WORD_RULES + url_rules.PATTERN_RULES)])


def vector_codes_sql(dims: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The codes of ``embeddings`` by plain distances (dot products of whole numbers, exact in doubles)."""
    width = dims // parts
    steps = [f"""
        kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS MATERIALIZED (SELECT vec_id, label, p, v[p * {width} + 1:p * {width} + {width}] AS x
                             FROM kept CROSS JOIN range({parts}) AS r(p)),
        book0 AS MATERIALIZED (SELECT p, e, x AS y FROM (
            SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < {entries})"""]
    near = """
        near{k} AS MATERIALIZED (SELECT vec_id, label, p, x, unnest(min([d, e])) AS best, generate_subscripts(min([d, e]), 1) AS i FROM (
            SELECT c.*, e, list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y) AS d
            FROM cut c JOIN book{k} USING (p)) GROUP BY vec_id, label, p, x)"""
    mean = ", ".join(f"floor(sum(x[{j + 1}]) / count(*))" for j in range(width))
    for k in range(rounds + 1):
        steps.append(near.format(k=k))
        if k < rounds:
            steps.append(f"""
        book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, y) AS y FROM book{k} LEFT JOIN (
            SELECT p, best::BIGINT AS e, [{mean}] AS m FROM near{k} WHERE i = 2 GROUP BY p, best) USING (p, e))""")
    return f"""
        WITH {",".join(steps)},
        coded AS (SELECT vec_id, label, string_agg(printf('%02x', best::BIGINT), '' ORDER BY p) FILTER (i = 2) AS code,
                         sum(best) FILTER (i = 1)::BIGINT AS error FROM near{rounds} GROUP BY vec_id, label)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda v: v::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
        FROM coded"""


ORACLE_SQL = {
    "op12_vector_codes": vector_codes_sql(),
    "op4_url_rules": rf"""
        WITH parts AS (
          SELECT page_id, {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        ruled AS (SELECT *, CASE
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts),
        rules(word, pattern) AS (VALUES {_PATTERNS}),
        words AS (SELECT ruled.*, word, pattern FROM ruled CROSS JOIN rules),
        found AS (SELECT page_id, host, path, rule, max_by(word, (length(word), word)) AS word FROM words
                  WHERE word IS NULL OR regexp_matches(host || path, pattern) GROUP BY ALL)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR word IS NOT NULL THEN 'block'
                    ELSE 'allow' END AS verdict,
               CASE WHEN rule IS NULL THEN word END AS word_rule
        FROM found""",
    "op6_exact_dedup": f"""
        WITH normal AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
        FROM normal""",
    "op7_line_dedup": f"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, pos, lines[pos] AS line, trim({_LOWER.format("lines[pos]")}, {_BLANKS}) AS key
                  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split)),
        common AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
                   GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT l.*, c.keeper IS NOT NULL AND c.keeper <> l.doc_id AS goes FROM lines l LEFT JOIN common c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
