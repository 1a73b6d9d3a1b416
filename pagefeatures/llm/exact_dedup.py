"""Exact dedup by an extendible-hash index on shared files.

Texts are equal when they are identical after lower-casing A-Z.

* ``hash_entries``: one row for each document with the 64-bit hash of its
  normalised text (the key) and its SHA-256.  No text.
* The **directory** maps the leading bits of a key to a bucket.  A bucket
  with more than ``capacity`` distinct keys is split by the next bit; when its
  depth passes the directory's, the directory doubles.  Keys are counted by
  their next bits, some doublings at a time; buckets that are still too full
  go to the next round, down to the last bit, where a bucket has one key.
  The directory is a table like any other: nothing of it reaches the driver.
* Keys that occur once need no comparison.  Texts with a key that occurs
  again are grouped by key and whole text, which compares their bytes;
  copies combine on the map side, so a text that a third of the corpus
  shares reaches its group as one row from each task.
* **Owner tasks** each take a range of buckets, that is a range of keys, put
  the texts of a key into one chain (several when different texts collide),
  and write the index files, sorted by bucket, key and chain.
* The index answers for every document: the directory leads its key to a
  bucket, the bucket's chain has its SHA-256.  Two texts with equal key and
  equal SHA-256 but different bytes end the run with an error.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, stored, whole_text

#: doublings that one round counts at most, so cells of one bucket
ROUND_BITS = 16


def key_of(normal: Column, hash_bits: int = 64) -> Column:
    """64-bit key of a text; fewer ``hash_bits`` make collisions likely (for tests)."""
    key = F.xxhash64(normal)
    return key if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - hash_bits), 64 - hash_bits)


def hash_entries(df: DataFrame, hash_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, sha) of every row."""
    texts = df.select(F.col(id_col).alias("id"), ascii_lower(whole_text(text_col)).alias("normal"))
    return texts.select("id", key_of(F.col("normal"), hash_bits).alias("key"), F.unhex(F.sha2("normal", 256)).alias("sha"))


def leading(key: str, bits: int) -> Column:
    """The first ``bits`` (one at least) of a 64-bit number."""
    return F.shiftrightunsigned(key, 64 - bits)


def place_keys(keys: DataFrame, capacity: int) -> DataFrame:
    """``keys`` (key, n; distinct keys) with the bucket of each and its depth.

    A bucket is named by its first address: its leading bits and zeros.
    """
    done, depth = [], 0
    left, most = keys.withColumn("parent", F.lit(0).cast("long")), keys.count()
    while True:
        bits = min(ROUND_BITS, 64 - depth, max(1, math.ceil(math.log2(max(most / capacity, 1))) + 3))
        deepest = depth + bits
        cells = left.groupBy("parent", leading("key", deepest).alias("cell")).agg(F.count(F.lit(1)).alias("keys"))
        fits = []
        for d in range(depth if depth == 0 else depth + 1, deepest + 1):
            cells = cells.withColumn(f"at{d}", F.shiftrightunsigned("cell", deepest - d) if d else F.lit(0).cast("long"))
            cells = cells.withColumn(f"keys{d}", F.sum("keys").over(Window.partitionBy("parent", f"at{d}")))
            fits.append(F.when(F.col(f"keys{d}") <= capacity, F.struct(
                F.lit(d).alias("depth"), (F.shiftleft(f"at{d}", 64 - d) if d else F.lit(0).cast("long")).alias("bucket"))))
        cells = stored(cells.select("parent", "cell", F.coalesce(*fits).alias("found"), F.col(f"keys{deepest}").alias("keys")),
                       f"exact-directory-{depth}")
        placed = left.withColumn("cell", leading("key", deepest)).join(cells.drop("keys"), ["parent", "cell"])
        done.append(placed.where("found IS NOT NULL").select("key", "n", "found.bucket", "found.depth"))
        most = cells.where("found IS NULL").agg(F.max("keys")).first()[0]
        if most is None:
            return reduce(DataFrame.unionByName, done)
        left = stored(placed.where("found IS NULL").select("key", "n", F.col("cell").alias("parent")), f"exact-overfull-{deepest}")
        depth = deepest


def build_index(df: DataFrame, entries: DataFrame, placed: DataFrame, hash_bits: int = 64, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(bucket, depth, key, chain, sha, keep_id, group_size): one row for each different text, written by its owner."""
    repeated = placed.where("n > 1").select("key")
    again = entries.join(repeated, "key").select("id")
    named = df.select(F.col(id_col).alias("name"), F.col(text_col).alias("text"))
    # an id may be null or repeat: the key is computed again from the text that came with it
    compared = (named.join(again.distinct(), F.col("name").eqNullSafe(F.col("id")), "left_semi")
                .select(F.col("name").alias("id"), ascii_lower(whole_text("text")).alias("normal"))
                .groupBy(key_of(F.col("normal"), hash_bits).alias("key"), "normal")
                .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                .select("key", F.unhex(F.sha2("normal", 256)).alias("sha"), "keep_id", "group_size"))
    # rows of a repeated id may bring a text along whose key occurs once: it is among the single ones already
    compared = compared.join(repeated, "key", "left_semi")
    single = (entries.join(placed.where("n = 1").select("key"), "key")
              .select("key", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")))
    found = compared.unionByName(single).join(placed.select("key", "bucket", "depth"), "key")

    chain = Window.partitionBy("bucket", "key")
    same = Window.partitionBy("bucket", "key", "sha")
    index = (found.repartitionByRange("bucket")
             .withColumn("chain", F.row_number().over(chain.orderBy(F.desc_nulls_last("keep_id"), "sha")))
             .withColumn("same", F.count(F.lit(1)).over(same))
             .withColumn("sha", F.when(F.col("same") == 1, F.col("sha"))
                         .otherwise(F.raise_error(F.lit("two texts with one key and one SHA-256"))))
             .drop("same").sortWithinPartitions("bucket", "key", "chain"))
    return stored(index, "exact-index")


def look_up(entries: DataFrame, placed: DataFrame, index: DataFrame) -> DataFrame:
    """``entries`` with what their text's place in the index says: bucket by the directory, then key and chain."""
    in_bucket = entries.join(placed.select("key", "bucket"), "key")
    return in_bucket.join(index.select("bucket", "key", "sha", "chain", "keep_id", "group_size"), ["bucket", "key", "sha"])


def exact_duplicates(df: DataFrame, capacity: int = 256, hash_bits: int = 64, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256) of every row.

    Of equal texts the largest id stays; a null text counts as empty and
    equals the empty one.  Null ids are smaller than any other and stay only
    in groups without an id; repeated rows of the id that stays are all
    kept, as one document.  An empty table gives no rows.
    """
    entries = stored(hash_entries(df, hash_bits, id_col, text_col), "exact-entries")
    keys = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    placed = stored(place_keys(keys, capacity), "exact-placed")
    index = build_index(df, entries, placed, hash_bits, id_col, text_col)
    return look_up(entries, placed, index).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
