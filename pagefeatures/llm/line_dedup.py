"""Line dedup: range-partitioned line hashes, keep bitmaps instead of text.

A line's key is the line without white space at its ends and with A-Z in
lower case.  Keys of ``least_chars`` or more that stand in ``least_docs`` or
more documents lose all their lines except in the largest document that
has them.

1. Lines become (id, text hash, position, 128-bit key hash); texts stay behind.
2. They are dealt out by range of (hash, document, position) and sorted so,
   the largest document first, and written with the number of their range.
   A range may end anywhere, also within one key, so a line that a third of
   the corpus has is spread over as many ranges as its rows fill.
3. A window streams over each key within its range: the first row tells the
   largest document there, the rank of documents how many there are.
4. A key that goes on in the next range is the last of one and the first of
   the other.  So a table of range edges, two keys for each range at most,
   gives these keys their document and count over all ranges.
5. Each document gets a bitmap of its lines, of which only the 64-line words
   with a dropped line are stored.  The texts are read again and the bitmap
   applied; lines never travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import ascii_lower, stored, whole_text

# The white space stripped from a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_hashes(df: DataFrame, least_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, pos, h1, h2) of every line whose key has ``least_chars`` characters or more."""
    # the text's hash comes before its lines: after them it would be computed for each
    texts = df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("row", F.xxhash64("text"))
    keys = F.transform(F.split(ascii_lower(F.col("text")), "\n"),
                       lambda line, pos: F.struct(pos.alias("pos"), F.btrim(line, F.lit(BLANKS)).alias("key")))
    long_keys = F.filter(keys, lambda k: F.char_length(k["key"]) >= least_chars)
    hashes = F.transform(long_keys, lambda k: F.struct(
        k["pos"].alias("pos"), F.xxhash64(k["key"]).alias("h1"), F.xxhash64(F.lit(1), k["key"]).alias("h2")))
    return texts.select("id", "row", F.inline(hashes))


def sorted_ranges(lines: DataFrame, ranges: int | None = None) -> DataFrame:
    """``lines`` by range of hash, document (largest first) and position, with the number of the range (part)."""
    order = ["h1", "h2", F.desc_nulls_last("id"), "pos"]
    dealt = lines.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    return stored(dealt.withColumn("part", F.spark_partition_id()), "line-ranges")


def edge_keys(ranged: DataFrame) -> DataFrame:
    """(part, h1, h2, keeper_of_all, docs_of_all, edge) of the keys that more than one range has.

    Only the first and the last key of a range can be elsewhere too.  Null is
    a document smaller than any other.
    """
    key = F.struct("h1", "h2")
    ends = ranged.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))  # a row for each range
    nulls = F.max(F.col("id").isNull())
    rows = (ranged.join(F.broadcast(ends), "part").where((key == F.col("low")) | (key == F.col("high")))
            .groupBy("part", "h1", "h2").agg(
                F.max("id").alias("keeper"), F.when(~nulls, F.min("id")).alias("least"),
                (F.count_distinct("id") + nulls.cast("int")).alias("docs")))
    over = Window.partitionBy("h1", "h2")
    by_part = over.orderBy("part")
    # a document whose rows go on in the next range has been counted in both
    again = F.lag("least").over(by_part).eqNullSafe(F.col("keeper")) & (F.row_number().over(by_part) > 1)
    rows = rows.withColumn("again", again.cast("int")).withColumn("ranges", F.count(F.lit(1)).over(over))
    return rows.where("ranges > 1").select(
        "part", "h1", "h2", F.first("keeper").over(by_part).alias("keeper_of_all"),
        (F.sum("docs").over(over) - F.sum("again").over(over)).alias("docs_of_all"), F.lit(True).alias("edge"))


def dropped_lines(lines: DataFrame, least_docs: int = 3, ranges: int | None = None) -> DataFrame:
    """(id, row, pos) of the lines that go."""
    ranged = sorted_ranges(lines, ranges)
    edges = stored(edge_keys(ranged), "line-edges")  # two rows a range at most
    by_key = Window.partitionBy("part", "h1", "h2")
    ordered = by_key.orderBy(F.desc_nulls_last("id"))
    rows = (ranged.withColumn("keeper", F.first("id").over(ordered))
            .withColumn("nth", F.dense_rank().over(ordered))
            .withColumn("docs", F.max("nth").over(by_key))
            .join(F.broadcast(edges), ["part", "h1", "h2"], "left"))
    keeper = F.when(F.col("edge"), F.col("keeper_of_all")).otherwise(F.col("keeper"))
    docs = F.when(F.col("edge"), F.col("docs_of_all")).otherwise(F.col("docs"))
    return rows.where((docs >= least_docs) & ~F.col("id").eqNullSafe(keeper)).select("id", "row", "pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(id, row, words): for each document the words of its bitmap that aren't all zero, as (word, bits), in order."""
    words = (dropped.select("id", "row", F.expr("CAST(pos div 64 AS INT)").alias("word"),
                            F.expr("shiftleft(1L, pos % 64)").alias("bit"))
             .groupBy("id", "row", "word").agg(F.bit_or("bit").alias("bits")))
    return words.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dedup_lines(df: DataFrame, least_chars: int = 20, least_docs: int = 3, ranges: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_lines, n_dropped, bitmap, kept_text) of every row.

    ``bitmap`` lists (word, bits) of dropped lines, null if none goes.  A null
    or empty text is one empty line, which stays.  Rows with one id are one
    document: they count once, and lines stay in all of them or in none.
    Null ids count as one document, smaller than any other.  Repeated rows
    repeat, an empty table gives no rows.
    """
    lines = stored(line_hashes(df, least_chars, id_col, text_col), "line-hashes")
    bitmaps = stored(drop_bitmaps(dropped_lines(lines, least_docs, ranges)), "line-bitmaps")
    texts = df.select(F.col(id_col).alias("name"), whole_text(text_col).alias("text"))
    joined = texts.withColumn("hash", F.xxhash64("text")).join(
        bitmaps, F.col("name").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("row")), "left")
    # most texts lose nothing and are not taken apart; for the others the words become a dense array
    dense = """flatten(transform(words, (w, i) -> concat(
        array_repeat(0L, w.word - coalesce(get(words, i - 1).word, -1) - 1), array(w.bits))))"""
    kept = F.expr(f"""CASE WHEN words IS NULL THEN text ELSE get(transform(array({dense}), bits -> array_join(filter(split(text, '\n'),
        (line, pos) -> (shiftright(coalesce(get(bits, CAST(pos div 64 AS INT)), 0L), pos % 64) & 1L) = 0), '\n')), 0) END""")
    gone = F.expr("coalesce(aggregate(words, 0L, (n, w) -> n + bit_count(w.bits)), 0L)")
    return joined.select(
        F.col("name").alias(id_col), F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        gone.alias("n_dropped"), F.col("words").alias("bitmap"), kept.alias("kept_text"))
