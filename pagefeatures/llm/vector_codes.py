"""Vector code compression: product codes found through per-dimension value dictionaries.

Components become integers and a vector is cut into parts.  Each part has a
codebook of up to 256 entries, fitted by rounds of assignment and integer
means.  Distances come from dictionaries: in each block of vectors a
dimension's distinct integers are its dictionary, the squared differences of
every distinct integer to all entries are tabulated once, and the distances of
the parts are gathers from these tables by the dictionary codes, added up.

The codebooks are bounded by their definition (parts x 256 entries) and so are
what a task adds up for a round: counts and sums for each entry, merged by
Spark.  The vectors stay where they are and are read once a round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship_code, stored

SCALE = 1024
#: integers beyond are taken as this, so that squared distances fit 64 bits
LARGEST = 1 << 26
#: vectors whose distances a task holds at once
ROWS = 8192


def kept_vectors(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector holds numbers alone (no null, NaN or infinity) and at least one."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(vector_col).isNotNull() & finite & (F.size(vector_col) > 0))


def integers(vectors: pa.Array, dims: int, parts: int) -> np.ndarray:
    """floor(1024 * x) of every component, one row a vector, zeros added until ``parts`` divides the width."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    ints = np.floor(np.clip(values * SCALE, -LARGEST, LARGEST)).astype(np.int64)
    return np.pad(ints, ((0, 0), (0, -dims % parts)))


def nearest(ints: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, its squared distance) of every part; ties go to the lower index.

    ``books``: parts x entries x width.
    """
    parts, entries, width = books.shape
    span = max(np.abs(ints).max(initial=0), np.abs(books).max(initial=0)) * 2
    kind = np.int32 if int(span) ** 2 * width < 1 << 31 else np.int64
    index, best = np.empty((len(ints), parts), np.int64), np.empty((len(ints), parts), np.int64)
    for p in range(parts):
        distance, gathered = np.zeros((len(ints), entries), kind), np.empty((len(ints), entries), kind)
        for j in range(width):
            dictionary, codes = np.unique(ints[:, p * width + j], return_inverse=True)
            table = (dictionary[:, None] - books[p, :, j][None, :]).astype(kind) ** 2
            distance += np.take(table, codes, axis=0, out=gathered)
        index[:, p] = distance.argmin(axis=1)
        best[:, p] = np.take_along_axis(distance, index[:, p, None], axis=1)[:, 0]
    return index, best


def partial_sums(vectors: DataFrame, books: np.ndarray, dims: int, vector_col: str) -> DataFrame:
    """(part, entry, n, sums): each task's counts and component sums of the parts nearest to an entry."""
    parts, entries, width = books.shape

    def run(batches):
        n, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ints = integers(batch.column(0).slice(at, ROWS), dims, parts)
                index, _ = nearest(ints, books)
                for p in range(parts):
                    place = index[:, p] + p * entries
                    n += np.bincount(place, minlength=parts * entries)
                    for j in range(width):  # float sums of a block's integers are exact: under 2^13 * 2^26
                        sums[:, j] += np.bincount(place, ints[:, p * width + j], parts * entries).astype(np.int64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // entries, pa.int32()), pa.array(used % entries, pa.int32()), pa.array(n[used]),
             pa.array(list(sums[used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return vectors.select(vector_col).mapInArrow(run, "part int, entry int, n long, sums array<long>")


def fit_codebooks(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> tuple[np.ndarray, int]:
    """(codebooks: parts x entries x width, dimension of the vectors).

    They start as the parts of the ``entries`` smallest kept ids (fewer if
    there are fewer vectors; a null id comes last, equal ids go by vector).
    """
    ship_code(df.sparkSession)
    by_id = kept_vectors(df, vector_col).orderBy(F.col(id_col).asc_nulls_last(), vector_col).select(vector_col)
    first = by_id.first()
    if first is None:
        return np.empty((parts, 0, 0), np.int64), 0
    dims = len(first[0])
    start = [r[0] for r in by_id.where(F.size(vector_col) == dims).limit(entries).collect()]
    books = integers(pa.array(start, pa.list_(pa.float64())), dims, parts).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    vectors = kept_vectors(df, vector_col).where(F.size(vector_col) == dims)
    for _ in range(rounds):
        sums = partial_sums(vectors, books, dims, vector_col).groupBy("part", "entry").agg(
            F.sum("n"), *[F.sum(F.col("sums")[j]) for j in range(books.shape[2])])
        for part, entry, n, *total in sums.collect():  # at most parts x entries rows
            books[part, entry] = [t // n for t in total]
    return books, dims


def encode(df: DataFrame, books: np.ndarray, dims: int, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """(id_col, codes binary, error, label): a byte for each part, and the squared distances added up."""
    id_type, label_type = (df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    vectors = kept_vectors(df, vector_col).where(F.size(vector_col) == dims)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                index, best = nearest(integers(rows.column(1), dims, len(books)), books)
                codes = [x.tobytes() for x in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(codes, pa.binary()), pa.array(best.sum(axis=1)),
                                                  rows.column(2)], names=["id", "codes", "error", "label"])

    return (vectors.select(F.col(id_col), F.col(vector_col), F.col(label_col))
            .mapInArrow(run, f"id {id_type}, codes binary, error long, label {label_type}"))


def codebook_text(books: np.ndarray) -> str:
    """All entries' integers by part, entry and place, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))


def compress(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks.

    Columns: id_col, codes (binary, one byte a part), error (squared distance
    to the coded vector, in integers) and label_error (error added up over
    the rows of equal label, null being one label).  Rows with a null or empty
    vector, or one that holds a null, NaN or infinity, are left out, and so
    are rows whose vector has another length than that of the smallest id.
    Components beyond +-65,536 count as that limit; a label's sum beyond 64 bits is null.  A repeated row is coded
    again; an empty table gives no rows and empty codebooks; other columns
    don't matter.
    """
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")
    books, dims = fit_codebooks(df, parts, entries, rounds, id_col, vector_col)
    coded = stored(encode(df, books, dims, id_col, vector_col, label_col), "vector-codes")
    # one row a label: a hot label is summed before the shuffle; Spark broadcasts the sums if their file is small
    by_label = stored(coded.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    rows = coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"]))
    return rows.select(F.col("id").alias(id_col), "codes", "error", "label_error"), books
