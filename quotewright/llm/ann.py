"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

Every vector is scaled to length 1, rotated at random and reduced to the signs of its
components, packed 64 to a word, with its length and its product with its own code as
correction scalars.  The inner product with a rotated query is estimated from the packed
bits (the query's components in ``QUERY_BITS`` bit planes, counted with and/popcount).  The
estimate errs by at most ``ERROR`` standard deviations in all but rare cases; vectors whose upper
bound reaches the worst of the best found so far are reranked with the original vectors.

* Queries and rows are dealt into blocks of bounded size, and every block of queries meets
  every block of rows, in a task of its own: all codes are searched, none is pruned unseen.
* Vectors that are null, empty, zero, or hold a null or non-finite component take no part,
  nor do those whose length isn't the most frequent one (ties: the longer).
* Rows without a ``vec_id`` take no part.  Rows that repeat one are rows of their own: each is a
  candidate for all others, and each that asks has results of its own.
* Ties go to the smaller id; equal vectors have equal codes and so equal bounds.
* Components may have any finite size: codes and estimates are of vectors divided by their largest
  component.  Scores are the plain products in doubles, which may be infinite; those that are
  not numbers (infinities of both signs meet) come last.
* No usable vector or no query: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import shipped, written

SEED = 7
QUERY_BITS = 4
ERROR = 2.5
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
#: Queries of a block whose estimates are in memory at once.
AT_ONCE = 64


@lru_cache(maxsize=4)
def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, for vectors padded to whole words of 64 components."""
    size = -(-dims // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def rotated(vectors: np.ndarray, seed: int = SEED) -> np.ndarray:
    turn = rotation(vectors.shape[1], seed)
    return vectors @ turn[: vectors.shape[1]]


def largest(vectors: np.ndarray) -> np.ndarray:
    return np.abs(vectors).max(axis=1)


def encode(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs (uint64 words), lengths (infinite ones included), and products of each unit vector with its code."""
    top = largest(vectors)
    even = vectors / top[:, None]
    length = np.sqrt(np.einsum("ij,ij->i", even, even))
    turned = rotated(even / length[:, None], seed)
    bits = turned > 0
    words = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    own = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    with np.errstate(over="ignore"):
        return words, length * top, own


def estimate(
    queries: np.ndarray, words: np.ndarray, length: np.ndarray, own: np.ndarray, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x rows) and their error bounds, from codes alone."""
    turned = rotated(queries, seed)
    size = turned.shape[1]
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << QUERY_BITS) - 1), 1e-300)
    levels = np.rint((turned - low) / step).astype(np.uint8)
    counts = np.zeros((len(queries), len(words)))
    for plane in range(QUERY_BITS):
        packed = np.packbits(levels >> plane & 1, axis=1, bitorder="little").view("<u8")
        for w in range(words.shape[1]):
            counts += np.bitwise_count(packed[:, w, None] & words[None, :, w]) * float(1 << plane)
    ones = np.bitwise_count(words).sum(axis=1).astype(np.float64)
    # sum of the query over positive signs, minus the sum over negative ones
    signed = 2 * (counts * step + low * ones) - turned.sum(axis=1, keepdims=True)
    scale = length / own / np.sqrt(size)
    norm = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
    spread = length * np.sqrt(np.maximum(0, 1 - own**2)) / own / np.sqrt(max(1, size - 1))
    rounding = step * np.sqrt(size / 12) * (length / own / np.sqrt(size))
    return signed * scale, ERROR * (norm * spread + rounding)


def search_block(
    query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: tuple, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k best rows of a block for each query: (number of the query, places, exact scores).

    Estimates are of queries divided by their largest component and of vectors divided
    by the block's; whatever of them is lost in that is lost in the bound's favour.
    """
    top = largest(vectors).max()
    words, _, own_product = codes
    even = vectors / top
    length = np.sqrt(np.einsum("ij,ij->i", even, even))
    for start in range(0, len(queries), AT_ONCE):
        own_rows, own = query_rows[start : start + AT_ONCE], queries[start : start + AT_ONCE]
        size = largest(own)
        asked = own / size[:, None]
        guess, error = estimate(asked, words, length, own_product)
        itself = own_rows[:, None] == rows[None, :]
        best = min(k, len(rows))
        first = np.where(itself, -np.inf, guess)
        lead = np.argpartition(-first, best - 1, axis=1)[:, :best] if best < len(rows) else np.tile(np.arange(best), (len(own), 1))
        exact = np.einsum("qd,qkd->qk", asked, even[lead])
        with np.errstate(over="ignore", invalid="ignore"):
            lost = np.isnan(np.einsum("qd,qkd->qk", own, vectors[lead]))
        exact[lost | np.take_along_axis(itself, lead, axis=1)] = -np.inf
        with np.errstate(over="ignore", divide="ignore"):
            # products that end as infinity or as zero tie, however far apart they are
            reach = np.minimum(exact.min(axis=1), np.finfo(float).max / size / top) - 1e-322 / size / top
        reach = reach - 1e-12 * np.sqrt(np.einsum("ij,ij->i", asked, asked)) * length.max()
        chosen = (guess + error >= reach[:, None]) & ~itself
        for place, query in enumerate(own):
            row = np.flatnonzero(chosen[place])
            with np.errstate(over="ignore", invalid="ignore"):
                scores = np.einsum("ij,j->i", vectors[row], query)
            ranked = np.where(np.isnan(scores), -np.inf, scores)
            if len(row) > k:  # ties with the last one stay for the order by id
                worst = np.partition(ranked, len(row) - k)[len(row) - k]
                row, scores, ranked = row[ranked >= worst], scores[ranked >= worst], ranked[ranked >= worst]
            order = np.lexsort((rows[row], ids[row], np.isnan(scores), -ranked))[:k]
            yield np.full(len(order), start + place), row[order], scores[order]


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding as array<double>) of the rows that take part."""
    values = F.col(embedding).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.filter(finite & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return rows if sizes is None else rows.filter(F.size("embedding") == sizes.dims)


INDEX = "row long, vec_id long, embedding array<double>, code binary, length double, own double"


def build_index(vectors: DataFrame) -> DataFrame:
    """Codes and scalars of usable vectors, saved; every row is indexed and numbered."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("embedding"), batch.num_rows)
            words, length, own = encode(matrix)
            packed = pa.array([x.tobytes() for x in words], pa.binary())
            columns = [*batch.columns, packed, pa.array(length), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "embedding", "code", "length", "own"])

    numbered = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    return written(numbered.mapInArrow(codes, INDEX), "codes")


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def search(index: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows but itself."""
    row_blocks = max(1, -(-index.count() // ROW_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    rows = index.withColumn("r", block(row_blocks)).withColumn("q", every(query_blocks))
    asked = queries.select(  # columns of its own, as both sides come from one table
        F.col("row").alias("query_row"),
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query"),
        block(query_blocks).alias("q"),
        every(row_blocks).alias("r"),
    )

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())]
        if left.num_rows and right.num_rows:
            vectors = _matrix(right.column("embedding"), right.num_rows)
            words = np.frombuffer(b"".join(right.column("code").to_pylist()), "<u8").reshape(right.num_rows, -1)
            codes = (words, right.column("length").to_numpy(), right.column("own").to_numpy())
            asked, ids = _matrix(left.column("query"), left.num_rows), right.column("vec_id").to_numpy()
            own_rows, numbers = left.column("query_row").to_numpy(), right.column("row").to_numpy()
            found = search_block(own_rows, asked, numbers, ids, vectors, codes, k)
            query, place, score = (np.concatenate(x) for x in zip(*found, strict=True))
            columns = [own_rows[query], left.column("query_id").to_numpy()[query], numbers[place], ids[place], score]
        return pa.table(dict(zip(("query_row", "query_id", "row", "vec_id", "score"), columns, strict=True)))

    best = asked.groupBy("q", "r").cogroup(rows.groupBy("q", "r")).applyInArrow(nearest, FOUND)
    order = Window.partitionBy("query_row").orderBy(F.isnan("score"), F.desc("score"), "vec_id", "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """Rows of (vec_id, embedding) for which ``is_query`` holds, against all others."""
    shipped(vectors.sparkSession)
    index = build_index(usable(vectors))
    return search(index, index.filter(is_query), k)
