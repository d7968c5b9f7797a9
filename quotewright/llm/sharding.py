"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

The rows of each input block (consecutive rows of a file) are dealt to the shards in exact
numbers: how many go where is one row of a random matrix whose row sums are the blocks'
sizes and whose column sums are the shards' sizes.  Each task draws its own rows of that
matrix by walking down a binary tree over the blocks, halving the open places of all
shards by multivariate hypergeometric draws; the draws of a node are seeded by the node, so
all tasks see the same matrix and nobody holds it whole.  Within a block a random permutation
decides which rows fill those numbers.  After the exchange the rows of a shard are put in
the order of independent random keys.

* A shard is exchanged in cells of bounded size, not in one task.
* Shard and slot depend on the seed and on a row's place in its file only, so a repeated task
  repeats them.  Input that isn't read straight from files is written to the shared folder first.
* Rows aren't looked at: nulls, empty texts, ties and repeated rows are shuffled like any others, and
  equal texts aren't kept together.  An empty table stays empty.  There may be more
  shards than rows.
* Broadcast: 24 bytes for each input file and block, which the driver lists anyway.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import shipped, unused, written

#: Consecutive rows of a file that are permuted together.
BLOCK_ROWS = 1 << 16
#: Rows of a shard that one task orders.
CELL_ROWS = 1 << 13
#: numpy draws hypergeometric numbers for populations below this.
NUMPY_LIMIT = 10**9


def _log_ways(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` places are good ones.  Beyond numpy's limit: rejection from a
    flat top with exponential tails, which covers every log-concave distribution."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    log_at = lambda x: _log_ways(good, x) + _log_ways(bad, draws - x)
    top = log_at(mode)
    peak = math.exp(top - _log_ways(good + bad, draws))
    width = 1 + peak / 2
    while True:
        u, v, w = rng.random(3)
        y = v * width / peak if u < width / (1 + width) else (width + rng.exponential()) / peak
        x = mode + round(y) * (1 if rng.random() < 0.5 else -1)
        if low <= x <= high and w * min(1.0, math.exp(width - peak * y)) <= math.exp(log_at(x) - top):
            return x


def deal(rng: np.random.Generator, places: np.ndarray, draws: int) -> np.ndarray:
    """``draws`` of all open places at random, counted by shard."""
    out = np.zeros_like(places)
    rest = int(places.sum())
    for k, own in enumerate(places.tolist()):
        if not draws:
            break
        rest -= own
        out[k] = hypergeometric(rng, own, rest, draws) if rest else draws
        draws -= int(out[k])
    return out


class Matrix:
    """Block sizes and shard sizes; ``row`` draws how many rows of a block go where."""

    def __init__(self, sizes: np.ndarray, shards: int, seed: int) -> None:
        self.before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        total = int(self.before[-1])
        self.places = np.array([total // shards + (k < total % shards) for k in range(shards)], np.int64)
        self.seed = seed
        self._node = lru_cache(maxsize=4096)(self._places_of)

    def _places_of(self, low: int, high: int, depth: int) -> np.ndarray:
        """The places of the blocks from ``low`` to ``high``: a node of the tree."""
        if not depth:
            return self.places
        parent_low, parent_high = self._parent(low, high, depth)
        middle = (parent_low + parent_high) // 2
        whole = self._node(parent_low, parent_high, depth - 1)
        rng = np.random.default_rng([self.seed, 1, parent_low, parent_high])
        left = deal(rng, whole, int(self.before[middle] - self.before[parent_low]))
        return left if low == parent_low else whole - left

    def _parent(self, low: int, high: int, depth: int) -> tuple[int, int]:
        a, b = 0, len(self.before) - 1
        for _ in range(depth - 1):
            middle = (a + b) // 2
            a, b = (a, middle) if low < middle else (middle, b)
        return a, b

    def row(self, block: int) -> np.ndarray:
        a, b, depth = 0, len(self.before) - 1, 0
        while b - a > 1:
            middle = (a + b) // 2
            a, b = (a, middle) if block < middle else (middle, b)
            depth += 1
        return self._node(a, b, depth)

    def block(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard and the random key of each row of a block."""
        rng = np.random.default_rng([self.seed, 2, block])
        counts = self.row(block)
        shard = rng.permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts))
        return shard, rng.integers(0, 1 << 62, len(shard))


def _placed(rows: DataFrame, file: str, row: str) -> DataFrame | None:
    """The rows with the file and the place that they were read from, if they were."""
    try:
        return rows.select(
            "*",
            F.xxhash64(rows.metadataColumn("_metadata")["file_path"]).alias(file),
            rows.metadataColumn("_metadata")["row_index"].alias(row),
        )
    except AnalysisException:
        return None


def shuffle_to_shards(rows: DataFrame, shards: int, seed: int = 0, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """All columns, then the shard from 0 and the slot in it from 0, without gaps; columns
    of those two names are replaced."""
    shipped(rows.sparkSession)
    file, row, deal_to, cell, key, first, to, of = unused(
        rows, "file_", "row_", "deal_", "cell_", "key_", "first_", "to_", "of_"
    )
    if (placed := _placed(rows, file, row)) is None:
        rows = written(rows, "unsharded")
        placed = _placed(rows, file, row)
    files = placed.groupBy(file).agg(F.max(row).alias("last"), F.count("*").alias("n")).orderBy(file).collect()
    if any(x["last"] + 1 != x["n"] for x in files):  # rows were filtered out after reading
        rows = written(rows, "unsharded")
        return shuffle_to_shards(rows, shards, seed, shard, slot)
    names = np.array([x[file] for x in files], np.int64)
    per_file = [[min(BLOCK_ROWS, x["n"] - k) for k in range(0, x["n"], BLOCK_ROWS)] for x in files]
    first_block = np.cumsum([0, *map(len, per_file)])
    sizes = np.array([n for blocks in per_file for n in blocks], np.int64)
    cells = max(1, -(-int(sizes.sum()) // (shards * CELL_ROWS)))
    shared = rows.sparkSession.sparkContext.broadcast((names, first_block, sizes.tobytes()))

    @F.pandas_udf("shard int, key long")
    def dealt(files: pd.Series, places: pd.Series) -> pd.DataFrame:
        names, first_block, sizes = shared.value
        block = first_block[np.searchsorted(names, files.to_numpy())] + places.to_numpy() // BLOCK_ROWS
        inside = places.to_numpy() % BLOCK_ROWS
        out = pd.DataFrame({"shard": np.zeros(len(block), np.int32), "key": np.zeros(len(block), np.int64)})
        for k in np.unique(block):
            own = block == k
            to, keys = _block(sizes, shards, seed, int(k))
            out.loc[own, "shard"], out.loc[own, "key"] = to[inside[own]], keys[inside[own]]
        return out

    def assigned(df: DataFrame) -> DataFrame:
        with_deal = df.withColumn(deal_to, dealt(F.col(file), F.col(row)))
        columns = [f"`{c}`" for c in df.columns]
        out = with_deal.select(*columns, F.col(f"{deal_to}.shard").alias(deal_to), F.col(f"{deal_to}.key").alias(key))
        return out.withColumn(cell, F.shiftright(F.shiftright(F.col(key), 31) * cells, 31))

    numbers = assigned(placed.select(file, row)).groupBy(deal_to, cell).count()
    before = F.sum("count").over(Window.partitionBy(deal_to).orderBy(cell)) - F.col("count")
    offsets = written(numbers.select(F.col(deal_to).alias(to), F.col(cell).alias(of), before.alias(first)), "cells")
    order = Window.partitionBy(deal_to, cell).orderBy(key, file, row)
    moved = assigned(placed).repartition(deal_to, cell).withColumn(row, F.row_number().over(order) - 1)
    joined = moved.join(offsets, (F.col(deal_to) == F.col(to)) & (F.col(cell) == F.col(of)))
    kept = [f"`{c}`" for c in rows.columns if c not in (shard, slot)]
    return joined.select(*kept, F.col(deal_to).alias(shard), (F.col(first) + F.col(row)).alias(slot))


@lru_cache(maxsize=2)  # for the rows of a task
def _matrix(sizes: bytes, shards: int, seed: int) -> Matrix:
    return Matrix(np.frombuffer(sizes, np.int64), shards, seed)


@lru_cache(maxsize=4)
def _block(sizes: bytes, shards: int, seed: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    return _matrix(sizes, shards, seed).block(block)
