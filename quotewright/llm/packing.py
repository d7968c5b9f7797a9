"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents are tokenised, ended by one separator id and, only where they exceed a sequence,
cut into pieces of its full length (the first piece may be shorter).  Full pieces are
sequences of their own.  The others are dealt into blocks of bounded size.  Several
islands evolve packings of the same block: a crossover injects whole well-filled bins of
one parent into another, removes the bins that repeat their documents and best-fits the
displaced ones.  Between epochs each island's elite migrates to its neighbour, and the best
island of a block wins.  What a block fills badly is pooled over all blocks and packed again.

* Null and empty texts are documents of one separator; none is dropped.
* Rows are told apart by their place, so equal rows are packed as often as they occur.
* An empty table gives no pieces.
* Everything is seeded by block, island and epoch, so a repeated task repeats its result;
  pieces and packings are tables in the shared folder.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm import bpe
from quotewright.llm.common import shipped, unused, written

CAPACITY = 2048
#: Documents of a block; bounds the memory and time of a task, not the corpus.
BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 5
GENERATIONS = 20
#: Bins filled below this share are pooled and packed again with those of other blocks.
WELL_FILLED = 0.99
REPACKS = 2

PIECES = "array<struct<piece:int,start:long,length:long,ids:binary>>"


def pieces_column(text: Column, vocabulary: str, capacity: int = CAPACITY, separator: int = 0) -> Column:
    """The pieces of a document with their ids (little-endian unsigned 32-bit)."""

    @F.arrow_udf(PIECES)
    def cut(texts: pa.Array) -> pa.Array:
        counts, rows = [], ([], [], [], [])
        for first, ids in bpe.load(vocabulary).encode(texts):
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                own = np.append(ids[a:b], separator).astype("<u4")
                head = len(own) % capacity or capacity
                edges = [0, *range(head, len(own) + 1, capacity)]
                counts.append(len(edges) - 1)
                for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(rows, (k, x, y - x, own[x:y].tobytes()), strict=True):
                        column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        values = [pa.array(x, kind) for x, kind in zip(rows, kinds, strict=True)]
        flat = pa.StructArray.from_arrays(values, names=["piece", "start", "length", "ids"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)

    return cut(text)


def cut_documents(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: the other columns, then piece, start, length and ids."""
    shipped(docs.sparkSession)
    (found,) = unused(docs, "found_piece")
    kept = [f"`{c}`" for c in docs.columns if c != text and c not in ("piece", "start", "length", "ids")]
    rows = docs.select(*kept, F.explode(pieces_column(docs[text], vocabulary, capacity)).alias(found))
    return rows.select(*kept, *[F.col(f"{found}.{c}").alias(c) for c in ("piece", "start", "length", "ids")])


class Packing:
    """Bins of items with the open space of each, found by best fit through one bit set."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.bins, self.space = sizes, {}, {}
        self._next, self._open, self._by_space = 0, 0, [[] for _ in range(capacity + 1)]
        self._capacity = capacity

    def copy(self) -> Packing:
        other = Packing(self.sizes, self._capacity)
        other.bins = {k: v[:] for k, v in self.bins.items()}
        other.space = dict(self.space)
        other._next, other._open = self._next, self._open
        other._by_space = [x[:] for x in self._by_space]
        return other

    def _file(self, k: int, space: int) -> None:
        self.space[k] = space
        self._by_space[space].append(k)
        self._open |= 1 << space

    def _unfile(self, k: int) -> None:
        space = self.space.pop(k)
        shelf = self._by_space[space]
        shelf.remove(k)
        if not shelf:
            self._open ^= 1 << space

    def add_bin(self, items: list[int]) -> None:
        k, self._next = self._next, self._next + 1
        self.bins[k] = items
        self._file(k, self._capacity - sum(self.sizes[i] for i in items))

    def remove_bin(self, k: int) -> list[int]:
        self._unfile(k)
        return self.bins.pop(k)

    def best_fit(self, items: list[int]) -> None:
        """Each item goes to the bin that it leaves the least space in."""
        for i in items:
            size = self.sizes[i]
            fitting = self._open >> size
            if not fitting:
                self.add_bin([i])
                continue
            k = self._by_space[(fitting & -fitting).bit_length() - 1 + size][-1]
            space = self.space[k]
            self._unfile(k)
            self.bins[k].append(i)
            self._file(k, space - size)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then the mean square of their fill."""
        fills = ((self._capacity - x) ** 2 for x in self.space.values())
        return -len(self.bins), sum(fills) / (len(self.bins) or 1)

    def numbers(self) -> list[int]:
        """The bin of every item."""
        out = [0] * len(self.sizes)
        for number, items in enumerate(self.bins.values()):
            for i in items:
                out[i] = number
        return out


def crossover(giver: Packing, taker: Packing, rng: random.Random) -> Packing:
    """Inject some of the giver's well-filled bins into the taker, whole."""
    ranked = sorted(giver.bins, key=giver.space.__getitem__)
    well = ranked[: max(1, len(ranked) // 2)]
    chosen = rng.sample(well, max(1, len(well) // 2))
    injected = {i for k in chosen for i in giver.bins[k]}
    child = taker.copy()
    displaced: list[int] = []
    for k in [k for k, items in child.bins.items() if not injected.isdisjoint(items)]:
        displaced += [i for i in child.remove_bin(k) if i not in injected]
    for k in chosen:
        child.add_bin(giver.bins[k][:])
    child.best_fit(sorted(displaced, key=lambda i: -child.sizes[i]))
    return child


def mutate(packing: Packing, rng: random.Random) -> None:
    """Empty the worst bins and a few others, and best-fit their items in a shaken order."""
    ranked = sorted(packing.bins, key=packing.space.__getitem__)
    gone = set(ranked[-max(1, len(ranked) // 50) :]) | set(rng.sample(ranked, min(len(ranked), 3)))
    items = [i for k in gone for i in packing.remove_bin(k)]
    packing.best_fit(sorted(items, key=lambda i: -packing.sizes[i] * rng.uniform(0.9, 1.0)))


def evolve(sizes: list[int], elites: list[list[int]], seed: str, capacity: int = CAPACITY) -> list[list[int]]:
    """One island's epoch: the bins of every item in its two best packings, best first."""
    rng = random.Random(seed)
    population: list[Packing] = []
    for numbers in elites:
        own = Packing(sizes, capacity)
        bins: dict[int, list[int]] = {}
        for i, number in enumerate(numbers):
            bins.setdefault(number, []).append(i)
        for items in bins.values():
            own.add_bin(items)
        population.append(own)
    shake = 0.0
    while len(population) < POPULATION:
        own = Packing(sizes, capacity)
        order = {i: -s * rng.uniform(1 - shake, 1) for i, s in enumerate(sizes)}
        own.best_fit(sorted(order, key=order.__getitem__))
        population.append(own)
        shake += 0.1
    least = -(-sum(sizes) // capacity)
    population.sort(key=Packing.fitness, reverse=True)
    for _ in range(GENERATIONS):
        if len(population[0].bins) <= least:
            break
        for _ in range(2):
            first, second = sorted(rng.sample(range(len(population)), 2))
            child = crossover(population[first], population[second], rng)
            mutate(child, rng)
            population[-1] = max(population[-1], child, key=Packing.fitness)
            population.sort(key=Packing.fitness, reverse=True)
    return [x.numbers() for x in population[:2]]


STATE = "block long, island int, keys array<long>, sizes array<int>, elites array<array<int>>"


def _epoch(state: DataFrame, label: str, capacity: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["elites"] = [
                evolve(sizes.tolist(), [x.tolist() for x in elites], f"{label}/{block}/{island}", capacity)
                for block, island, sizes, elites in zip(frame.block, frame.island, frame.sizes, frame.elites, strict=True)
            ]
            yield frame

    return state.mapInPandas(run, STATE)


def _migrated(state: DataFrame, islands: int) -> DataFrame:
    """Each island's best packing joins the population of the next island in the ring."""
    guests = state.select(
        F.col("block").alias("to_block"),
        ((F.col("island") + 1) % islands).alias("to_island"),
        F.col("elites")[0].alias("guest"),
    )
    met = state.join(guests, (F.col("block") == F.col("to_block")) & (F.col("island") == F.col("to_island")))
    return met.select("block", "island", "keys", "sizes", F.concat("elites", F.array("guest")).alias("elites"))


def _pack_blocks(items: DataFrame, n_items: int, label: str, capacity: int) -> tuple[DataFrame, int]:
    """(key, size) to (key, size, block, bin, offset, fill), and the number of blocks."""
    blocks = -(-n_items // BLOCK)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("key", F.lit(label)), F.lit(blocks)))
    rows = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("key", "size"))).alias("rows"))
    state = rows.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("rows.key").alias("keys"),
        F.col("rows.size").alias("sizes"),
        F.lit(None).cast("array<array<int>>").alias("elites"),
    ).withColumn("elites", F.coalesce("elites", F.array().cast("array<array<int>>")))
    parts = max(1, min(blocks * ISLANDS, 1 << 16))
    for epoch in range(EPOCHS):
        state = _migrated(state, ISLANDS) if epoch else state
        state = written(_epoch(state.repartition(parts, "block", "island"), f"{label}/{epoch}", capacity), "islands")

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, keys, sizes, numbers in zip(frame.block, frame["keys"], frame.sizes, frame.best, strict=True):
                out = pd.DataFrame({"key": keys, "size": sizes, "block": block, "bin": numbers})
                out["offset"] = out.groupby("bin")["size"].cumsum() - out["size"]
                out["fill"] = out.groupby("bin")["size"].transform("sum")
                yield out

    worth = F.struct(-F.array_max(F.col("elites")[0]), -F.col("island"))
    best = state.groupBy("block").agg(F.max_by(F.struct("keys", "sizes", F.col("elites")[0].alias("best")), worth).alias("w"))
    chosen = best.select("block", "w.*").mapInPandas(
        choose, "key long, size int, block long, bin int, offset long, fill int"
    )
    return written(chosen, "packed"), blocks


def _bins(packed: DataFrame) -> int:
    return packed.filter(F.col("offset") == 0).count()


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows whose ``length`` is between 1 and ``capacity``."""
    shipped(pieces.sparkSession)
    key, packed_key, sequence, place = unused(pieces, "piece_key", "packed_key", "packed_sequence", "packed_offset")
    placed = written(pieces.withColumn(key, F.monotonically_increasing_id()), "pieces")
    small = placed.filter(F.col(length) < capacity)
    items = small.select(F.col(key).alias("key"), F.col(length).cast("int").alias("size"))
    count = items.count()
    done = []
    packed = poor = None
    for attempt in range(REPACKS + 1):
        if not count:
            break
        fresh, blocks = _pack_blocks(items, count, f"pack{attempt}", capacity)
        fresh = fresh.withColumn("sequence_id", F.lit(attempt + 1) * (1 << 56) + F.col("block") * (1 << 16) + F.col("bin"))
        if poor is not None and _bins(fresh) >= _bins(poor):
            break  # packing the poor bins again saved nothing
        if poor is not None:
            done.append(packed.filter(F.col("fill") >= WELL_FILLED * capacity))
        packed, poor = fresh, fresh.filter(F.col("fill") < WELL_FILLED * capacity)
        left = poor.count() if blocks > 1 else 0
        if -(-left // BLOCK) == blocks:  # every block is alike: there is nothing to pool
            break
        items, count = poor.select("key", "size"), left
    if packed is not None:
        done.append(packed)
    whole = placed.filter(F.col(length) >= capacity)
    rest = [f"`{c}`" for c in pieces.columns if c not in ("sequence_id", "offset")]
    out = whole.select(*rest, F.col(key).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if done:
        found = functools.reduce(DataFrame.unionByName, done)
        found = found.select(F.col("key").alias(packed_key), F.col("sequence_id").alias(sequence), F.col("offset").alias(place))
        joined = small.join(found, F.col(key) == F.col(packed_key))
        out = out.unionByName(joined.select(*rest, F.col(sequence).alias("sequence_id"), F.col(place).alias("offset")))
    return out
