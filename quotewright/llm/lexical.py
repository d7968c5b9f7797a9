"""Ranked lexical search: per-term posting lists in geometric blocks with exact bounds.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lowered.
Documents are read once into a forward table (id, length, counts of the terms that the items
ask for), and N, the total length and the document frequencies are counted over all
documents.  Each task of the search takes its documents in chunks of bounded size and
builds, per chunk and as items need them, the posting list of a term: its documents are
clustered by their similarity (nearest of some of the list's own documents, by random
projections of their impacts), every cluster is a block, and a block's summary is the
coordinatewise maximum of its documents' impacts on the terms that items ask for together
with the list's own.  Lists and summaries are kept for all items of the chunk.

An item's terms are taken in falling order of what they can add.  A list has to find only
documents that hold none of the earlier terms, so a block's bound is the sum of its
summary over the remaining terms.  Blocks whose bound lies below the tenth best score that
the item has in this task are skipped; so is a whole list, and all later ones, once the
chunk's own maxima can't reach it.  All sums are of 64-bit integers, so bounds are exact and no
document that belongs to the result is lost.  A task passes on at most ``k`` rows an item.

* Null texts, and texts without a term, are no documents and no item with results.
* Each row of the items is an item; rows that repeat an item_id have results of their own.
* Each row of the documents is a document; equal scores go by doc_id, a missing one last.
* Items are taken ``ITEMS_AT_ONCE`` at a time, each block with a pass over the documents.
* Of both inputs only the named columns are read.  No documents or no items: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.llm.common import shipped, written

#: The share of a document's length in its weight, of 100.
LENGTH_SHARE = 75
SCALE = 1_000_000_000
#: Documents of a block, on average.
BLOCK = 32
#: Dimensions of the projections that documents are clustered by.
DIMS = 32
#: Documents of a chunk, and cells of its table of impacts.
CHUNK_ROWS = 4096
CHUNK_CELLS = 16_000_000
ITEMS_AT_ONCE = 2000
SEED = 11

#: Every byte of a text as a term holds it, or as a space.
_PLAIN = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


@dataclass(frozen=True)
class Items:
    """Some items: for each the places of its terms in ``vocabulary``, and their repeats."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Items:
        vocabulary: dict[bytes, int] = {}
        terms, repeats = [], []
        for text in texts:
            places = np.array([vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text)], np.int64)
            found, times = np.unique(places, return_counts=True)
            terms.append(found)
            repeats.append(times)
        return cls(vocabulary, terms, repeats)

    def partners(self) -> list[np.ndarray]:
        """For every term the terms that some item asks for together with it."""
        beside: list[set[int]] = [set() for _ in self.vocabulary]
        for found in self.terms:
            for t in found.tolist():
                beside[t].update(found.tolist())
        return [np.array(sorted(x), np.int64) for x in beside]


def term_weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"


def forward_table(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term, saved; ``docs`` has doc_id and text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                known = [x for x in map(vocabulary.get, words) if x is not None]
                found, times = np.unique(np.array(known, np.int32), return_counts=True)
                ids.append(doc_id)
                sizes.append(len(words))
                terms.append(found)
                counts.append(times.astype(np.int32))
            columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [pa.array(x, pa.list_(pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return written(docs.mapInArrow(read, FORWARD), "forward")


def frequencies(forward: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term; at most one number a term comes from a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])

    counted = forward.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(terms, np.int64)
    for row in counted.collect():  # at most one row a term of a block of items
        out[row["term"]] = row["df"]
    return out


@dataclass
class Chunk:
    """Some documents: their impacts on all terms, and the lists built so far."""

    impacts: np.ndarray
    partners: list[np.ndarray]
    lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.most = self.impacts.max(axis=0).astype(np.int64)
        draw = np.random.default_rng([SEED, self.impacts.shape[1]]).standard_normal((self.impacts.shape[1], DIMS), np.float32)
        turned = self.impacts.astype(np.float32) @ draw
        self.shape = turned / np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-12)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A term's documents by block, where blocks start, and their summaries on its partners."""
        if term not in self.lists:
            docs = np.flatnonzero(self.impacts[:, term])
            pivots = docs[:: max(1, BLOCK)]
            nearest = np.argmax(self.shape[docs] @ self.shape[pivots].T, axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(nearest)) + 1])
            rows = self.impacts[np.ix_(docs, self.partners[term])]
            self.lists[term] = docs, starts, np.maximum.reduceat(rows, starts, axis=0).astype(np.int64)
        return self.lists[term]


class Best:
    """An item's best documents so far: (score, id missing, id)."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)
        self.ids = np.zeros(0, np.int64)

    def reach(self) -> int:
        """The score that a document needs to be of interest."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        score, missing, ids = (np.concatenate(x) for x in ((self.score, score), (self.missing, missing), (self.ids, ids)))
        order = np.lexsort((ids, missing, -score))[: self.k]
        self.score, self.missing, self.ids = score[order], missing[order], ids[order]


def search_chunk(
    chunk: Chunk, items: Items, weights: np.ndarray, best: list[Best], missing: np.ndarray, ids: np.ndarray
) -> tuple[int, int]:
    """Update each item's best documents by those of a chunk; blocks met and blocks opened."""
    met = opened = 0
    for terms, repeats, top in zip(items.terms, items.repeats, best, strict=True):
        weight = repeats * weights[terms]
        most = weight * chunk.most[terms]
        order = np.argsort(-most, kind="stable")
        terms, weight, most = terms[order], weight[order], most[order]
        left = np.cumsum(most[::-1])[::-1]
        for k, term in enumerate(terms.tolist()):
            if left[k] < top.reach() or not most[k]:
                break  # neither this list nor a later one holds a document that is good enough
            docs, starts, summary = chunk.blocks(term)
            places = np.searchsorted(chunk.partners[term], terms[k:])
            bound = summary[:, places] @ weight[k:]
            good = bound >= top.reach()
            met, opened = met + len(good), opened + int(good.sum())
            if not good.any():
                continue
            docs = docs[np.repeat(good, np.diff(np.append(starts, len(docs))))]
            values = chunk.impacts[np.ix_(docs, terms)]
            fresh = ~values[:, :k].any(axis=1)
            docs, score = docs[fresh], values[fresh][:, k:].astype(np.int64) @ weight[k:]
            good = score >= top.reach()
            top.add(score[good], missing[docs[good]], ids[docs[good]])
    return met, opened


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - sum(b.num_rows for b in held))
            held.append(part)
            batch = batch.slice(part.num_rows)
            if sum(b.num_rows for b in held) == rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def impacts_of(table: pa.Table, terms: int, documents: int, length: int) -> np.ndarray:
    """(documents x terms) impacts of a piece of the forward table, at most a million each."""
    n = table.column("n").to_numpy()
    listed = table.column("terms").combine_chunks()
    column, times = listed.flatten().to_numpy(), table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(table.num_rows), np.diff(listed.offsets.to_numpy()))
    # whole numbers of any size: the product of share, length and documents may pass 64 bits
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * documents // length for x in n.tolist()], np.int64)
    out = np.zeros((table.num_rows, terms), np.int32)
    out[row, column] = SCALE * times // (1000 * times + 8 * m[row])
    return out


def search(forward: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, doc_id, score): at most ``k`` rows an item from each task."""
    total = forward.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    documents, length, width = total["documents"], total["length"] or 0, len(items.vocabulary)
    weights = term_weights(documents, frequencies(forward, width))
    partners = items.partners()
    rows = max(64, min(CHUNK_ROWS, CHUNK_CELLS // max(1, width)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items.terms]
        for table in _chunks(batches, rows):
            chunk = Chunk(impacts_of(table, width, documents, length), partners)
            ids = table.column("doc_id")
            missing = ids.is_null().to_numpy()
            search_chunk(chunk, items, weights, best, missing, ids.fill_null(0).to_numpy())
        for item, top in enumerate(best):
            if len(top.score):
                ids = pa.array(top.ids, mask=top.missing)
                columns = [pa.array(np.full(len(ids), item)), ids, pa.array(top.score)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return forward.mapInArrow(find, "item long, doc_id long, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` documents that score highest for each item."""
    spark = docs.sparkSession
    shipped(spark)
    source = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    named = items.select(items[item_id].cast("long").alias("item_id"), items[text].alias("text"))
    out = None
    waiting = written(named, "items").toLocalIterator()  # a block of items at a time
    while block := [row for _, row in zip(range(ITEMS_AT_ONCE), waiting, strict=False)]:
        asked = Items.of([row["text"] for row in block])
        if not asked.vocabulary:
            continue
        found = search(forward_table(source, asked.vocabulary), asked, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(number, row["item_id"]) for number, row in enumerate(block)], "item long, item_id long"
        )
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        ranked = written(ranked, "ranked")
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], RANKED) if out is None else out


RANKED = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)
