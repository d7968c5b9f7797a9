"""Packing: exact pieces, valid sequences, and no more of them than plain best fit."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotewright.llm import packing, registry

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected_pieces(library, text, capacity=2048):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    head = len(ids) % capacity or capacity
    edges = [0, *range(head, len(ids) + 1, capacity)]
    return [
        (k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]


def valid(rows, capacity=2048):
    """Sequences are gapless and never too long; returns how many there are."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit(sizes, capacity=2048):
    own = packing.Packing(sizes, capacity)
    own.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]))
    return len(own.bins)


def test_op5_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = registry.op5_genetic_packing(spark, SMALL).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {d.doc_id: expected_pieces(library, d.text) for d in docs}
    sizes = [r.length for r in rows]
    assert -(-sum(sizes) // 2048) <= valid(rows) <= best_fit(sizes)


def test_odd_rows(spark):
    long = "word " * 9000
    rows = [(1, ""), (2, None), (None, "a"), (4, long), (4, long), (5, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, 7, "s") for r in rows], "doc_id long, text string, offset int, piece_key string")
    pieces = packing.cut_documents(docs, PATH)
    out = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids"))).collect()
    library = Tokenizer.from_file(PATH)
    expected = [(k, *p) for k, t in rows for p in expected_pieces(library, t)]
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(found, key=lambda x: (x[0] or 0, x[1:])) == sorted(expected, key=lambda x: (x[0] or 0, x[1:]))
    assert all(r.piece_key == "s" for r in out)
    valid(out)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.cut_documents(docs, PATH)).count() == 0


def test_blocks_pool_what_they_fill_badly(spark, monkeypatch):
    """Many blocks give hardly more sequences than one."""
    monkeypatch.setattr(packing, "BLOCK", 64)
    rng = random.Random(3)
    sizes = [rng.randrange(1, 1500) for _ in range(600)]
    pieces = spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "doc_id long, length long")
    out = packing.pack(pieces).collect()
    assert sorted(r.doc_id for r in out) == list(range(600))
    assert valid(out) <= -(-sum(sizes) // 2048) + 3


def test_repeated_packing_is_the_same(spark):
    pieces = spark.createDataFrame([(k, 100 + 37 * k % 900) for k in range(200)], "doc_id long, length long").coalesce(1)
    first, second = ({(r.doc_id, r.sequence_id, r.offset) for r in packing.pack(pieces).collect()} for _ in range(2))
    assert first == second


def test_crossover_keeps_every_item_once_and_injects_whole_bins():
    rng = random.Random(4)
    sizes = [rng.randrange(200, 900) for _ in range(300)]
    parents = []
    for _ in range(2):
        own = packing.Packing(sizes, 2048)
        own.best_fit(rng.sample(range(300), 300))
        parents.append(own)
    child = packing.crossover(*parents, rng)
    assert sorted(i for items in child.bins.values() for i in items) == list(range(300))
    assert all(sum(sizes[i] for i in items) + child.space[k] == 2048 for k, items in child.bins.items())
    given = {frozenset(x) for x in parents[0].bins.values()}
    assert sum(frozenset(x) in given for x in child.bins.values()) >= len(given) // 4


def test_evolution_beats_best_fit_on_a_hard_block():
    rng = random.Random(6)
    sizes = [rng.randrange(400, 900) for _ in range(400)]
    first = packing.evolve(sizes, [], "a")
    second = packing.evolve(sizes, first, "b")
    assert max(second[0]) + 1 <= max(first[0]) + 1 < best_fit(sizes)
