"""Ranked search against scores of every document by their definition."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL

from quotewright.llm import lexical, registry

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def expected(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    held = Counter(t for _, c, _ in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for t, df in held.items()}
    out = []
    for item_id, text in items:
        asked = [t for t in terms(text) if t in weight]
        scores = []
        for d, c, n in counted:
            m = 25 + 75 * n * total // length
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item_id, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_op11_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    result = registry.op11_geometric_blocks(spark, SMALL)
    assert [f.dataType.typeName() for f in result.schema] == ["long", "integer", "long", "long"]
    assert found(result) == expected(docs, items)


TEXTS = ["", None, "...", "one", "One, two", "two-two TWO", "é É x\x7fy", "Zahl 12 und 12", "one two three", "x " * 50_000, "one"]


def test_odd_rows(spark):
    docs = list(enumerate(TEXTS)) + [(None, "one"), (3, "three three"), (3, "three three")]
    items = [(1, "one two"), (2, None), (3, "!"), (None, "12 x"), (1, "three one one"), (5, "unheard of"), (6, "É")]
    left = spark.createDataFrame([(*r, "a", 1) for r in docs], "doc_id long, text string, item_id string, rank int")
    right = spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, doc_id int")
    for k in (10, 2):
        assert found(lexical.rank_documents(left, right, k)) == expected(docs, items, k)
    assert lexical.rank_documents(left.limit(0), right).count() == 0
    assert lexical.rank_documents(left, right.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", 3)
    docs = list(enumerate(TEXTS))
    items = [(k, t) for k, t in enumerate(["one", "two", "12 x", "three", "!", "x one", "und"])]
    result = lexical.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(result) == expected(docs, items)


@pytest.mark.parametrize("rows", [7, 50, 400])
def test_skipped_blocks_lose_nothing(rows):
    """Chunks one after another, as in a task, against scores of all rows; most blocks stay shut."""
    rng = random.Random(rows)
    words = [f"w{k}" for k in range(120)]
    common = [1 / (k + 1) for k in range(120)]
    topics = [rng.choices(words, k=8) for _ in range(12)]
    docs = [(d, " ".join(rng.choices(words, common, k=rng.randrange(1, 60)) + rng.choice(topics) * rng.randrange(3))) for d in range(400)]
    items = [(k, " ".join(rng.choices(words, common, k=3) + rng.choice(topics))) for k in range(30)]
    asked = lexical.Items.of([t for _, t in items])
    size = np.array([len(terms(t)) for _, t in docs])
    held = [Counter(asked.vocabulary[t.encode()] for t in terms(text) if t.encode() in asked.vocabulary) for _, text in docs]
    weights = lexical.term_weights(400, np.bincount([t for c in held for t in c], minlength=len(asked.vocabulary)))
    m = 25 + 75 * size * 400 // size.sum()
    best = [lexical.Best(10) for _ in items]
    met = opened = 0
    for start in range(0, 400, rows):
        part = range(start, min(400, start + rows))
        impacts = np.zeros((len(part), len(asked.vocabulary)), np.int32)
        for k, d in enumerate(part):
            for t, tf in held[d].items():
                impacts[k, t] = 1_000_000_000 * tf // (1000 * tf + 8 * m[d])
        chunk = lexical.Chunk(impacts, asked.partners())
        seen = lexical.search_chunk(chunk, asked, weights, best, np.zeros(len(part), bool), np.array(part))
        met, opened = met + seen[0], opened + seen[1]
    got = [(k, r, int(d), int(s)) for k, top in enumerate(best) for r, (d, s) in enumerate(zip(top.ids, top.score, strict=True), 1)]
    assert sorted(got, key=str) == expected(docs, items)
    assert opened < met
