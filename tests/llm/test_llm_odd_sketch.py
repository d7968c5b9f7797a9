"""Near-duplicates by odd sketches against all pairs of full sets."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL

from quotewright.llm import odd_sketch, registry, verified
from quotewright.llm.components import components


def set_by_definition(text, size=2):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) or frozenset([tuple(words)])


def expected(rows, size=2, percent=80):
    """(doc_id, n_shingles, component_id, kept) by all pairs of distinct sets that share a shingle."""
    sets = [set_by_definition(text, size) for _, text in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    parent = {s: s for s in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holding = defaultdict(list)
    for k, s in enumerate(distinct):
        shared = Counter(o for g in s for o in holding[g])
        for o, n in shared.items():
            if 100 * n >= percent * (len(s) + len(distinct[o]) - n):
                parent[root(s)] = root(distinct[o])
        for g in s:
            holding[g].append(k)
    ids = defaultdict(list)
    for (doc_id, _), s in zip(rows, sets, strict=True):
        if s and doc_id is not None:
            ids[root(s)].append(doc_id)
    out = []
    for (doc_id, _), s in zip(rows, sets, strict=True):
        component = min(ids[root(s)], default=None) if s else doc_id
        out.append((doc_id, len(s), component, doc_id is not None and doc_id == component))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_op13_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found(registry.op13_odd_sketches(spark, SMALL)) == expected(docs)


def test_odd_rows(spark):
    texts = ["", None, " \n\t", "one", "One", "one two", "ONE\ttwo", "É ü", "é ü", "a b c a b c a b c", "x" * 60_000, "w " * 60_000]
    rows = list(enumerate(texts)) + [(None, "one"), (None, "only without an id"), (None, ""), (3, "one two three"), (5, "one two")]
    docs = spark.createDataFrame([(*r, "x", b"y", 1) for r in rows], "doc_id long, text string, node string, code binary, size int")
    assert found(odd_sketch.near_duplicates(docs)) == expected(rows)
    assert odd_sketch.near_duplicates(docs.limit(0)).count() == 0


def edited(rng, words, share):
    return [f"n{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("list_rows", [verified.LIST_ROWS, 10])
def test_groups_around_the_threshold(spark, list_rows):
    """Groups whose pairs lie on both sides of the threshold, in lists that are cut into blocks."""
    rng = random.Random(5)
    rows = []
    for _ in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 200))]
        rows += [" ".join(edited(rng, base, rng.choice((0.03, 0.05, 0.08)))) for _ in range(60)]
    rows = list(enumerate(rows))
    want = expected(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len({c for _, _, c, _ in want}) > 8
    assert found(odd_sketch.near_duplicates(docs, list_rows=list_rows)) == want


def some_members():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, (1, 8), dtype=np.uint64)
    flips = rng.random((40, 512)) < 0.08
    words = base ^ np.packbits(flips, axis=1, bitorder="little").view(np.uint64)
    return verified.Members(words, rng.integers(80, 100, 40), np.arange(40))


def candidates(m, rule):
    """By definition: (distance, a, b) of all pairs that can be linked."""
    return {
        (int(np.bitwise_count(m.words[a] ^ m.words[b]).sum()), a, b)
        for a in range(40)
        for b in range(a + 1, 40)
        if np.bitwise_count(m.words[a] ^ m.words[b]).sum() <= rule.most_bits
        and 100 * min(m.sizes[a], m.sizes[b]) >= rule.percent * max(m.sizes[a], m.sizes[b])
    }


@pytest.mark.parametrize("table_rows", [256, 4])
def test_forest_spans_the_candidates(monkeypatch, table_rows):
    monkeypatch.setattr(verified, "TABLE_ROWS", table_rows)
    rule = verified.Rule(2, 90, 76)
    m = some_members()
    wanted = sorted(candidates(m, rule))
    assert 50 < len(wanted) < 780
    parent = list(range(40))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lengths = []  # Kruskal's rule gives forests of the same lengths as Prim's
    for far, a, b in wanted:
        if root(a) != root(b):
            parent[root(a)] = root(b)
            lengths.append(far)
    edges = {(a, b) for a, b in verified.forest(m, rule).tolist()}
    by_pair = {(a, b): far for far, a, b in wanted}
    assert sorted(by_pair[e] for e in edges) == lengths


@pytest.mark.parametrize("at_once", [8192, 16])
def test_links_between_groups(monkeypatch, at_once):
    """Links that a cell finds connect what all pairs of who asks and is asked connect."""
    monkeypatch.setattr(verified, "HASHES_AT_ONCE", at_once)
    monkeypatch.setattr(verified, "ASKING", 7)
    rng = np.random.default_rng(at_once)
    pools = rng.integers(0, 1 << 64, (4, 70), dtype=np.uint64)
    sets = [np.unique(rng.choice(pools[k % 4], rng.integers(52, 66), replace=False)) for k in range(60)]
    size = np.array([len(x) for x in sets])
    groups, asks, asked = np.arange(60) // 3, rng.random(60) < 0.6, rng.random(60) < 0.8
    rule = verified.Rule(2, 70, 512)
    counts = verified.shared_counts(sets, sets)
    assert counts.tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in sets] for x in sets]
    members = verified.Members(np.zeros((60, 8), np.uint64), size, groups)
    found = verified.cross_links(members, sets, asks, asked, rule)
    wanted = [
        (a, b)
        for a in range(60)
        for b in range(60)
        if asks[a] and asked[b] and groups[a] != groups[b] and 100 * counts[a, b] >= 70 * (size[a] + size[b] - counts[a, b])
    ]
    assert set(found) <= set(wanted) and 0 < len(found) < 20

    def joined(links):
        label = groups.copy()
        for a, b in links:
            label[label == label[b]] = label[a]
        return [frozenset(np.flatnonzero(label == x)) for x in label]

    assert joined(found) == joined(wanted)


@pytest.mark.parametrize(("size", "similar"), [(50, 0.8), (400, 0.8), (400, 0.9), (400, 0.3)])
def test_sketches_estimate_similarity(size, similar):
    rng = np.random.default_rng(size)
    both = round(2 * size * similar / (1 + similar))
    counts = []
    for _ in range(30):
        pool = rng.integers(0, 1 << 64, 2 * size - both, dtype=np.uint64)
        a, b = (odd_sketch.odd_sketch(odd_sketch.samples(x)) for x in (pool[:size], pool[size - both :]))
        counts.append(int(np.bitwise_count(np.frombuffer(a, "<u8") ^ np.frombuffer(b, "<u8")).sum()))
    if similar >= 0.8:
        assert abs(odd_sketch.similarity(np.mean(counts)) - both / (2 * size - both)) < 0.03
        assert max(counts) <= odd_sketch.most_bits()
    else:
        assert min(counts) > odd_sketch.most_bits()


def test_spanning_pairs_connect_the_same(spark):
    rng = random.Random(3)
    pairs = [(f"{rng.randrange(40)}".encode(), f"{rng.randrange(40)}".encode()) for _ in range(60)]
    pairs += [(b"x%d" % rng.randrange(9), b"x%d" % rng.randrange(9)) for _ in range(300)]
    rows = spark.createDataFrame(pairs, "a binary, b binary").repartition(2)
    thin = verified.spanning(rows)
    assert thin.count() <= 2 * (40 + 9)
    whole, fewer = (sorted((bytes(r.node), bytes(r.component)) for r in components(x).collect()) for x in (rows, thin))
    assert whole == fewer
    assert verified.spanning(rows.limit(0)).count() == 0
