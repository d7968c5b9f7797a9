"""Fingerprints by their definition, links against all pairs, one row kept of each group."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SMALL
from test_llm_odd_sketch import expected as similar_groups

from quotewright.llm import registry, simhash
from quotewright.llm.components import components, local_forest


def by_definition(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_definition(prints):
    """The group of every distinct fingerprint, by all pairs."""
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    return {p: root(p) for p in distinct}


def expected_components(rows):
    prints = {k: by_definition(t) for k, (_, t) in enumerate(rows)}
    root = groups_by_definition(prints.values())
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids.setdefault(root[prints[k]], []).append(doc_id)
    return sorted(
        ((d, f"{prints[k]:016x}", min(ids.get(root[prints[k]], [None]))) for k, (d, _) in enumerate(rows)), key=str
    )


TEXTS = ["", " \n\t", "one", "One two", "one two three", "one two three four", "a b c d a b c d a b c d", "É Ü ß\x1f\x85x y z w", "x" * 50_000]


@pytest.mark.parametrize("text", [*TEXTS, None])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == by_definition(text)


def test_op4_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = [tuple(r) for r in registry.op4_simhash(spark, SMALL).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(found, key=str) == expected_components(docs)


def test_odd_rows(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "one"), (None, "only null ids here now"), (3, "One two"), (50, None)]
    docs = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, fingerprint string, component int")
    found = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == expected_components(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def flipped(rng, value, most):
    for bit in rng.sample(range(64), rng.randrange(most + 1)):
        value ^= 1 << bit
    return value


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("wide", [False, True])
def test_links_join_what_all_pairs_join(spark, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(simhash, "WIDE_INDEX", 0)
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        centre = rng.getrandbits(64)
        prints |= {flipped(rng, centre, 5) for _ in range(rng.randrange(1, 12))}
        prints.add(flipped(rng, flipped(rng, centre, 4), 4))
    rows = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    found = {r.node: r.component for r in components(simhash.links(rows)).collect()}
    expected = groups_by_definition(prints)
    mine = {}
    for p in prints:
        mine.setdefault(found.get(signed(p), signed(p)), set()).add(p)
    theirs = {}
    for p, root in expected.items():
        theirs.setdefault(root, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_a_large_list_is_deferred_and_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIST_ROWS", 8)
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    near = sorted({signed(flipped(rng, centre, 3)) for _ in range(40)})
    keys = np.array([5] * len(near) + [6, 6], np.int64)
    prints = np.array([*near, near[0], near[1]], np.int64)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[k : k + 5]), pa.array(prints[k : k + 5])], names=["key", "print"])
        for k in range(0, len(keys), 5)
    ]
    found = pa.Table.from_batches(list(simhash._sorted_lists(iter(batches)))).to_pylist()
    assert [r["large_list"] for r in found if r["large_list"] is not None] == [5]
    postings = spark.createDataFrame(list(zip(keys.tolist(), prints.tolist(), strict=True)), "key long, print long")
    links = simhash._large_lists(postings, spark.createDataFrame([(5,)], "key long"))
    node = {r.node: r.component for r in components(links).collect()}
    root = groups_by_definition([p % (1 << 64) for p in near])
    assert len({node.get(p, p) for p in near}) == len(set(root.values()))


def test_components_of_long_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(1000, k) for k in range(1001, 1200)]
    pairs = [*path, *star, (70, 71), (71, 70), (5, 5), (-9, -8)]
    random.Random(1).shuffle(pairs)
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(61))
    assert all(found[k] == 1000 for k in range(1000, 1200))
    assert (found[70], found[71], found[-8]) == (70, 70, -9)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_forest_spans_with_fewest_links():
    assert local_forest([1, 2, 1, 4], [2, 3, 3, 5]) == [(1, 2), (2, 3), (4, 5)]


def test_keep_one_row_of_each_group(spark):
    same = "alpha beta gamma delta epsilon"
    rows = [(9, same), (4, same.upper()), (4, same), (4, same), (None, same), (7, "quite another text than that"), (None, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept_id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 4), (False, 7), (True, 0)]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_similar_texts_by_five_words(spark):
    """Texts on both sides of the threshold: none goes that is linked to no other, and few stay that are."""
    rng = random.Random(6)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(80, 400))]
        for share in (0, 0.01, 0.015, 0.02, 0.03, 0.05):
            rows.append(" ".join(f"n{rng.randrange(10**9)}" if rng.random() < share else w for w in base))
        cut = len(base) // 12  # a whole passage replaced
        rows.append(" ".join([f"n{rng.randrange(10**9)}" for _ in range(cut)] + base[cut:]))
    rows = list(enumerate(rows))
    want = {c for _, _, c, _ in similar_groups(rows, 5, 80)}
    assert 12 < len(want) < 60
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want <= kept and len(kept - want) <= 0.05 * (len(rows) - len(want))


def test_keys_of_wide_fingerprints():
    """Equal bytes at a list's positions give an equal key, and the list is part of the key."""
    rng = np.random.default_rng(1)
    code = rng.integers(0, 256, 64, dtype=np.uint8)
    other = np.where(rng.random(64) < 0.5, code, rng.integers(0, 256, 64, dtype=np.uint8))
    positions = simhash.wide_positions()
    assert len({tuple(sorted(x)) for x in positions.tolist()}) == simhash.WIDE_LISTS
    assert all(len(set(x)) == simhash.WIDE_KEY for x in positions.tolist())
    same = (code[positions] == other[positions]).all(axis=1)
    assert same.any() and not same.all()
