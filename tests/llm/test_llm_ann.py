"""Search over codes: recall, exact scores, bounds, ties and unusable vectors."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quotewright.llm import ann, registry


def exact(vectors, k=20):
    """(query, rank, id, score) by all products."""
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids])
    out = []
    for q in ids:
        if q % 20 == 0:
            scores = matrix @ np.array(vectors[q])
            order = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(order)]
    return out


def compare(found, expected, recall):
    got = {(r.query_id, r.vec_id) for r in found}
    want = {(q, i) for q, _, i, _ in expected}
    assert len(found) == len(expected)
    assert len(got & want) >= recall * len(want)
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    for rows in by_query.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
        assert all(a[1] > b[1] or (a[1] == b[1] and a[2] < b[2]) for a, b in zip(rows, rows[1:], strict=False))


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_op2_recall_and_scores(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in rows}
    found = registry.op2_one_bit_neighbours(spark, folder).collect()
    compare(found, exact(vectors), 0.99)
    assert all(abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12 for r in found)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROW_BLOCK", 90)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    vectors = {k: rng.standard_normal(100) * rng.uniform(0.1, 5) for k in range(700)}
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], "vec_id long, embedding array<double>")
    compare(ann.nearest_neighbours(rows, F.col("vec_id") % 20 == 0).collect(), exact(vectors), 0.97)


def expected_rows(query_id, query, candidates, k=20):
    scores = [(sum(a * b for a, b in zip(v, query, strict=True)), i) for i, v in candidates]  # every product rounded
    ordered = sorted(((np.isnan(x), -x if not np.isnan(x) else 0, i) for x, i in scores))[:k]
    return [(query_id, r, i, float("nan") if none else -x) for r, (none, x, i) in enumerate(ordered, 1)]


def test_components_of_any_size(spark):
    """Every finite vector is found, however large or small its components are."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(300):
        vector = rng.standard_normal(8) * 10.0 ** rng.choice([-170, -60, 0, 0, 60, 120])
        rows.append((k, vector.tolist()))
    rows += [(1000 + k, (rng.standard_normal(8) * 1e200).tolist()) for k in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    right = total = 0
    for query_id, query in rows:
        if query_id % 20 == 0:
            want = expected_rows(query_id, query, [x for x in rows if x[0] != query_id])
            got = sorted(found[query_id])
            assert [r for r, _, _ in got] == list(range(1, 21))
            right, total = right + len({i for _, i, _ in got} & {i for _, _, i, _ in want}), total + 20
    assert right >= 0.97 * total
    small = spark.createDataFrame([(20, [1e60, 2.0]), (1, [1.0, 2.0]), (2, [1e-170, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in ann.nearest_neighbours(small, F.col("vec_id") == 20).collect()] == [(20, 1, 1), (20, 2, 2)]


def test_rows_that_repeat_an_id_are_rows(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    found = ann.nearest_neighbours(table, F.col("vec_id") == 20).collect()
    assert sorted(map(tuple, found)) == [(20, 1, 1, 4.0), (20, 2, 1, 3.0)]


def test_unusable_ties_and_few(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [9.0, 9.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (7, [1.0, 1.0]),
        (20, [-1.0, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]),
    ]
    table = spark.createDataFrame([(*r, 1.5, "x") for r in rows], "vec_id long, embedding array<float>, score double, code string")
    found = ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(row for asked, vector, n in (
        (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 1), (0, [9.0, 9.0], 2), (20, [-1.0, 0.5], 6),
    ) for row in expected_rows(asked, vector, [(i, v) for k, (i, v) in enumerate(rows[:7]) if k != n]))
    assert ann.nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest_neighbours(table.filter("vec_id = 3"), F.col("vec_id") % 20 == 0).count() == 0


def test_thousands_of_equal_vectors(spark):
    """The smallest ids win among copies, over blocks too."""
    rng = np.random.default_rng(5)
    common = rng.standard_normal(64)
    rows = [(k, (common if k % 3 else rng.standard_normal(64)).tolist()) for k in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest_neighbours(table, F.col("vec_id") == 40).collect()
    assert sorted(r.vec_id for r in found) == [k for k in range(100) if k % 3 and k != 40][:20]


def test_bounds_hold_for_nearly_all_pairs():
    rng = np.random.default_rng(7)
    vectors, queries = rng.standard_normal((2000, 96)), rng.standard_normal((50, 96))
    guess, error = ann.estimate(queries, *ann.encode(vectors))
    assert (np.abs(guess - queries @ vectors.T) <= error).mean() > 0.97


def test_rotation_is_orthogonal_and_padded():
    turn = ann.rotation(70)
    assert turn.shape == (128, 128)
    assert np.allclose(turn @ turn.T, np.eye(128))
