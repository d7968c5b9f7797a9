"""The qd solver against numpy's, and whitened rows against their definition."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SMALL

from quotewright.llm import registry, whitening


def triangles():
    rng = np.random.default_rng(4)
    tall = rng.standard_normal((300, 24))
    repeated = np.concatenate([tall[:, :12], tall[:, :12]], axis=1)
    graded = np.linalg.qr(rng.standard_normal((24, 24)))[0] * np.logspace(0, -6, 24)
    equal = np.linalg.qr(rng.standard_normal((24, 24)))[0] @ np.diag([3.0] * 8 + [2.0] * 8 + [1.0] * 8)
    close = np.linalg.qr(rng.standard_normal((24, 24)))[0] * (1 + 1e-9 * np.arange(24))
    return {
        "gauss": np.linalg.qr(tall, mode="r"),
        "repeated": np.linalg.qr(repeated, mode="r"),
        "graded": np.linalg.qr(graded, mode="r"),
        "equal": np.linalg.qr(equal, mode="r"),
        "close": np.linalg.qr(close, mode="r"),
        "diagonal": np.diag(np.arange(1.0, 25)),
        "identity": np.eye(24),
        "zero": np.zeros((24, 24)),
        "one": np.array([[3.0]]),
        "two": np.array([[1.0, 2.0], [0.0, 1e-5]]),
    }


@pytest.mark.parametrize("name", triangles())
def test_solver(name):
    r = triangles()[name]
    value, vector = whitening.principal(r)
    exact = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(value - exact).max() <= 1e-12 * max(exact[0], 1e-300)
    live = exact > 1e-10 * exact[0] if exact[0] else np.zeros(len(exact), bool)
    v = vector[:, live]
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max(initial=0) < 1e-9
    assert np.abs(r.T @ (r @ v) - v * value[live]).max(initial=0) <= 1e-11 * max(exact[0], 1e-300)


def test_bidiagonal_form():
    r = triangles()["gauss"]
    diagonal, beside, turn = whitening.bidiagonalised(r)
    b = np.diag(diagonal) + np.diag(beside, 1)
    assert np.allclose(turn @ turn.T, np.eye(24)) and np.allclose(turn @ b.T @ b @ turn.T, r.T @ r)


def test_small_values_are_accurate():
    """dqds keeps relative accuracy where squares differ by 1e24."""
    diagonal, beside = np.logspace(0, -12, 13), np.logspace(-1, -13, 12)
    b = np.diag(diagonal) + np.diag(beside, 1)
    exact = np.sort(1 / np.linalg.svd(np.linalg.inv(b), compute_uv=False)[::-1] ** 2)[::-1]
    assert np.allclose(np.log(whitening.dqds(diagonal, beside)).sum(), 2 * np.log(diagonal).sum(), atol=1e-12)
    assert np.allclose(whitening.dqds(diagonal, beside)[-1] / exact[-1], 1, atol=1e-9)


def by_definition(vectors):
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[a - s / n for a, s in zip(row, sums, strict=True)] for row in x])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, value[::-1], vector[:, ::-1]


def test_op12_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    deviation, centred, value, vector = by_definition([v for _, v in rows])
    result = registry.op12_bidiagonal_whitening(spark, SMALL)
    assert [f.dataType.typeName() for f in result.schema] == ["long", "integer", "long", "long", "double", "double", "double"]
    found = {(r.vec_id, r.component): r for r in result.collect()}
    assert len(found) == 32 * len(rows)
    for c in range(1, 33):
        own = np.array([found[i, c].whitened for i, _ in rows])
        want = centred @ vector[:, c - 1] / math.sqrt(value[c - 1])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8
        assert abs(found[rows[0][0], c].explained / (value[c - 1] / value.sum()) - 1) < 1e-9
    assert [found[i, 1].deviation for i, _ in rows] == deviation
    assert {r.n for r in found.values()} == {len(rows)}
    errors = {r.identity_error for r in found.values()}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    good = [(k, [float(x) for x in rng.standard_normal(5)]) for k in range(40)]
    bad = [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0, 3.0, 4.0]), (94, [nan] * 5), (95, [1.0, inf, 0.0, 0.0, 0.0]), (96, [1e60] * 5)]
    good += [(None, good[0][1]), (3, good[5][1]), (3, good[5][1]), (41, [-0.5, 1e7, 0.0, -2.5, 3.0])]
    rows = spark.createDataFrame([(*r, 1, "x") for r in good + bad], "vec_id long, embedding array<double>, n int, x string")
    result = whitening.whiten(rows.repartition(20)).collect()
    deviation, centred, value, vector = by_definition([v for _, v in good])
    assert len(result) == 5 * len(good) and {r.n for r in result} == {len(good)}
    limit = 1 << 63
    wanted = sorted(((i, d if d < limit else None) for (i, _), d in zip(good, deviation, strict=True)), key=str)
    assert sorted(((r.vec_id, r.deviation) for r in result if r.component == 1), key=str) == wanted
    assert max(r.identity_error for r in result) < 1e-6
    assert whitening.whiten(rows.limit(0)).count() == 0
    alone = whitening.whiten(rows.filter("vec_id = 1")).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(c, 0, None, 0, 0) for c in range(1, 6)]
