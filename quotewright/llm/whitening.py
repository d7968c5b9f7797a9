"""Whitening by a blockwise QR, a bidiagonal qd iteration and twisted factorisations.

1. Vectors become whole numbers; their count and sums per dimension are exact.
2. Each task reduces its centred rows block by block to a triangle R (QR of the triangle
   so far on top of the next rows); triangles meet in small groups until one is left.
   ``R'R`` is the scatter of all rows, but it is never formed, so no digits are squared away.
3. On the driver, for one d x d triangle: Householder reflections make R bidiagonal, ``R = U B W'``;
   dqds finds the squares of B's singular values to high relative accuracy; for
   each the twisted factorisation of ``B'B - s`` with the smallest twist gives its vector in one
   solve; vectors of values that lie close together are made orthogonal to each other.
   ``W`` times these are the components, their squares over n the eigenvalues.
4. Every row is projected; a further pass measures the covariance of what came out.

* Rows whose vector is null or empty, or holds a null or non-finite entry, take no part, nor do
  those whose length isn't the most frequent one (ties: the longer), nor those with an entry
  of 2^46 or more, as 64 times that has no exact place in a double.
* Every remaining row is returned for every component, repeated ids and missing ids included.
* ``deviation`` is exact; where it has no place in a long, it is null.
* A component without variance (an eigenvalue below 1e-13 of the largest, or all rows equal) has a null ``whitened``; ``explained`` is then 0, and
  ``identity_error`` covers the other components (0 if there is none).  No rows: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import shipped, written

FACTOR, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows added to a triangle at once.
ROWS = 1024
#: Triangles that meet in one task.
MEET = 16
LARGEST = float(1 << 46)
#: Squares of singular values this much smaller than the largest stand for no variance.
NOTHING = 1e-13
#: Sweeps for one value; two or three are usual.
MOST_SWEEPS = 10_000
#: Relative gap below which vectors are made orthogonal explicitly.
CLOSE = 1e-3


# One triangle


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and W with ``R = U B W'``, B upper bidiagonal."""
    a = np.array(r, np.float64)
    d = a.shape[1]
    turn = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflection(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = reflection(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                turn[:, k + 1 :] -= 2 * np.outer(turn[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), turn


def dqds(diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal matrix's singular values, falling, by differential qd with shifts."""
    q, e = (diagonal**2).tolist(), (beside**2).tolist()
    out: list[float] = []
    total, sweeps = 0.0, 0
    while q:
        n = len(q)
        if n == 1:
            out.append(total + q[0])
            break
        small = 2.3e-16
        if e[-1] <= small**2 * max(total + q[-1], q[-2]):
            out.append(total + q.pop())
            e.pop()
            sweeps = 0
            continue
        split = next((k for k in range(n - 2, -1, -1) if e[k] <= small**2 * min(q[k], q[k + 1])), None)
        if split is not None:
            for part_q, part_e in ((q[: split + 1], e[:split]), (q[split + 1 :], e[split + 1 :])):
                out += [total + x for x in dqds(np.sqrt(part_q), np.sqrt(part_e)).tolist()]
            break
        # a shift below the least value: the smaller root of the last two rows, if the sweep can bear it
        a, b, c = q[-2], e[-1], q[-1]
        half = 0.5 * (a + b + c)
        root = half + math.sqrt(max(half * half - a * c, 0.0))
        shift = a * c / root if root > 0 else 0.0
        for attempt in range(4):
            s = 0.0 if attempt == 3 else shift * (1.0, 0.75, 0.25)[attempt]
            swept = _sweep(q, e, s)
            if swept is not None:
                q, e = swept
                total += s
                break
        sweeps += 1
        if sweeps > MOST_SWEEPS:
            raise ArithmeticError("the qd iteration does not converge")
    return np.sort(np.array(out))[::-1]


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One transformation to the qd array of the shifted matrix; none if the shift was too large."""
    at = q[0] - shift
    new_q, new_e = [], []
    for k in range(len(e)):
        if at < 0:
            return None
        top = at + e[k]
        new_q.append(top)
        if top == 0:
            new_e.append(0.0)
            at = q[k + 1] - shift
        else:
            ratio = q[k + 1] / top
            new_e.append(e[k] * ratio)
            at = at * ratio - shift
    if at < 0:
        return None
    new_q.append(at)
    return new_q, new_e


def twisted_vector(diagonal: np.ndarray, beside: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of ``B'B`` for one of its eigenvalues, by its twisted factorisation.

    ``B'B - value`` is factored from the top (stationary qd) and from the bottom (progressive
    qd); where the two meet with the smallest remainder the vector has its largest
    entry, and it follows from there by products alone.
    """
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    q, e = diagonal**2, beside**2
    tiny = max(np.finfo(float).tiny, 1e-30 * float(q.max() + e.max()))
    apart = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    # B'B = L D L' with D = q and L's entries beside/diagonal
    down, up = np.empty(n), np.empty(n)  # s: remainders from the top; p: from the bottom
    low, high = np.empty(n - 1), np.empty(n - 1)  # entries of the two factors
    down[0] = -value
    for k in range(n - 1):
        pivot = apart(down[k] + q[k])
        low[k] = diagonal[k] * beside[k] / pivot
        down[k + 1] = down[k] * (e[k] / pivot) - value
    up[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = apart(e[k] + up[k + 1])
        high[k] = diagonal[k] * beside[k] / pivot
        up[k] = up[k + 1] * (q[k] / pivot) - value
    meet = np.abs(down + up + value)
    r = int(np.argmin(np.where(np.isnan(meet), np.inf, meet)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -high[k] * z[k]
    return z / np.linalg.norm(z)


def _block_vectors(diagonal: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and vectors (columns) of ``B'B`` of a bidiagonal block that is not split."""
    values = dqds(diagonal, beside)
    vectors = np.stack([twisted_vector(diagonal, beside, x) for x in values.tolist()], axis=1)
    start = 0
    for k in range(1, len(values) + 1):
        if k < len(values) and values[k - 1] - values[k] <= CLOSE * values[k - 1]:
            continue
        if k - start > 1:
            vectors[:, start:k] = _separated(diagonal, beside, values[start:k], vectors[:, start:k])
        start = k
    return values, vectors


def _separated(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Orthogonal vectors of a group of close eigenvalues: an orthogonal basis of what the
    twisted vectors span, filled up at random where they coincide, turned within
    its span until the group's values part, and set apart from each other once more."""
    rng = np.random.default_rng(len(values))
    basis: list[np.ndarray] = []
    for value, z in zip(values.tolist(), vectors.T, strict=True):
        for _ in range(5):
            for _ in range(2):
                for b in basis:
                    z = z - b * (b @ z)
            size = np.linalg.norm(z)
            if size > 1e-4:
                break
            z = _inverse_step(diagonal, beside, value, rng.standard_normal(len(z)))
        basis.append(z / np.linalg.norm(z))
    span = np.stack(basis, axis=1)
    image = diagonal[:, None] * span
    image[:-1] += beside[:, None] * span[1:]
    # the images of the group's vectors are as orthogonal as the vectors: one-sided rotations part them
    for _ in range(30):
        turned = False
        for a in range(span.shape[1]):
            for b in range(a + 1, span.shape[1]):
                x, y, w = image[:, a] @ image[:, a], image[:, b] @ image[:, b], image[:, a] @ image[:, b]
                if abs(w) > 1e-16 * math.sqrt(x * y):
                    tau = (y - x) / (2 * w)
                    t = math.copysign(1, tau) / (abs(tau) + math.hypot(1, tau))
                    c = 1 / math.hypot(1, t)
                    for m in (span, image):
                        m[:, a], m[:, b] = c * (m[:, a] - t * m[:, b]), c * (t * m[:, a] + m[:, b])
                    turned = True
        if not turned:
            break
    order = np.argsort(-np.einsum("ij,ij->j", image, image), kind="stable")
    return span[:, order]


def _inverse_step(diagonal: np.ndarray, beside: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """A random vector drawn towards the eigenvectors near ``value``."""
    matrix = np.diag(diagonal**2) + np.diag(diagonal[:-1] * beside, 1) + np.diag(diagonal[:-1] * beside, -1)
    matrix[np.arange(1, len(z)), np.arange(1, len(z))] += beside**2
    scale = np.abs(matrix).max()
    z = np.linalg.solve(matrix - (value + 1e-13 * scale) * np.eye(len(z)), z)
    return z / np.linalg.norm(z)


def principal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of ``R'R``."""
    diagonal, beside, turn = bidiagonalised(r)
    largest = max(np.abs(diagonal).max(initial=0), np.abs(beside).max(initial=0))
    values, vectors = [], []
    start, d = 0, len(diagonal)
    for k in range(d):
        if k < d - 1 and abs(beside[k]) > 1e-17 * largest:
            continue
        part_values, part = _block_vectors(diagonal[start : k + 1], beside[start:k])
        whole = np.zeros((d, k + 1 - start))
        whole[start : k + 1] = part
        values.append(part_values)
        vectors.append(whole)
        start = k + 1
    value, vector = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-value, kind="stable")
    return value[order], turn @ vector[:, order]


# All rows


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part; x as array<long>."""
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("embedding")
    )
    fits = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    rows = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fits)
    sizes = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if sizes is not None:
        rows = rows.filter(F.size("embedding") == sizes["dims"])
    x = F.transform("embedding", lambda c: F.floor(c * FACTOR).cast("long") + SHIFT)
    return written(rows.select("vec_id", x.alias("x")), "whole_numbers")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def count_and_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension; one number a dimension comes from a task."""
    dims = rows.agg(F.first(F.size("x")).alias("dims"), F.count("*").alias("n")).first()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = 0, 0  # in two halves: a sum of many longs may outgrow one
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                high, low = high + (x >> 20).sum(axis=0), low + (x & 0xFFFFF).sum(axis=0)
        if not np.isscalar(high):
            columns = [pa.array(np.arange(len(high))), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    added = rows.select("x").mapInArrow(add, "dim long, high long, low long").groupBy("dim").agg(wide("high"), wide("low"))
    sums = [0] * (dims["dims"] or 0)
    for row in added.collect():  # one row a dimension
        sums[row["dim"]] = int(row["high"]) * (1 << 20) + int(row["low"])
    return dims["n"], sums


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly, the rest in doubles."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _reduced(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.concatenate([r, rows]), mode="r")


TRIANGLE = "place long, r binary"


def triangle(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The d x d triangle of all centred rows."""
    d = len(sums)

    def rows_to_triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                r = _reduced(r, _centred(_matrix(batch.slice(start, ROWS)), n, sums))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([r.tobytes()], pa.binary())], names=["place", "r"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        r = None
        for x in table.column("r").to_pylist():
            r = _reduced(r, np.frombuffer(x).reshape(-1, d))
        return pa.table({"place": pa.array([key[0].as_py()]), "r": pa.array([r.tobytes()], pa.binary())})

    left = written(rows.select("x").mapInArrow(rows_to_triangle, TRIANGLE), "triangles")
    while (count := left.count()) > 1:
        groups = -(-count // MEET)
        # triangles are few to a task's rows, and dealt evenly enough by their content
        dealt = left.withColumn("place", F.pmod(F.xxhash64("r"), F.lit(groups)).cast("long"))
        left = written(dealt.groupBy("place").applyInArrow(meet, TRIANGLE), "triangles")
    r = np.frombuffer(left.first()["r"]).reshape(-1, d)
    return np.concatenate([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2 by row, null beyond a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    far = (x - whole).astype(np.float64) * n - rest
    limit = np.sqrt((2.0**62) / max(1, len(sums)))
    safe = (np.abs(far) < limit).all(axis=1)
    near = np.where(safe[:, None], x - whole, 0) * np.int64(n) - rest
    out = np.einsum("ij,ij->i", near, near).tolist()
    for k in np.flatnonzero(~safe).tolist():
        exact = sum((n * a - s) ** 2 for a, s in zip(x[k].tolist(), sums, strict=True))
        out[k] = exact if exact < 1 << 63 else None
    return out


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: see the contract's columns in ``WHITENED``."""
    spark = vectors.sparkSession
    shipped(spark)
    rows = usable(vectors, vec_id, embedding)
    n, sums = count_and_sums(rows)
    if not n:
        return spark.createDataFrame([], WHITENED)
    r = triangle(rows, n, sums)
    value, vector = principal(r)
    count = min(components, len(value))
    total, value, vector = float((r**2).sum()), np.maximum(value[:count], 0), vector[:, :count]
    live = value > NOTHING * max(value[0], 0)
    scaled = np.where(live, vector / np.sqrt(np.where(live, value / n, 1)), 0)
    explained = np.where(live, value / total if total else 0.0, 0.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second, first = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                w = _centred(_matrix(batch), n, sums) @ scaled
                second, first = second + w.T @ w, first + w.sum(axis=0)
        i, j = np.meshgrid(np.arange(count + 1), np.arange(count), indexing="ij")
        found = np.concatenate([second, first[None]])
        columns = [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(found.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])

    measured = np.zeros((count + 1, count))
    added = rows.select("x").mapInArrow(products, "i long, j long, total double").groupBy("i", "j")
    for row in added.agg(F.sum("total").alias("total")).collect():  # one number a pair of components
        measured[row["i"], row["j"]] = row["total"] / n
    mean = measured[-1]
    off = np.abs(measured[:-1] - np.outer(mean, mean) - np.eye(count))[np.ix_(live, live)]
    error = float(off.max(initial=0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x, m = _matrix(part), part.num_rows
                w = _centred(x, n, sums) @ scaled
                again = pa.array(np.repeat(np.arange(m), count))
                columns = [
                    part.column("vec_id").take(again),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, n)),
                    pa.array(exact_deviations(x, n, sums), pa.int64()).take(again),
                    pa.array(w.ravel(), mask=np.tile(~live, m)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WHITENED.split(", ")])

    return rows.mapInArrow(project, WHITENED)
