"""Overlap joins against all pairs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quotewright.operators.ranges import overlap_join


def drawn(rng, n, spread, keys):
    rows = []
    for k in range(n):
        start = dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(spread))
        end = start + dt.timedelta(days=rng.choice((0, 1, 20, 90, 700)))
        if rng.random() < 0.05:
            start, end = end, start - dt.timedelta(days=3)
        rows.append((rng.choice(keys), k, None if rng.random() < 0.1 else start, None if rng.random() < 0.1 else end))
    return rows


@pytest.mark.parametrize(("days", "keys"), [(30, ["hot"] * 9 + ["a", "b", None]), (1, ["a", "b"]), (5000, ["a", "b", "c"])])
def test_overlap_join(spark, days, keys):
    rng = random.Random(days)
    left, right = drawn(rng, 120, 1500, keys), drawn(rng, 150, 1500, keys)
    first, last = dt.date.min, dt.date.max
    wanted = {
        (i, j, max(a or first, c or first), min(b or last, d or last))
        for k, i, a, b in left
        for m, j, c, d in right
        if k is not None and k == m and (a or first) <= (b or last) and (c or first) <= (d or last)
        and (a or first) <= (d or last) and (c or first) <= (b or last)
    }
    schema = "stock_id string, n long, {} date, {} date"
    one = spark.createDataFrame(left, schema.format("start_date", "end_date"))
    other = spark.createDataFrame(right, schema.format("first_date", "last_date"))
    found = overlap_join(one, other, ["stock_id"], days=days).select("_left.n", F.col("_right.n").alias("m"), "overlap_start", "overlap_end").collect()
    assert len(found) == len(wanted)
    assert {(r.n, r.m) for r in found} == {x[:2] for x in wanted}
    bounded = {x for x in wanted if x[2] > first and x[3] < last}
    assert bounded <= {tuple(r) for r in found}
    assert overlap_join(one.limit(0), other, ["stock_id"]).count() == 0


def test_no_pair_of_distant_ranges_meets(spark):
    """A hot key's ranges of different years are joined in different buckets: the join's rows are few."""
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=40 * k) for k in range(200)]
    rows = spark.createDataFrame([("hot", d, d) for d in days], "stock_id string, start_date date, end_date date")
    others = rows.withColumnsRenamed({"start_date": "first_date", "end_date": "last_date"})
    joined = overlap_join(rows, others, ["stock_id"], days=40)
    assert joined.count() == 200
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan.split("Join Inner")[1].split("\n")[0]
