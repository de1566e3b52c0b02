"""Neighbours and positions, with keys kept whole and with keys cut into slices."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.ordered import OrderedRows, join_null_safe, latest_per_key

SCHEMA = "k string, t int, v string"


def skewed(seed=1, n=400):
    """A third of the rows, and more, belong to one key; nulls in key and value."""
    rng = random.Random(seed)
    keys = ["hot"] * 4 + ["a", "b", "c", None]
    times = rng.sample(range(10 * n), n)
    return [(rng.choice(keys), t, rng.choice(["x", "y", None])) for t in times]


def expected(data):
    out = []
    for key in {k for k, _, _ in data}:
        own = sorted((t, v) for t, v in ((t, v or "") for k, t, v in data if k == key))
        for i, (t, v) in enumerate(own):
            before = own[i - 1][0] if i else None
            after = own[i + 1][0] if i + 1 < len(own) else None
            out.append((key, t, before, after, i + 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_rows", [None, 30, 1])
def test_neighbours_and_positions(spark, max_rows):
    data = skewed()
    ordered = OrderedRows.of(spark.createDataFrame(data, SCHEMA), ["k"], ["t"], max_rows=max_rows)
    assert ordered.cut == (max_rows is not None)
    got = (
        ordered.previous(["t"], "before").next(["t"], "after").positions("n").rows()
        .select("k", "t", F.col("before.t").alias("before"), F.col("after.t").alias("after"), "n")
    )
    assert rows(got) == expected(data)


def test_no_key_is_ranked_over_slices(spark):
    df = spark.range(500).select((F.col("id") * 7 % 1000).cast("int").alias("t"))
    ranked = OrderedRows.of(df, (), ["t"], max_rows=40).positions("n")
    assert ranked.cut
    by_rank = [r["t"] for r in ranked.rows().orderBy("n").collect()]
    assert by_rank == sorted(by_rank) and len(by_rank) == 500


@pytest.mark.parametrize("max_rows", [None, 10])
def test_unique_on_keeps_the_last_of_each_stamp(spark, max_rows):
    data = [("hot", t // 4, str(t)) for t in range(100)] + [("a", 1, "1"), ("a", 1, "2")]
    got = OrderedRows.of(
        spark.createDataFrame(data, SCHEMA), ["k"], ["t", "v"], unique_on=["t"], max_rows=max_rows
    ).rows()
    want = {}
    for k, t, v in data:
        want[k, t] = max(want.get((k, t), ""), v)
    assert rows(got) == sorted(((k, t, v) for (k, t), v in want.items()), key=repr)


def test_slices_split_a_hot_key(spark):
    df = spark.createDataFrame([("hot", i, "x") for i in range(300)], SCHEMA)
    cut = OrderedRows.of(df, ["k"], ["t"], max_rows=50)
    sizes = [r["count"] for r in cut.df.groupBy("_slice").count().collect()]
    assert len(sizes) >= 5 and max(sizes) <= 100


def test_null_keys_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10)], "k string, y int")
    assert rows(join_null_safe(left, right, ["k"], "left")) == [("a", 2, None), (None, 1, 10)]
    assert rows(join_null_safe(left, right, ["k"], "left_semi")) == [(None, 1)]
    assert rows(join_null_safe(left, right, ["k"], "left_anti")) == [("a", 2)]


def test_latest_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(), SCHEMA)
    latest = latest_per_key(df, ["k"], ["t"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange hashpartitioning") :]
    want = {k: max(t for key, t, _ in skewed() if key == k) for k in {k for k, _, _ in skewed()}}
    assert {r["k"]: r["t"] for r in latest.collect()} == want
