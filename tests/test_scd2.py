"""Versioned tables: edge cases by hand, and invariants on random changes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.config import Scd2Table
from tidemark.operators import scd2, scd2_checks

TABLE = Scd2Table(
    "product", keys=("id", "code"), last_modified="modified", is_latest="is_latest",
    effective_date="starts", end_date="ends", tracked=("name",), tie_break=("seq",),
)
BATCH = "id int, code string, name string, modified int, seq int"
TARGET = BATCH + ", is_latest boolean, starts int, ends int"


def batch(spark, *data):
    return spark.createDataFrame(list(data), BATCH)


def target(spark, *data):
    return spark.createDataFrame(list(data), TARGET)


@pytest.fixture
def products(spark):
    return target(
        spark,
        (1, "A", "one", 10, 1, True, 10, None),
        (2, "B", "two", 10, 2, False, 10, 20),
        (2, "B", "two!", 20, 3, True, 20, None),
        (3, "C", None, 10, 4, True, 10, None),
    )


def test_new_updated_unchanged(spark, products):
    changes = batch(
        spark, (1, "A", "one", 30, 5), (2, "B", "deux", 30, 6), (4, "D", "four", 30, 7)
    )
    kinds = {(r["id"], r["change"]) for r in scd2.classify(changes, products, TABLE).collect()}
    assert kinds == {(1, "unchanged"), (2, "updated"), (4, "new")}
    after = scd2.apply_batch(changes, products, TABLE)
    assert rows(after, "id", "name", "is_latest", "starts", "ends") == sorted(
        [
            (1, "one", True, 10, None),
            (2, "two", False, 10, 20),
            (2, "two!", False, 20, 30),
            (2, "deux", True, 30, None),
            (3, None, True, 10, None),
            (4, "four", True, 30, None),
        ],
        key=repr,
    )


def test_null_counts_as_a_value(spark, products):
    to_null = batch(spark, (1, "A", None, 30, 5), (3, "C", None, 30, 6))
    assert {(r["id"], r["change"]) for r in scd2.classify(to_null, products, TABLE).collect()} == {
        (1, "updated"), (3, "unchanged"),
    }


def test_ties_are_broken_by_the_later_sequence(spark, products):
    tied = batch(spark, (1, "A", "x", 30, 5), (1, "A", "y", 30, 6))
    assert rows(scd2.batch_latest(tied, TABLE), "name") == [("y",)]
    loose = Scd2Table("p", ("id",), "modified", tracked=("name",))
    picked = {rows(scd2.batch_latest(tied.repartition(n), loose), "name")[0] for n in (1, 2, 3)}
    assert len(picked) == 1, "without a tie-break the content decides, not the row order"


def test_empty_batch_and_empty_target(spark, products):
    nothing = batch(spark)
    assert rows(scd2.apply_batch(nothing, products, TABLE)) == rows(products)
    changes = batch(spark, (1, "A", "one", 30, 5))
    after = scd2.apply_batch(changes, target(spark), TABLE)
    assert rows(after) == [(1, "A", "one", 30, 5, True, 30, None)]


def test_apply_is_idempotent(spark, products):
    changes = batch(spark, (2, "B", "deux", 30, 6), (4, "D", "four", 30, 7))
    once = scd2.apply_batch(changes, products, TABLE)
    assert rows(scd2.apply_batch(changes, once, TABLE)) == rows(once)


def test_given_end_is_used(spark, products):
    changes = batch(spark, (2, "B", "deux", 30, 6))
    gone = scd2.expired(changes, products, TABLE, end_ts=F.lit(99))
    assert rows(gone, "name", "is_latest", "ends") == [("two!", False, 99)]


def test_append_keeps_every_batch_row(spark, products):
    changes = batch(spark, (2, "B", "p", 30, 6), (2, "B", "q", 40, 7))
    after = scd2.append_and_expire(changes, products, TABLE)
    assert rows(after.where("id = 2"), "name", "is_latest", "ends") == [
        ("p", True, None), ("q", True, None), ("two!", False, 30), ("two", False, 20),
    ]


def test_late_row_between_versions(spark):
    source = batch(spark, (1, "A", "a", 10, 1), (1, "A", "c", 30, 3))
    late = batch(spark, (1, "A", "b", 20, 2))
    history = scd2.full_history(source, TABLE)
    refilled = scd2.backfill(late, history, TABLE, 10, 20)
    assert rows(refilled, "name", "is_latest", "starts", "ends") == [
        ("a", False, 10, 20), ("b", False, 20, 30), ("c", True, 30, None),
    ]
    assert rows(refilled) == rows(scd2.full_history(source.unionByName(late), TABLE))


def random_changes(spark, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice([1, 1, 1, 2, 3]), "A", rng.choice(["x", "y", None]), rng.randrange(60), i)
        for i in range(150)
    ]
    return batch(spark, *data), data


def brute_history(data):
    out = []
    for key in {r[:2] for r in data}:
        newest = {}
        for row in sorted((r for r in data if r[:2] == key), key=lambda r: (r[3], r[4])):
            newest[row[3]] = row
        kept = []
        for stamp in sorted(newest):
            if not kept or kept[-1][2] != newest[stamp][2]:
                kept.append(newest[stamp])
        for row, after in zip(kept, [*kept[1:], None], strict=True):
            out.append((*row, after is None, row[3], after[3] if after else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_rows", [None, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_full_history_by_brute_force(spark, seed, max_rows):
    df, data = random_changes(spark, seed)
    history = scd2.full_history(df, TABLE, max_group_rows=max_rows)
    assert rows(history) == brute_history(data)
    assert scd2_checks.history_gaps(history, TABLE, max_rows).isEmpty()
    assert scd2_checks.multiple_latest(history, TABLE).isEmpty()
    assert scd2_checks.no_latest(history, TABLE).isEmpty()


def test_as_of_gives_one_version_per_key(spark):
    df, data = random_changes(spark, 3)
    history = scd2.full_history(df, TABLE)
    for moment in (5, 30, 59):
        seen = scd2.as_of(history, TABLE, F.lit(moment))
        assert seen.count() == len({r[:2] for r in data if r[3] <= moment})


@pytest.fixture
def damaged(spark):
    return target(
        spark,
        (1, "A", "a", 10, 1, True, 10, 20),
        (1, "A", "b", 20, 2, True, 20, None),
        (1, "A", "c", 20, 3, True, 20, None),
        (2, "B", "d", 10, 4, False, 10, None),
        (3, "C", "e", 10, 5, True, 10, None),
    )


def test_checks_find_both_kinds(damaged):
    assert rows(scd2_checks.multiple_latest(damaged, TABLE)) == [(1, "A", 3)]
    assert rows(scd2_checks.no_latest(damaged, TABLE)) == [(2, "B", 1, 10)]
    assert rows(scd2_checks.repair_counts(damaged, TABLE)) == [(1, 2)]


def test_repair_leaves_exactly_one_and_is_a_fixed_point(damaged):
    fixed = scd2_checks.repair(damaged, TABLE)
    assert rows(fixed.where("id = 1"), "name", "is_latest", "ends") == [
        ("a", False, 20), ("b", False, 20), ("c", True, None),
    ]
    assert fixed.count() == damaged.count()
    assert rows(scd2_checks.repair(fixed, TABLE)) == rows(fixed)


@pytest.mark.parametrize("max_rows", [None, 2])
def test_equal_rows_leave_one_current(damaged, max_rows):
    twice = damaged.unionByName(damaged)
    for fix in (scd2_checks.repair, scd2_checks.rebuild_flags):
        fixed = fix(twice, TABLE, max_rows)
        assert fixed.count() == twice.count()
        assert scd2_checks.multiple_latest(fixed, TABLE).isEmpty()
        assert rows(fixed.where("is_latest AND id = 1"), "name") == [("c",)]


def test_rebuild_also_heals_keys_without_a_current_row(damaged):
    fixed = scd2_checks.rebuild_flags(damaged, TABLE)
    assert rows(fixed.where("is_latest"), "name") == [("c",), ("d",), ("e",)]


@pytest.mark.parametrize("max_rows", [None, 2])
def test_violation_report_lists_every_stamp(spark, max_rows):
    many = target(
        spark,
        *[(1, "A", "a", i, i, True, i, None) for i in range(7)],
        (2, "B", "b", 1, 9, True, 1, None),
        *[(3, "C", "c", i, i, True, i, None) for i in range(3)],
    )
    report = scd2_checks.violation_report(many, TABLE, piece=3, max_group_rows=max_rows)
    assert rows(report, "id", "piece_no", "n_listed", "stamps") == [
        (1, 1, 3, "0, 1, 2"), (1, 2, 3, "3, 4, 5"), (1, 3, 1, "6"), (3, 1, 3, "0, 1, 2"),
    ]


def test_order_and_stale_rows(spark, products):
    changes = batch(spark, (2, "B", "old", 15, 8), (2, "B", "new", 30, 9))
    assert rows(scd2_checks.stale_batch_rows(changes, products, TABLE), "name") == [("old",)]
    processed = batch(spark, (1, "A", "a", 30, 1), (1, "A", "b", 20, 2), (1, "A", "c", 40, 3))
    for max_rows in (None, 1):
        late = scd2_checks.order_violations(processed, TABLE, ["seq"], max_rows)
        assert rows(late, "name", "previous_modified") == [("b", 30)]


def test_null_keys_and_missing_changes(spark, products):
    changes = batch(spark, (None, "A", "a", 1, 1), (1, "A", "one", 10, 1), (1, "A", "z", 50, 2))
    assert rows(scd2_checks.null_keys(changes, TABLE)) == [("code", 0), ("id", 1)]
    absent = scd2_checks.missing_changes(changes.dropna(), products, TABLE)
    assert rows(absent) == [(1, "A", 50)]
    tied = batch(spark, (1, "A", "x", 5, 1), (1, "A", "y", 5, 2), (1, "A", "z", 6, 3))
    assert rows(scd2_checks.timestamp_ties(tied, TABLE)) == [(1, "A", 5, 2)]
