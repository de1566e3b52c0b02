"""Loads after lost folders, log files and targets, and what the file footers tell."""

from __future__ import annotations

import os
import shutil
from pathlib import Path

import pytest

from tests.conftest import rows
from tests.test_store import described, facts, people, versions
from tidemark.config import AppendTable, PartitionTable, StaticTable
from tidemark.plans import jobs, recovery
from tidemark.sinks.store import Store

LOG = AppendTable("log", "n")


def numbers(spark, high):
    return spark.range(high).toDF("n")


def lose(store, *parts):
    """A folder that vanishes from storage."""
    shutil.rmtree(Path(store.path(*parts)))


def stored(store):
    return sorted(r.n for r in store.read("log", "data").collect())


def test_state_comes_from_footers(spark, store, at):
    for n, high in enumerate((5, 9)):
        jobs.load_append_table(store, LOG, numbers(spark, high), load_id=f"L{n}", now=at(n))
    schema = store.schema("log", "data")
    state = recovery.stored_state(store, "log", "data", schema, "n")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(n), MAX(n)]" in plan
    assert rows(state) == [("L0", 5, 0, 4), ("L1", 4, 5, 8)]
    shutil.rmtree(store.path("_loads"))
    assert store.state("log") is None and recovery.detected_mark(store, "log", "data", schema, "n") == 8


def test_lost_folder_of_an_append_table(spark, store, at):
    for n, high in enumerate((5, 9, 12)):
        jobs.load_append_table(store, LOG, numbers(spark, high), load_id=f"L{n}", now=at(n))
    assert recovery.recover(store, LOG, at(3)) == []
    lose(store, "log", "data", "load_id=L1")
    assert recovery.recover(store, LOG, at(3)) == [("L2", "taken back"), ("L1", "taken back")]
    assert store.state("log")["last_value"] == "4"
    assert jobs.load_append_table(store, LOG, numbers(spark, 12), load_id="L3", now=at(4))[1] == 7
    assert stored(store) == list(range(12))


@pytest.mark.parametrize("which", [0, 1, 2, None])
def test_lost_log_rows_of_an_append_table(spark, store, at, which, monkeypatch):
    for n, high in enumerate((5, 9, 12)):
        before = set(os.listdir(store.path("_loads"))) if n else set()
        with monkeypatch.context() as patch:  # an attempt that fails, and whose rows come again
            patch.setattr(Store, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                jobs.load_append_table(store, LOG, numbers(spark, high), load_id=f"failed{n}", now=at(n))
        jobs.load_append_table(store, LOG, numbers(spark, high), load_id=f"L{n}", now=at(n))
        if n == which:
            for name in set(os.listdir(store.path("_loads"))) - before:
                if name.startswith((".part", "part")):
                    os.remove(store.path("_loads", name))
    if which is None:
        shutil.rmtree(store.path("_loads"))
    recovery.recover(store, LOG, at(5))
    jobs.load_append_table(store, LOG, numbers(spark, 14), load_id="L9", now=at(6))
    assert stored(store) == list(range(14))
    assert recovery.recover(store, LOG, at(7)) == []


def test_the_least_mark_of_log_files_and_copy_counts(spark, store, at, tmp_path):
    other = Store(spark, str(tmp_path / "other"))
    for n, high in enumerate((6, 8, 11)):  # marks 5, 7 and 10
        jobs.load_append_table(store, LOG, numbers(spark, high), load_id=f"L{n}", now=at(n))
    jobs.load_append_table(other, LOG, numbers(spark, 8), now=at(0))
    lose(store, "log", "data", "load_id=L1")
    assert recovery.recover(store, LOG, at(4), other) == [("L2", "taken back"), ("L1", "taken back")]
    assert recovery.reconciled_mark(store, LOG, other) == "5"
    assert jobs.load_append_table(store, LOG, numbers(spark, 11), now=at(5))[1] == 5
    assert stored(store) == list(range(11))
    assert recovery.recover(store, LOG, at(6), other) != [], "the copy knows up to 7 only"
    assert recovery.reconciled_mark(store, LOG, other) == "5"


def test_lost_partitions_are_loaded_again(spark, store, at):
    table = PartitionTable("facts", "day")
    source = facts(spark, 1, 2, 3)
    jobs.load_partition_table(store, table, source, load_id="L1", now=at(0))
    lose(store, "facts", "partitions", "tidemark_load=L1", "day=2")
    assert recovery.recover(store, table, at(1)) == [("2", "partition lost")]
    assert jobs.load_partition_table(store, table, source, load_id="L2", now=at(2)) == ("new_partitions", 3)
    assert rows(store.partitions("facts"), *source.columns) == rows(source)
    lose(store, "facts", "partitions", "tidemark_load=L1")
    assert len(recovery.recover(store, table, at(3))) == 2
    jobs.load_partition_table(store, table, source, load_id="L3", now=at(4))
    assert rows(store.partitions("facts"), *source.columns) == rows(source)


@pytest.mark.parametrize("buckets", [None, 4])
def test_lost_versions_are_loaded_again(spark, store, at, buckets):
    table = described("people", buckets=buckets)
    data = [[(1, "a", 0), (2, "b", 0)], [(1, "c", 1)], [(2, "d", 2), (3, "e", 2)]]
    known = []
    for n, batch in enumerate(data):
        known += batch
        jobs.load_scd2_table(store, table, people(spark, *known), load_id=f"L{n}", now=at(n))
    want = versions(store, table)
    key = "tidemark_load" if buckets else "load_id"
    lose(store, "people", "current", f"{key}=L2")
    assert recovery.recover(store, table, at(4)) == [("L2", "taken back")]
    jobs.load_scd2_table(store, table, people(spark, *known), load_id="L3", now=at(5))
    assert versions(store, table) == want
    lose(store, "people", "history", "load_id=L1")
    assert [load for load, _ in recovery.recover(store, table, at(6))] == ["L3", "L1"]
    jobs.load_scd2_table(store, table, people(spark, *known), load_id="L4", now=at(7))
    assert {v[:3] for v in versions(store, table)} == {v[:3] for v in want}


def test_lost_reference_table_and_copies(spark, store, at, tmp_path):
    codes = StaticTable("codes")
    source = spark.createDataFrame([(1, "a")], "id int, name string")
    jobs.load_static_table(store, codes, source, load_id="L0", now=at(0))
    lose(store, "codes", "data")
    runs = jobs.run(store, [codes], {"codes": lambda s: source}, run_id="R", now=at(1), before=recovery.recover)
    assert runs.first()["success"] and rows(store.read("codes", "data")) == [(1, "a")]
    other = Store(spark, str(tmp_path / "other"))
    assert recovery.copy_table(store, other, codes, at(2)) == ("recovered", 1)
    assert jobs.load_static_table(other, codes, source, now=at(3)) == ("unchanged", 0)
    table = described("people")
    jobs.load_scd2_table(store, table, people(spark, (1, "a", 0)), now=at(0))
    jobs.load_scd2_table(store, table, people(spark, (1, "a", 0), (1, "b", 1)), now=at(1))
    assert recovery.copy_table(store, other, table, at(2)) == ("recovered", 2)
    assert versions(other, table) == versions(store, table)
    assert jobs.load_scd2_table(other, table, people(spark, (1, "b", 1), (1, "c", 2)), now=at(3))[1] == 1
    jobs.load_append_table(store, LOG, numbers(spark, 3), now=at(0))
    assert recovery.copy_table(store, other, LOG, at(2)) == ("recovered", 3)
    assert jobs.load_append_table(other, LOG, numbers(spark, 5), now=at(3))[1] == 2
    assert recovery.copy_table(store, other, AppendTable("none", "n")) == ("nothing_to_copy", 0)
