"""Manifests of partitions, bucketed current rows, schema changes, rows that have no place."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.config import AppendTable, PartitionTable, Scd2Table, StaticTable
from tidemark.operators import schema, scd2
from tidemark.plans import jobs
from tidemark.sinks.store import CheckFailed

FACTS = PartitionTable("facts", "day")


def facts(spark, *days, amount=1):
    data = [(i, amount * i, day) for day in days for i in range(3)]
    return spark.createDataFrame(data, "id int, amount int, day int")


def parquet_bytes(store, table="facts"):
    return {p: p.stat().st_size for p in Path(store.root, table).rglob("*.parquet") if "manifests" not in str(p)}


# ---- manifests -----------------------------------------------------------------


def test_a_switch_moves_no_rows_and_readers_keep_their_snapshot(spark, store, at):
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2, 3), load_id="L1", now=at(0))
    reader, before = store.partitions("facts"), parquet_bytes(store)
    source = facts(spark, 1, 2, 3, amount=7)
    staged = store.stage(source.where("day = 2"), "facts", "day", "L2")
    written = parquet_bytes(store)
    store.check_staged("facts", "day", staged)
    store.publish("facts", "partition", [store.switch("facts", "day", staged)], at(1), "test")
    assert parquet_bytes(store) == written and before.items() <= written.items()
    assert {r["value"]: r["load"] for r in store.snapshot("facts").collect()} == {1: "L1", 2: "L2", 3: "L1"}
    assert rows(store.partitions("facts"), "amount", "day") == sorted(
        [(i * (7 if d == 2 else 1), d) for d in (1, 2, 3) for i in range(3)], key=repr
    )
    assert rows(reader, "id", "amount", "day") == rows(facts(spark, 1, 2, 3)), "opened before the switch"
    assert rows(store.replaced("facts", "L2"), "id", "amount", "day") == rows(facts(spark, 2))
    assert store.replaced("facts", "L1") is None


def test_roll_back_and_the_same_id_again(spark, store, at):
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2), load_id="L1", now=at(0))
    source = facts(spark, 1, 2, 3, amount=5)
    args = (store, FACTS, source)
    jobs.backfill_partition_table(*args, low=2, high=3, load_id="L2", now=at(1))
    reader = store.partitions("facts")
    jobs.backfill_partition_table(*args, values=[1], load_id="L3", now=at(2))
    store.roll_back("facts", "day", "L2", at(3))
    # partition 1 stays as the later load left it
    want = facts(spark, 1, amount=5).unionByName(facts(spark, 2))
    assert rows(store.partitions("facts"), *want.columns) == rows(want)
    state = store.state("facts")
    assert (state["reason"], state["last_value"], state["records"]) == ("rolled_back", "2", 6)
    assert store.published("facts", "L2") is None and store.published("facts", "L3") is not None
    with pytest.raises(ValueError, match="no published load"):
        store.roll_back("facts", "day", "L2", at(4))
    assert jobs.backfill_partition_table(*args, low=2, high=3, load_id="L2", now=at(5)) == ("backfill", 6)
    assert rows(store.partitions("facts"), *source.columns) == rows(source)
    assert rows(reader, *source.columns) == rows(facts(spark, 1).unionByName(facts(spark, 2, 3, amount=5)))
    assert store.state("facts")["last_value"] == "3"


def test_a_crash_leaves_nothing_visible(spark, store, at, monkeypatch):
    jobs.load_partition_table(store, FACTS, facts(spark, 1), now=at(0))

    def crash(*_, **__):
        raise RuntimeError("lost")

    for step in ("check_staged", "switch", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(type(store), step, crash)
            with pytest.raises(RuntimeError):
                jobs.load_partition_table(store, FACTS, facts(spark, 1, 2), load_id="L2", now=at(1))
        assert store.partitions("facts").count() == 3
    assert jobs.load_partition_table(store, FACTS, facts(spark, 1, 2), load_id="L2", now=at(1))[1] == 3
    assert store.partitions("facts").count() == 6


def test_expired_partitions_go(spark, store, at):
    for n in range(4):
        jobs.backfill_partition_table(store, FACTS, facts(spark, 1, 2, amount=n), low=1 + n % 2, high=2, load_id=f"L{n}", now=at(n))
    want = rows(store.partitions("facts"))
    waiting = store.stage(facts(spark, 9), "facts", "day", "later")
    before = len(parquet_bytes(store))
    assert store.expire("facts", keep=1) == 4
    assert rows(store.partitions("facts")) == want and len(parquet_bytes(store)) < before
    store.publish("facts", "partition", [store.switch("facts", "day", waiting)], at(9), "test")
    assert store.partitions("facts").count() == 9
    with pytest.raises(ValueError):
        store.expire("facts", keep=0)


def test_the_newest_load_of_other_tables_is_undone(spark, store, at):
    codes = StaticTable("codes", primary_keys=("id",))
    made = lambda *data: spark.createDataFrame(list(data), "id int, name string")
    jobs.load_static_table(store, codes, made((1, "a")), load_id="L1", now=at(0))
    jobs.load_static_table(store, codes, made((1, "b")), load_id="L2", now=at(1))
    with pytest.raises(CheckFailed, match="newest"):
        store.undo("codes", "L1", at(2))
    store.undo("codes", "L2", at(2))
    assert rows(store.read("codes", "data")) == [(1, "a")] and store.state("codes")["load_id"] == "L1"
    assert jobs.load_static_table(store, codes, made((1, "c")), load_id="L2", now=at(3))[1] == 1
    assert rows(store.read("codes", "data")) == [(1, "c")]


# ---- versioned tables ----------------------------------------------------------


def people(spark, *data):
    rows_ = [(i, n, dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for i, n, d in data]
    return spark.createDataFrame(rows_, "id int, name string, modified timestamp_ntz")


def versions(store, table):
    stamp = F.date_diff(F.col("modified"), F.lit("2024-01-01").cast("date"))
    end = F.date_diff(F.col("ends"), F.lit("2024-01-01").cast("date"))
    got = jobs.versioned_rows(store, table).select("id", "name", stamp.alias("day"), end.alias("end"), "is_latest")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def described(name, **settings):
    return Scd2Table(name, ("id",), "modified", "is_latest", "starts", "ends", **settings)


def test_buckets_that_a_batch_does_not_touch_are_not_written(spark, store, at):
    plain, cut = described("plain"), described("cut", buckets=16)
    first = [(i, f"n{i}", 0) for i in range(200)]
    batches = [first, [*first, (3, "x", 1)], [*first, (3, "x", 1), (3, "y", 2), (500, "new", 2)]]
    for n, batch in enumerate(batches):
        for table in (plain, cut):
            jobs.load_scd2_table(store, table, people(spark, *batch), load_id=f"L{n}", now=at(n))
        assert versions(store, cut) == versions(store, plain)
    loads = [r["load"] for r in store.snapshot("cut", jobs.CURRENT).collect()]
    assert len(loads) == 16 and loads.count("L2") <= 2 and loads.count("L0") >= 13
    current = {p: s for p, s in parquet_bytes(store, "cut").items() if "/current/" in str(p)}
    sizes = {n: sum(s for p, s in current.items() if f"tidemark_load=L{n}/" in str(p)) for n in range(3)}
    assert 0 < sizes[1] < sizes[0] / 8, "what is written follows the batch"
    # reading for a batch opens its buckets only
    touched = jobs.current_rows(store, cut, people(spark, (3, "z", 3)))
    assert {f.split("tidemark_load=")[1].split("/")[0] for f in touched.inputFiles()} <= {"L1", "L2"}
    late = people(spark, *batches[2], (3, "w", 1))
    for table in (plain, cut):
        jobs.backfill_scd2_table(store, table, late, load_id="B", now=at(9))
        jobs.repair_scd2_table(store, table, rebuild=True, dry_run=False, now=at(10))
    assert versions(store, cut) == versions(store, plain)


def test_backfill_of_append_mode_keeps_every_row(spark, store, at):
    table = described("log", mode="append")
    data = [(1, "a", 1), (1, "b", 2), (1, "b", 3), (1, "c", 4), (2, "q", 1)]
    for n, row in enumerate(data[:4]):
        jobs.load_scd2_table(store, table, people(spark, *data[: n + 1]), now=at(n))
    before = versions(store, table)
    assert jobs.backfill_scd2_table(store, table, people(spark, *data[:4]), low=dt.datetime(2024, 1, 2), now=at(8))[0] == "backfill"
    assert versions(store, table) == before and len(before) == 4, "nothing was missing"
    late = [*data, (1, "b", 3), (1, "z", 0)]
    jobs.backfill_scd2_table(store, table, people(spark, *late), now=at(9))
    assert versions(store, table) == sorted(
        [(1, "z", 0, 1, False), (1, "a", 1, 2, False), (1, "b", 2, 3, False), (1, "b", 3, 4, False),
         (1, "b", 3, 4, False), (1, "c", 4, None, True), (2, "q", 1, None, True)], key=repr)


def test_late_rows_end_what_they_follow(spark):
    table = described("t", mode="append")
    stored = people(spark, (1, "a", 1), (1, "b", 5), (None, "n", 2)).withColumns(
        {"is_latest": F.col("name") != "a", "starts": F.col("modified"),
         "ends": F.when(F.col("name") == "a", F.lit("2024-01-06").cast("timestamp_ntz"))}
    )
    late = people(spark, (1, "x", 3), (1, "y", 9), (None, "m", 4), (1, "b", 5))
    got = scd2.backfill_appended(late, stored, table)
    day = lambda c: F.date_diff(F.col(c), F.lit("2024-01-01").cast("date"))
    assert rows(got.select("id", "name", day("modified"), day("ends"), "is_latest")) == sorted(
        [(1, "a", 1, 3, False), (1, "x", 3, 5, False), (1, "b", 5, 9, False), (1, "y", 9, None, True),
         (None, "n", 2, 4, False), (None, "m", 4, None, True)], key=repr)


# ---- schemas -------------------------------------------------------------------


def test_schema_changes_on_every_pattern(spark, store, at):
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    tables = {
        "p": (PartitionTable("p", "id"), lambda n, kind: made(n, kind)),
        "a": (AppendTable("a", "id"), lambda n, kind: made(n, kind)),
        "s": (StaticTable("s", primary_keys=("id",), load_strategy="upsert"), lambda n, kind: made(n, kind)),
        "v": (described("v"), lambda n, kind: made(n, kind).withColumn("modified", F.date_add(stamp, n).cast("timestamp_ntz"))),
    }

    def made(n, kind):
        df = spark.createDataFrame([(n, n)], "id int, x int")
        return {
            "int": df, "added": df.withColumn("y", F.lit("new")), "wider": df.withColumn("x", F.col("x").cast("bigint")),
            "text": df.withColumn("x", F.lit("t")), "narrower": df.withColumn("x", F.col("x").cast("smallint")),
        }[kind]

    def whole(name, table):
        return {"p": lambda: store.partitions("p"), "a": lambda: store.read("a", "data"),
                "s": lambda: store.read("s", "data"), "v": lambda: jobs.versioned_rows(store, table)}[name]()

    for name, (table, source) in tables.items():
        for n, kind in enumerate(("int", "added", "wider"), start=1):
            jobs.load_table(store, table, source(n, kind), now=at(n))
        for kind in ("text", "narrower"):
            with pytest.raises(CheckFailed, match="schema"):
                jobs.load_table(store, table, source(4, kind), now=at(4))
        got = whole(name, table)
        assert rows(got, "id", "x", "y") == [(1, 1, None), (2, 2, "new"), (3, 3, None)], name
        assert got.schema["x"].dataType.simpleString() == "bigint", name


def test_widening_order(spark):
    types = lambda text: spark.createDataFrame([], text).schema
    old = types("a int, b decimal(10,2), c string, d date")
    assert schema.type_conflicts(old, types("a bigint, b decimal(12,2), e int")) == []
    bad = schema.type_conflicts(old, types("a double, b decimal(12,4), c int, d timestamp_ntz"))
    assert [x[0] for x in bad] == ["a", "c", "d"]
    assert schema.type_conflicts(old, types("b decimal(11,4)")) != []
    merged = schema.merged_schema(old, types("a bigint, n int, d date"))
    assert merged.names == ["a", "b", "c", "n", "d"]


# ---- rows that have no place ---------------------------------------------------


def test_rows_without_a_partition_are_set_aside(spark, store, at):
    source = facts(spark, 1).unionByName(spark.createDataFrame([(9, 9, None)], "id int, amount int, day int"))
    assert jobs.load_partition_table(store, FACTS, source, load_id="L1", now=at(0)) == ("initial_load", 3)
    assert rows(store.read("facts.rejected", jobs.UNPLACED)) == [(9, 9, None)]
    assert jobs.load_partition_table(store, FACTS, source, load_id="L1", now=at(1)) == ("initial_load", 3)


def test_tied_late_and_unmarked_rows_arrive_once(spark, store, at):
    keyed = AppendTable("keyed", "n", keys=("k",), overlap=2)
    plain = AppendTable("plain", "n")
    source = lambda *data: spark.createDataFrame(list(data), "k string, n int")
    first = [("a", 1), ("b", 5), ("u", None)]
    then = [*first, ("tied", 5), ("late", 3), ("too late", 2), ("new", 6), ("w", None), ("new", 6)]
    for table, want in ((keyed, 4), (plain, 2)):
        assert jobs.load_append_table(store, table, source(*first), now=at(0)) == ("initial_load", 3 if table.keys else 2)
        got = jobs.load_append_table(store, table, source(*then), now=at(1))
        assert got == ("incremental_update", want)
    assert sorted(r.k for r in store.read("keyed", "data").collect()) == sorted(["a", "b", "u", "tied", "late", "new", "w"])
    assert jobs.load_append_table(store, keyed, source(*then), now=at(2)) == ("no_new_records", 0)
    assert sorted(r.k for r in store.read("plain.rejected", jobs.UNPLACED).collect()) == ["u", "w"]
    plan = store.mark("keyed", "data", spark.createDataFrame([], "n int").schema["n"].dataType)
    assert plan == "6"


def test_no_tables_no_status(spark, store):
    assert jobs.status(store, [], {}).count() == 0


def test_rows_that_stay_keep_what_the_target_knows(spark):
    from tidemark.operators import static

    source = spark.createDataFrame([(1, "a"), (3, "c"), (None, "n")], "id int, name string")
    target = spark.createDataFrame([(1, "b", "x"), (2, "z", "y"), (None, "m", "w")], "id int, name string, note string")
    got = static.sync_with_deletes(source, target, ["id"])
    assert rows(got) == sorted([(1, "a", "x"), (3, "c", None), (None, "n", "w")], key=repr)
