"""Loads over several runs: repeated, interrupted, rolled back, recovered."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.config import AppendTable, PartitionTable, Scd2Table, StaticTable
from tidemark.operators import scd2, scd2_checks, schema
from tidemark.plans import jobs
from tidemark.sinks.store import APPEND, CheckFailed, Store
from tidemark.sources import tables
from tidemark.streaming.incremental import append_new_files

FACTS = PartitionTable("facts", "day")


def facts(spark, *days, amount=1):
    data = [(i, amount * i, day) for day in days for i in range(3)]
    return spark.createDataFrame(data, "id int, amount int, day int")


def test_partition_runs(spark, store, at):
    assert jobs.load_partition_table(store, FACTS, facts(spark, 1, 3), now=at(0)) == ("initial_load", 6)
    # day 2 arrives late, below the mark; day 1 is not loaded again
    source = facts(spark, 1, 2, 3, 4)
    assert jobs.load_partition_table(store, FACTS, source, now=at(1)) == ("new_partitions", 6)
    assert rows(store.partitions("facts"), *source.columns) == rows(source)
    assert jobs.load_partition_table(store, FACTS, source, now=at(2)) == ("no_new_partitions", 0)
    state = store.state("facts")
    assert (state["last_value"], state["records"], state["reason"]) == ("4", 6, "new_partitions")


def test_first_load_takes_the_last_values_only(spark, store, at):
    table = PartitionTable("facts", "day", initial_load_count=2)
    jobs.load_partition_table(store, table, facts(spark, 1, 2, 3), now=at(0))
    assert {r[0] for r in rows(store.partitions("facts"), "day")} == {2, 3}
    # the days left out are not a gap to heal
    jobs.load_partition_table(store, table, facts(spark, 1, 2, 3, 4), now=at(1))
    assert {r[0] for r in rows(store.partitions("facts"), "day")} == {2, 3, 4}


def test_changed_partitions_are_replaced_and_rolled_back(spark, store, at):
    table = PartitionTable("facts", "day", replace_changed=True)
    before = facts(spark, 1, 2)
    jobs.load_partition_table(store, table, before, now=at(0))
    after = facts(spark, 1).unionByName(facts(spark, 2, 3, amount=5))
    assert jobs.load_partition_table(store, table, after, load_id="L2", now=at(1))[1] == 6
    assert rows(store.partitions("facts"), *after.columns) == rows(after)
    store.roll_back("facts", "day", "L2")
    assert rows(store.partitions("facts"), *before.columns) == rows(before)


def test_backfill_is_idempotent(spark, store, at):
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2, 3), now=at(0))
    source = facts(spark, 1, 2, 3, amount=7)
    for n in (1, 2):
        jobs.backfill_partition_table(store, FACTS, source, low=2, high=3, now=at(n))
        want = facts(spark, 1).unionByName(facts(spark, 2, 3, amount=7))
        assert rows(store.partitions("facts"), *want.columns) == rows(want)
    jobs.backfill_partition_table(store, FACTS, source, values=[1], now=at(3))
    assert rows(store.partitions("facts"), *source.columns) == rows(source)


def test_staged_rows_are_checked(spark, store, at):
    jobs.load_partition_table(store, FACTS, facts(spark, 1), now=at(0))
    other = facts(spark, 2).withColumn("amount", F.col("amount").cast("string"))
    with pytest.raises(CheckFailed, match="schema"):
        jobs.load_partition_table(store, FACTS, other, now=at(1))
    staged = store.stage(facts(spark, 2, 3), "facts", "day", "L9")
    with pytest.raises(CheckFailed, match="outside"):
        store.check_staged("facts", "day", staged, spark.createDataFrame([(2,)], "day int"))
    nulls = facts(spark, 2).withColumn("day", F.lit(None).cast("int"))
    with pytest.raises(CheckFailed, match="without day"):
        store.check_staged("facts", "day", store.stage(nulls, "facts", "day", "L10"))
    assert rows(store.partitions("facts"), "day") == [(1,)] * 3, "nothing was published"


def test_crash_before_the_switch_loses_nothing(spark, store, at, monkeypatch):
    jobs.load_partition_table(store, FACTS, facts(spark, 1), now=at(0))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "switch", crash)
        with pytest.raises(RuntimeError):
            jobs.load_partition_table(store, FACTS, facts(spark, 1, 2), load_id="L2", now=at(1))
    assert {r[0] for r in rows(store.partitions("facts"), "day")} == {1}
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2), load_id="L2", now=at(1))
    assert rows(store.partitions("facts"), "id", "day") == rows(facts(spark, 1, 2), "id", "day")


def test_lost_copy_is_rebuilt_from_the_other(spark, store, at, tmp_path):
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2, 3), now=at(0))
    other = Store(spark, str(tmp_path / "other"))
    jobs.load_partition_table(other, FACTS, facts(spark, 2), now=at(0))
    assert jobs.copy_missing_partitions(store, other, FACTS, now=at(1)) == ("recovered", 6)
    assert rows(other.partitions("facts")) == rows(store.partitions("facts"))
    assert jobs.copy_missing_partitions(store, other, FACTS, now=at(2))[1] == 0


def test_date_partitions_keep_their_type(spark, store, at):
    table = PartitionTable("daily", "day")
    df = facts(spark, 1, 2).withColumn("day", F.date_add(F.lit("2024-01-31").cast("date"), F.col("day")))
    jobs.load_partition_table(store, table, df, now=at(0))
    back = store.partitions("daily")
    assert back.schema["day"].dataType.simpleString() == "date"
    one = tables.partition_rows(back, "day", dt.date(2024, 2, 1))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert one.count() == 3


PEOPLE = Scd2Table(
    "people", ("id",), "modified", "is_latest", "starts", "ends", tracked=("name",), tie_break=("seq",)
)


def people(spark, *data):
    return spark.createDataFrame(list(data), "id int, name string, modified int, seq int")


DAY1 = [(1, "a", 10, 1), (1, "b", 20, 2), (2, "x", 15, 3)]
DAY2 = [(1, "b", 30, 4), (2, "y", 30, 5), (3, "n", 31, 6)]


def test_versions_over_three_runs(spark, store, at):
    assert jobs.load_scd2_table(store, PEOPLE, people(spark), now=at(0)) == ("no_data_in_source", 0)
    assert jobs.load_scd2_table(store, PEOPLE, people(spark, *DAY1), now=at(1)) == ("initial_load", 3)
    source = people(spark, *DAY1, *DAY2)
    assert jobs.load_scd2_table(store, PEOPLE, source, now=at(2)) == ("incremental_update", 3)
    want = [
        (1, "b", True, 20, None), (2, "x", False, 15, 30), (2, "y", True, 30, None),
        (3, "n", True, 31, None),
    ]
    columns = ["id", "name", "is_latest", "starts", "ends"]
    assert rows(jobs.versioned_rows(store, PEOPLE), *columns) == want
    # an unchanged row moved the mark too, so nothing is read again
    assert jobs.load_scd2_table(store, PEOPLE, source, now=at(3)) == ("no_new_records", 0)
    more = people(spark, *DAY1, *DAY2, (2, "z", 40, 7))
    jobs.load_scd2_table(store, PEOPLE, more, now=at(4))
    versions = jobs.versioned_rows(store, PEOPLE)
    assert rows(versions.where("id = 2"), "name", "ends") == [("x", 30), ("y", 40), ("z", None)]
    assert scd2_checks.multiple_latest(versions, PEOPLE).isEmpty()


def test_first_load_of_recent_days_only(spark, store, at):
    table = Scd2Table("p", ("id",), "modified", "is_latest", tracked=("name",), initial_load_days=30)
    source = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 3, 1))],
        "id int, name string, modified timestamp_ntz",
    )
    jobs.load_scd2_table(store, table, source, now=at(0))
    assert rows(jobs.versioned_rows(store, table), "id") == [(2,)]
    # the mark survives as text and comes back as a timestamp
    late = source.union(
        spark.createDataFrame([(3, "c", dt.datetime(2024, 3, 2, 0, 0, 0, 5))], source.schema)
    )
    assert jobs.load_scd2_table(store, table, late, now=at(1)) == ("incremental_update", 1)
    assert jobs.load_scd2_table(store, table, late, now=at(2)) == ("no_new_records", 0)


def test_overlap_catches_rows_that_share_the_mark(spark, store, at):
    table = Scd2Table(
        "p", ("id",), "modified", "is_latest", end_date="ends", tracked=("name",), overlap_seconds=60
    )
    noon = dt.datetime(2024, 1, 1, 12)
    names = "id int, name string, modified timestamp_ntz"
    first = [(1, "a", noon - dt.timedelta(hours=1)), (2, "b", noon)]
    jobs.load_scd2_table(store, table, spark.createDataFrame(first, names), now=at(0))
    # key 3 turns up later with the stamp of the mark, key 1 changes just before it
    more = [*first, (3, "c", noon), (1, "x", noon - dt.timedelta(seconds=30))]
    for n in (1, 2):
        jobs.load_scd2_table(store, table, spark.createDataFrame(more, names), now=at(n))
        versions = jobs.versioned_rows(store, table)
        assert rows(versions, "id", "name", "is_latest") == [
            (1, "a", False), (1, "x", True), (2, "b", True), (3, "c", True),
        ]


def test_full_history_fits_late_rows_in(spark, store, at):
    table = Scd2Table(
        "people", ("id",), "modified", "is_latest", "starts", "ends",
        tracked=("name",), tie_break=("seq",), mode="full_history",
    )
    jobs.load_scd2_table(store, table, people(spark, *DAY1), now=at(0))
    source = people(spark, *DAY1, *DAY2)
    jobs.load_scd2_table(store, table, source, now=at(1))
    assert rows(jobs.versioned_rows(store, table)) == rows(scd2.full_history(source, table))
    late = people(spark, *DAY1, *DAY2, (2, "late", 17, 9))
    assert jobs.load_scd2_table(store, table, late, now=at(2))[1] == 0, "below the mark"
    assert jobs.backfill_scd2_table(store, table, late, 15, 20, now=at(3))[0] == "backfill"
    assert rows(jobs.versioned_rows(store, table)) == rows(scd2.full_history(late, table))
    assert store.state("people")["last_value"] == "31", "a backfill leaves the mark alone"


def test_append_mode_and_repair(spark, store, at):
    table = Scd2Table(
        "people", ("id",), "modified", "is_latest", "starts", "ends",
        tracked=("name",), tie_break=("seq",), mode="append",
    )
    jobs.load_scd2_table(store, table, people(spark, *DAY1), now=at(0))
    twice = people(spark, *DAY1, (2, "p", 40, 7), (2, "q", 50, 8))
    jobs.load_scd2_table(store, table, twice, now=at(1))
    assert jobs.repair_scd2_table(store, table) == (2, 2)
    assert jobs.repair_scd2_table(store, table, dry_run=False, now=at(2)) == (2, 2)
    versions = jobs.versioned_rows(store, table)
    assert rows(versions.where("id = 2 AND is_latest"), "name") == [("q",)]
    assert versions.count() == 5
    assert jobs.repair_scd2_table(store, table) == (0, 0)


def test_first_load_of_append_mode_keeps_every_row(spark, store, at):
    table = Scd2Table(
        "people", ("id",), "modified", "is_latest", "starts", "ends",
        tracked=("name",), tie_break=("seq",), mode="append",
    )
    source = people(spark, (1, "a", 1, 1), (1, "b", 2, 2), (1, "b", 2, 2))
    assert jobs.load_scd2_table(store, table, source, now=at(0)) == ("initial_load", 3)
    assert jobs.versioned_rows(store, table).count() == 3
    # of three current rows, two of them equal, one stays
    assert jobs.repair_scd2_table(store, table, dry_run=False, now=at(1)) == (1, 2)
    assert jobs.repair_scd2_table(store, table) == (0, 0)


def test_backfill_parts_a_version_from_its_repeat(spark, store, at):
    known = [(1, "A", 10, 1), (1, "A", 20, 2), (1, "B", 40, 3)]
    jobs.load_scd2_table(store, PEOPLE, people(spark, *known), now=at(0))
    late = people(spark, *known, (1, "X", 15, 4))
    assert jobs.backfill_scd2_table(store, PEOPLE, late, 12, 16, now=at(1)) == ("backfill", 1)
    versions = jobs.versioned_rows(store, PEOPLE)
    assert rows(versions, "modified", "name") == [(10, "A"), (15, "X"), (20, "A"), (40, "B")]


def test_backfill_removes_what_the_source_lost(spark, store, at):
    jobs.load_partition_table(store, FACTS, facts(spark, 1, 2, 3, 4), now=at(0))
    source = facts(spark, 1, 2, 4, amount=7)
    jobs.backfill_partition_table(store, FACTS, source, low=2, high=3, load_id="B", now=at(1))
    assert {r[0] for r in rows(store.partitions("facts"), "day")} == {1, 2, 4}
    store.roll_back("facts", "day", "B")
    want = facts(spark, 1, 2, 3, 4)
    assert rows(store.partitions("facts"), *want.columns) == rows(want)
    # nothing but the removal is left to do
    jobs.backfill_partition_table(store, FACTS, source, values=[3], now=at(2))
    assert {r[0] for r in rows(store.partitions("facts"), "day")} == {1, 2, 4}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "string"])
def test_roll_back_of_values_that_paths_escape(spark, store, at, kind):
    table = PartitionTable("odd", "day")
    odd = {"timestamp_ntz": "2024-01-02 10:00:00", "string": "a:b/c%20 d=e"}[kind]
    plain = {"timestamp_ntz": "2024-01-01 00:00:00", "string": "x"}[kind]

    def source(*values):
        made = spark.createDataFrame([(v, 1) for v in values], "day string, v int")
        return made.select(F.col("day").cast(kind).alias("day"), "v")

    jobs.load_partition_table(store, table, source(plain), now=at(0))
    jobs.load_partition_table(store, table, source(plain, odd), load_id="L2", now=at(1))
    assert store.partitions("odd").count() == 2
    store.roll_back("odd", "day", "L2")
    assert rows(store.partitions("odd"), "day", "v") == rows(source(plain))


def test_crash_before_publishing_versions(spark, store, at, monkeypatch):
    jobs.load_scd2_table(store, PEOPLE, people(spark, *DAY1), now=at(0))
    before = rows(jobs.versioned_rows(store, PEOPLE))
    source = people(spark, *DAY1, *DAY2)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.load_scd2_table(store, PEOPLE, source, load_id="L", now=at(1))
    assert rows(jobs.versioned_rows(store, PEOPLE)) == before
    jobs.load_scd2_table(store, PEOPLE, source, load_id="L", now=at(1))
    assert jobs.versioned_rows(store, PEOPLE).count() == 4


CODES = StaticTable("codes", primary_keys=("id",))


def codes(spark, *data):
    return spark.createDataFrame(list(data), "id int, name string")


def test_static_replace_runs(spark, store, at):
    source = codes(spark, (1, "a"), (2, "b"))
    assert jobs.load_static_table(store, CODES, source, now=at(0)) == ("initial_load", 2)
    assert jobs.load_static_table(store, CODES, source.repartition(5), now=at(1)) == ("unchanged", 0)
    assert jobs.load_static_table(store, CODES, source, force=True, now=at(2))[0] == "forced"
    changed = codes(spark, (1, "a"), (2, "c"))
    assert jobs.load_static_table(store, CODES, changed, now=at(3)) == ("hash_changed", 2)
    assert rows(store.read("codes", "data")) == [(1, "a"), (2, "c")]
    assert jobs.load_static_table(store, CODES, codes(spark), now=at(4)) == ("empty_source", 0)
    assert store.read("codes", "data").count() == 2
    aged = StaticTable("codes", force_reload_after_days=1)
    assert jobs.load_static_table(store, aged, changed, now=at(60))[0] == "forced_by_age"


def test_static_upsert_and_deletes(spark, store, at):
    table = StaticTable("codes", ("id",), load_strategy="upsert", lineage=True)
    jobs.load_static_table(store, table, codes(spark, (1, "a"), (2, "b")), now=at(0))
    fresh = codes(spark, (2, "c"), (3, "d"))
    jobs.load_static_table(store, table, fresh, load_id="L2", now=at(1))
    back = store.read("codes", "data")
    assert rows(back, "id", "name") == [(1, "a"), (2, "c"), (3, "d")]
    assert {r[0] for r in rows(back, "_load_id")} == {"L2"}
    strict = StaticTable("codes", ("id",), load_strategy="upsert", allow_deletes=True)
    jobs.load_static_table(store, strict, fresh, force=True, now=at(2))
    assert rows(store.read("codes", "data"), "id") == [(2,), (3,)]
    with pytest.raises(CheckFailed, match="primary key"):
        jobs.load_static_table(store, table, codes(spark, (1, "a"), (1, "b")), now=at(3))


def test_static_repair(spark, store, at):
    source = codes(spark, (1, "a"), (2, "b"))
    jobs.load_static_table(store, CODES, source, now=at(0))
    assert jobs.repair_static_table(store, CODES, source) == ("consistent", 0)
    wrong = store.write(codes(spark, (1, "broken")), "codes", "data", "bad", "replace")
    store.publish("codes", "static", [wrong], at(1), "manual", store.state("codes")["last_hash"])
    assert jobs.repair_static_table(store, CODES, source) == ("forced", 2)
    assert rows(store.read("codes", "data")) == rows(source)


def test_filter_comes_before_the_fingerprint(spark, store, at):
    table = StaticTable("codes", where="id < 10")
    jobs.load_static_table(store, table, codes(spark, (1, "a"), (99, "b")), now=at(0))
    assert rows(store.read("codes", "data")) == [(1, "a")]
    outside = codes(spark, (1, "a"), (98, "c"))
    assert jobs.load_static_table(store, table, outside, now=at(1)) == ("unchanged", 0)


LOG = AppendTable("log", "n")


def test_append_runs(spark, store, at):
    source = spark.range(1, 4).toDF("n")
    assert jobs.load_append_table(store, LOG, source, now=at(0)) == ("initial_load", 3)
    longer = spark.range(1, 6).toDF("n")
    # a run that crashed after writing is repeated under the same id
    store.write(longer.where("n > 3"), "log", "data", "L2", APPEND)
    assert jobs.load_append_table(store, LOG, longer, load_id="L2", now=at(1))[1] == 2
    assert jobs.load_append_table(store, LOG, longer, now=at(2)) == ("no_new_records", 0)
    assert rows(store.read("log", "data")) == [(1,), (2,), (3,), (4,), (5,)]


def test_overlap_reads_late_rows_again(spark):
    source, target = spark.range(10).toDF("n"), spark.range(6).toDF("n")
    assert tables.rows_after(source, target, "n").count() == 4
    assert tables.rows_after(source, target, "n", overlap=F.lit(2)).count() == 6
    assert tables.rows_after(source, target.limit(0), "n").count() == 10


def test_stream_takes_each_file_once(spark, store, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    first = spark.range(0, 5).toDF("n")
    first.write.parquet(folder)

    def run():
        return append_new_files(spark, store, LOG, folder, first.schema, checkpoint)

    assert run() == 5
    assert run() == 0
    spark.range(5, 8).toDF("n").write.mode("append").parquet(folder)
    assert run() == 3
    assert store.read("log", "data").count() == 8


def test_run_over_all_tables(spark, store, at):
    def broken(_):
        raise ValueError("no such table")

    described = [FACTS, PEOPLE, CODES, LOG, AppendTable("gone", "n")]
    sources = {
        "facts": lambda s: facts(s, 1, 2),
        "people": lambda s: people(s, *DAY1),
        "codes": lambda s: codes(s, (1, "a")),
        "log": lambda s: s.range(4).toDF("n"),
        "gone": broken,
    }
    log = jobs.run(store, described, sources, run_id="r1", now=at(0))
    got = {r["table_name"]: (r["success"], r["total_records"]) for r in log.collect()}
    assert got == {
        "codes": (True, 1), "people": (True, 3), "facts": (True, 6), "log": (True, 4), "gone": (False, 0),
    }
    assert "no such table" in log.where("NOT success").first()["error"]
    jobs.run(store, described, sources, kinds=["static"], run_id="r2", now=at(1))
    assert jobs.run_log(store).groupBy("run_id").count().count() == 2
    again = jobs.run_log(store).where("run_id = 'r2'").first()
    assert (again["reason"], again["total_records"]) == ("unchanged", 0)


def test_status_shows_what_waits(spark, store, at):
    described = [FACTS, PEOPLE, CODES, LOG]
    sources = {
        "facts": lambda s: facts(s, 1, 2),
        "people": lambda s: people(s, *DAY1),
        "codes": lambda s: codes(s, (1, "a")),
        "log": lambda s: s.range(4).toDF("n"),
    }
    before = jobs.status(store, described, sources)
    assert rows(before, "table_name", "n_pending", "last_value") == [
        ("codes", 1, None), ("facts", 2, None), ("log", 4, None), ("people", 3, None),
    ]
    jobs.run(store, described, sources, now=at(0))
    sources["facts"] = lambda s: facts(s, 1, 2, 3)
    sources["people"] = lambda s: people(s, *DAY1, *DAY2)
    sources["log"] = lambda s: s.range(6).toDF("n")
    after = jobs.status(store, described, sources)
    assert rows(after, "table_name", "n_pending", "last_value") == [
        ("codes", 0, None), ("facts", 1, "2"), ("log", 2, "3"), ("people", 3, "20"),
    ]
    assert after.where("updated_at IS NOT NULL").count() == 4


def test_rows_without_a_key_stop_a_load(spark, store, at):
    with pytest.raises(CheckFailed, match="'id': 1"):
        jobs.load_scd2_table(store, PEOPLE, people(spark, (None, "a", 1, 1), (1, "a", 1, 2)))
    with pytest.raises(CheckFailed, match="'id': 1"):
        jobs.load_static_table(store, CODES, codes(spark, (None, "a")))
    assert store.loads().count() == 0


def test_a_large_partition_is_written_by_several_tasks(spark, store):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "128KB")
    try:
        rows_ = spark.range(0, 200_000, 1, 8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 100 == 0, F.col("id") / 100 % 20).otherwise(99).cast("int").alias("day"),
        )
        staged = store.stage(rows_, "facts", "day", "L")
        assert staged.records == 200_000
        folder = store.path("facts", "partitions", "tidemark_load=L")
        files = spark.read.parquet(folder).select("day", F.input_file_name().alias("f"))
        per_day = dict(rows(files.groupBy("day").agg(F.count_distinct("f"))))
    finally:
        spark.conf.set(size, before)
    assert per_day[99] > 4, "the partition with most rows is spread"
    # a small one is split only if it shares a shuffle partition with the large one
    small = [n for day, n in per_day.items() if day != 99]
    assert sum(n == 1 for n in small) >= len(small) / 2


def test_files_follow_the_settings(spark, tmp_path):
    import pyarrow.parquet as pq

    plain = Store(spark, str(tmp_path / "s"), compression="snappy")
    plain.write(spark.range(10).toDF("n").coalesce(1), "t", "data", "L", APPEND)
    file = next((tmp_path / "s" / "t" / "data" / "load_id=L").glob("*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_jdbc_options():
    options = tables.jdbc_options(
        "jdbc:sqlserver://host", "dbo.t", "x > 1", split_on="id", bounds=(1, 100), partitions=8
    )
    assert options["dbtable"] == "(SELECT * FROM dbo.t WHERE x > 1) AS filtered"
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert tables.jdbc_options("jdbc:x", "t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", split_on="id")


def test_rejected_rows_are_kept(spark, store, at):
    from tidemark.functions.types import spark_schema

    wanted = spark_schema({"id": {"data_type": "int"}, "name": {"data_type": "varchar"}})
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), ("3", "c")], "id string, name string")
    with pytest.raises(schema.TooManyErrors):
        jobs.convert_source(store, CODES, raw, wanted)
    good = jobs.convert_source(store, CODES, raw, wanted, error_threshold=0.5, now=at(0))
    jobs.load_static_table(store, CODES, good, now=at(0))
    assert rows(store.read("codes", "data")) == [(1, "a"), (3, "c")]
    assert rows(store.read("codes.rejected", "data")) == [("x", "b", "id")]


def test_typed_read_of_a_table(spark):
    df = spark.createDataFrame([("1", "2024-01-01")], "id string, day string")
    from tidemark.functions.types import spark_schema

    wanted = spark_schema({"id": {"data_type": "int"}, "day": {"data_type": "date"}})
    assert schema.typed(df, wanted).schema.simpleString() == "struct<id:int,day:date>"


def test_the_same_id_twice_changes_nothing(spark, store, at):
    def twice(load, table, first, second):
        one = load(store, table, first, load_id="r1", now=at(0))
        assert load(store, table, second, load_id="r1", now=at(1))[0] == one[0]

    twice(jobs.load_append_table, LOG, spark.range(3).toDF("n"), spark.range(5).toDF("n"))
    assert store.read("log", "data").count() == 3
    twice(jobs.load_partition_table, FACTS, facts(spark, 1), facts(spark, 1, 2))
    assert store.partitions("facts").count() == 3
    twice(jobs.load_static_table, CODES, codes(spark, (1, "a")), codes(spark, (1, "b")))
    assert rows(store.read("codes", "data"), "id", "name") == [(1, "a")]
    twice(jobs.load_scd2_table, PEOPLE, people(spark, *DAY1), people(spark, *DAY1))
    before = jobs.versioned_rows(store, PEOPLE).count()
    assert before == store.read("people", jobs.CURRENT).count()
    # a new id goes on from there
    assert jobs.load_append_table(store, LOG, spark.range(5).toDF("n"), load_id="r2", now=at(2)) == (
        "incremental_update",
        2,
    )


def test_two_streams_into_one_table(spark, store, tmp_path):
    for name, low in (("one", 0), ("two", 10)):
        folder = str(tmp_path / name)
        spark.range(low, low + 3).toDF("n").write.parquet(folder)
        schema_of = spark.read.parquet(folder).schema
        assert append_new_files(spark, store, LOG, folder, schema_of, str(tmp_path / f"check-{name}")) == 3
    assert sorted(r[0] for r in store.read("log", "data").collect()) == [0, 1, 2, 10, 11, 12]


def test_changes_with_a_null_key_are_merged(spark):
    from tidemark.operators import static

    source = spark.createDataFrame([(None, "a"), (1, "b")], "id int, name string")
    target = spark.createDataFrame([(1, "c")], "id int, name string")
    got = static.merge_changes(source, target, ["id"])
    assert {(r["id"], r["action"]) for r in got.collect()} == {(None, static.INSERT), (1, static.UPDATE)}


def test_what_was_not_looked_at_is_unknown(spark):
    from tidemark.operators import report

    states = spark.createDataFrame([("t",)], "table_name string")
    pending = spark.createDataFrame([], "table_name string, n_pending bigint")
    prints = spark.createDataFrame([], "table_name string, stored_fingerprint string, target_fingerprint string")
    row = report.pipeline_status(states, pending, prints).first()
    assert (row["n_pending"], row["consistency"]) == (None, "unknown")
