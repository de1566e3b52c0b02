"""High-water marks, partition values, keys, reports: the cases the tables do not have."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from suite.partitions import CASES
from tests.conftest import SF_DIR, rows
from tidemark.config import AppendTable, PartitionTable, Scd2Table, StaticTable
from tidemark.operators import partitions, quality, report, watermark
from tidemark.sources import tables


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "day int")


def test_marks_of_an_empty_table(spark):
    empty = numbers(spark)
    assert watermark.high_watermark(empty, "day").first()["high"] is None
    assert watermark.high_watermark(empty, "day", F.lit(0)).first()["high"] == 0
    assert watermark.last_n_days(empty, "day", 3).count() == 0
    assert partitions.last_n_partitions(empty, "day", 3).count() == 0


@pytest.mark.parametrize(
    ("source", "target", "want"),
    [
        ([], [1], (1, None, "no_data_in_source")),
        ([1, 2], [], (None, 2, "initial_load")),
        ([2, 2], [], (None, 2, "initial_load")),
        ([1, 3], [2], (2, 3, "incremental_update")),
        ([1, 2], [2], (2, 2, "no_new_records")),
    ],
)
def test_processing_range(spark, source, target, want):
    found = watermark.processing_range(numbers(spark, *source), numbers(spark, *target), "day")
    assert tuple(found.first()) == want


def test_least_known_mark_wins(spark):
    marks = spark.createDataFrame(
        [("a", "recorded", 10), ("a", "stored", 5), ("a", "target", 7),
         ("b", "recorded", 3), ("b", "stored", None), ("c", "stored", None)],
        "table_name string, origin string, last_value int",
    )
    assert rows(watermark.reconcile_state(marks)) == [
        ("a", 5, "stored", "recorded,stored,target"), ("b", 3, "recorded", "recorded"),
        ("c", None, None, ""),
    ]


def test_timestamp_gaps(spark):
    days = [dt.datetime(2024, 1, d, 5 * d // 2) for d in (1, 2, 5, 6, 9)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    gaps = watermark.timestamp_gaps(df, "t")
    assert [(r[0].day, r[1].day, r[2]) for r in gaps.collect()] == [(2, 5, 2), (6, 9, 2)]


def test_partition_values(spark):
    df = numbers(spark, 3, 1, None, 2, 3)
    assert [r[0] for r in partitions.partition_values(df, "day").collect()] == [1, 2, 3]
    assert rows(partitions.partition_values(df, "day", 2, 2)) == [(2,)]
    assert rows(partitions.new_partition_values(df, "day", 1)) == [(2,), (3,)]
    assert rows(partitions.new_partition_values(df, "day")) == [(1,), (2,), (3,)]
    assert rows(partitions.missing_partitions(df, numbers(spark, 1, 3), "day")) == [(2,)]
    assert rows(partitions.value_inventory(df, "day")) == [(1, 1, 1), (2, 1, 2), (3, 2, 3)]


def test_boundary_belongs_to_the_right(spark):
    df = numbers(spark, 5, 10, 15, 20, 99, None)
    got = df.select("day", partitions.range_partition_number(F.col("day"), [20, 10]))
    assert rows(got) == [(10, 2), (15, 2), (20, 3), (5, 1), (99, 3), (None, None)]
    inventory = partitions.partition_inventory(df.where("day < 20"), "day", [10, 20])
    assert rows(inventory) == [(1, 1, None), (2, 2, 10), (3, 0, 20)]
    assert rows(partitions.partitions_to_process(inventory, 10), "partition_number") == [(1,), (3,)]
    assert partitions.partitions_to_process(inventory).count() == 3
    assert rows(partitions.partition_inventory(df, "day", [])) == [(1, 5, None)]
    many = df.select("day", partitions.range_partition_number(F.col("day"), range(16_000)))
    assert rows(many.where("day = 99")) == [(99, 101)]


def test_partition_comparison(spark):
    schema = "day int, v int"
    source = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 1)], schema)
    target = spark.createDataFrame([(1, 1), (2, 1), (2, 3), (9, 1)], schema)
    strategy = partitions.partition_load_strategy(source, target, "day")
    assert dict(rows(strategy, "day", "strategy")) == {1: "skip", 2: "replace", 3: "append"}
    assert rows(partitions.inconsistent_partitions(source, target, "day"), "day") == [(2,)]
    matrix = partitions.missing_data_analysis(source, target, source.where("day < 3"), "day")
    assert dict(rows(matrix, "day", "status")) == {
        1: "complete", 2: "complete", 3: "not_loaded", 9: "not_in_source",
    }


def test_alignment(spark):
    staged = numbers(spark, 1, 1, 2, None)
    assert rows(partitions.partition_alignment(staged, "day", [1])) == [(4, 2, False)]
    assert rows(partitions.partition_alignment(numbers(spark), "day", [1])) == [(0, 0, True)]


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.col("id"), F.expr("TIMESTAMP_NTZ '2024-01-01' + make_interval(0,0,0,id)").alias("t")
    ).write.parquet(path)
    df = tables.read_files(spark, path)
    high = df.where("id < 4").agg(F.max("t").alias("m")).first()["m"]
    for picked in (
        tables.range_rows(df, "t", high, high + dt.timedelta(days=2)),
        tables.rows_above(df, "t", str(high)),
        tables.rows_after(df, df.where("id < 4"), "t"),
    ):
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(t,2024-01-04" in plan
    assert tables.range_rows(df, "t", high, high + dt.timedelta(days=2)).count() == 2
    narrow = tables.range_rows(df, "id", 3).select("id")
    assert "ReadSchema: struct<id:bigint>" in narrow._jdf.queryExecution().executedPlan().toString()


def test_day_ranges_of_the_suite_reach_the_scan(spark):
    found = {
        "partition_scan": "l_shipdate", "partition_values": "l_shipdate",
        "new_partition_values": "l_shipdate", "backfill_partitions": "o_orderdate",
    }
    for key, column in found.items():
        plan = CASES[key].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({column}," in plan, key


def test_keys(spark):
    df = spark.createDataFrame(
        [(i, i // 2, None if i == 3 else i, i % 2) for i in range(200)], "a int, b int, c int, d int"
    )
    found = quality.key_candidates(df, [("b", "d"), ("b", "c")])
    assert rows(found) == [("a", 200), ("b,d", 200)]
    assert rows(quality.partition_candidates(df, 100), "column_name") == [("b",), ("d",)]
    assert rows(quality.duplicate_key_count(df, ["b"])) == [(100, 100)]
    assert quality.key_candidates(df.select(F.lit(1).alias("x"))).count() == 0


def test_validation(spark):
    people = spark.createDataFrame(
        [(1, True), (1, True), (2, False), (None, True)], "id int, IsLatest boolean"
    )
    checked = [
        (Scd2Table("people", ("id",)), people),
        (StaticTable("codes", ("day",)), numbers(spark, 1, 1, None)),
        (StaticTable("none", ("day",)), numbers(spark)),
        (PartitionTable("facts", "day"), numbers(spark, 1, 2)),
    ]
    assert rows(quality.validate_all(checked)) == [
        ("codes", "duplicate_key", "day", 1), ("codes", "null_key", "day", 1),
        ("none", "empty_table", "", 1), ("people", "multiple_latest", "id", 1),
        ("people", "no_latest", "id", 1), ("people", "null_key", "id", 1),
    ]
    assert rows(quality.validation_summary(checked)) == [(4, 1, 3)]
    with pytest.raises(TypeError):
        quality.table_issues(AppendTable("t", "n"), people)


LOG = "run_id string, table_name string, table_type string, success boolean, total_records bigint, duration_seconds double, finished_at timestamp_ntz"


def log(spark, *entries):
    hour = dt.timedelta(hours=1)
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("r", t, "scd", ok, n, sec, start + h * hour) for t, ok, n, sec, h in entries], LOG
    )


def test_alerts(spark):
    runs = log(
        spark,
        ("slow", True, 1, 1.0, 40), ("slow", True, 1, 1.0, 41), ("slow", True, 1, 6.0, 42),
        ("fine", True, 1, 1.0, 40), ("fine", False, 0, 1.0, 41), ("fine", True, 1, 2.0, 42),
        ("down", True, 1, 1.0, 1), ("down", False, 0, 1.0, 2), ("down", False, 0, 1.0, 3),
        ("down", False, 0, 1.0, 4), ("never", False, 0, 1.0, 42),
    )
    now = F.lit("2024-01-02 19:00:00").cast("timestamp_ntz")
    assert rows(report.load_alerts(runs, now), "table_name", "alert") == [
        ("down", "failed_after_retries"), ("down", "no_recent_load"), ("never", "no_recent_load"),
        ("slow", "slow_load"),
    ]


def test_summary_and_metrics(spark):
    runs = log(spark, ("a", True, 90, 1.5, 1), ("b", False, 0, 0.5, 2), ("c", True, 10, 0.0, 3))
    found = report.run_summary(runs).first()
    assert (found["tables_processed"], found["failed_tables"], found["total_records"]) == (3, 1, 100)
    assert (found["records_per_second"], found["scd_tables"], found["all_successful"]) == (50.0, 3, False)
    clicks = runs.withColumn("table_type", F.lit("append"))
    assert report.run_summary(clicks).first()["append_tables"] == 3
    metrics = {r["table_name"]: r for r in report.load_metrics(runs).collect()}
    assert metrics["b"]["success_rate"] == 0.0 and metrics["b"]["mean_duration"] is None


def test_status(spark):
    states = spark.createDataFrame([("a", "5"), ("b", "7")], "table_name string, last_value string")
    pending = spark.createDataFrame([("a", 3)], "table_name string, n_pending bigint")
    prints = spark.createDataFrame(
        [("a", "1", "1"), ("b", "1", "2")],
        "table_name string, stored_fingerprint string, target_fingerprint string",
    )
    assert rows(report.pipeline_status(states, pending, prints)) == [
        ("a", "5", 3, "consistent"), ("b", "7", None, "inconsistent"),
    ]


def test_boundaries_of_a_table(spark):
    from tidemark.operators import partitions

    values = [(v,) for v in (None, -5, 0, 1, 10, 10, 11, 99_999, 200_000)]
    df = spark.createDataFrame(values, "v int")
    edges = spark.range(0, 100_000).select(F.col("id").cast("int").alias("edge"))
    edges = edges.union(spark.createDataFrame([(0,), (None,)], "edge int"))
    numbered = partitions.partition_numbers_by(df, "v", edges)
    assert "100000" not in numbered._jdf.queryExecution().optimizedPlan().toString().replace("Range (0, 100000", "")
    assert rows(numbered) == sorted(
        [(None, 1, None), (-5, 1, 1), (0, 1, 2), (1, 1, 3), (10, 2, 12), (11, 1, 13), (99_999, 1, 100_001), (200_000, 1, 100_001)],
        key=repr,
    )
    few = partitions.partition_numbers(df.where("v is not null"), "v", [0, 10])
    same = partitions.partition_numbers_by(df.where("v is not null"), "v", spark.createDataFrame([(10,), (0,)], "b int"))
    assert rows(same) == rows(few)


def test_column_sets_that_identify_rows(spark):
    from tidemark.operators import quality

    data = [(i, i % 2, i // 2, None if i == 3 else str(i), "x") for i in range(8)]
    df = spark.createDataFrame(data, "id int, a int, b int, n string, c string")
    found = {r.key_columns: r for r in quality.column_profile(df, 4).collect()}
    assert {k for k, r in found.items() if r.is_key} == {"id"} and len(found) == 5
    assert {k for k, r in found.items() if r.can_partition} == {"a", "b"}
    assert (found["n"].n_nulls, found["n"].n_values, found["c"].largest) == (1, 8, 8)
    assert rows(quality.unique_column_sets(df)) == [("a,b", 8), ("id", 8)]
    wide = df.select("*", *[F.lit(i).alias(f"w{i}") for i in range(40)])
    assert quality.column_profile(wide).where("is_key").count() == 1
    assert quality.column_profile(df.limit(0)).count() == 0
    plan = quality.set_profile(df, [["id"], ["a", "b"]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Exchange") == 2
