"""Copies of a table compared by kept checksums: what is read, what is found, what is mended."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.config import PartitionTable
from tidemark.functions import canonical
from tidemark.operators import checksums
from tidemark.plans import compare, jobs
from tidemark.sinks.store import CheckFailed, Store

FACTS = PartitionTable("facts", "day")
KEYS = ["id"]


def facts(spark, *days, n=40):
    data = [(i, f"v{i}", day) for day in days for i in range(n)]
    return spark.createDataFrame(data, "id int, v string, day int")


def change(df, day, key):
    hit = (F.col("day") == day) & (F.col("id") == key)
    return df.withColumn("v", F.when(hit, F.lit("changed")).otherwise(F.col("v")))


@pytest.fixture
def copies(spark, store, tmp_path, at):
    other = Store(spark, str(tmp_path / "other"))
    for place in (store, other):
        jobs.load_partition_table(place, FACTS, facts(spark, 1, 2, 3), load_id="L1", now=at(0))
        compare.kept_sums(place, "facts", KEYS)
    return store, other


def lose_rows(store, *days):
    """Make data files unreadable, so that a plan that opens them fails."""
    for path in Path(store.root, "facts", "partitions").rglob("*.parquet"):
        if any(f"day={d}/" in str(path) for d in days):
            path.write_bytes(b"not parquet")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)


def test_sums_of_buckets_add_up_to_the_table(spark):
    df = facts(spark, 1, 2).union(spark.createDataFrame([(None, None, None), (None, None, None)], "id int, v string, day int"))
    sums = checksums.bucket_sums(df, KEYS, buckets=7, by=["day"])
    whole = checksums.rolled_up(sums, []).select("row_count", "fingerprint")
    assert rows(whole) == rows(canonical.table_fingerprint(df))
    by_day = checksums.rolled_up(sums, ["day"])
    assert rows(by_day) == rows(canonical.table_fingerprint(df, by=["day"]))


def test_differing_buckets_are_exactly_those_of_changed_keys(spark):
    left = facts(spark, 1, 2, None)
    right = change(left, 2, 5).where("not (day is null and id = 7)")
    found = checksums.differing_buckets(
        *[checksums.bucket_sums(x, KEYS, buckets=1000, by=["day"]) for x in (left, right)], ["day"]
    )
    bucket = {r["id"]: r["b"] for r in left.select("id", checksums.key_bucket(left, KEYS, 1000).alias("b")).collect()}
    assert {(r["day"], r["bucket"]) for r in found.collect()} == {(2, bucket[5]), (None, bucket[7])}


def test_equal_copies_compare_without_reading_rows(copies):
    for place in copies:
        lose_rows(place, 1, 2, 3)
    assert compare.differing_buckets(*copies, "facts", KEYS).isEmpty()
    assert compare.differing_values(*copies, "facts", KEYS).isEmpty()
    assert compare.differing_keys(*copies, "facts", KEYS).isEmpty()


def test_one_changed_row_is_found_in_its_partition_and_bucket(spark, copies, at):
    left, right = copies
    jobs.backfill_partition_table(right, FACTS, change(facts(spark, 1, 2, 3), 2, 5), values=[2], now=at(1))
    compare.kept_sums(right, "facts", KEYS)
    for place in copies:  # only the partition that differs may be read
        lose_rows(place, 1, 3)
    buckets = compare.differing_buckets(*copies, "facts", KEYS)
    of_key = facts(spark, 2)
    of_key = of_key.withColumn("bucket", checksums.key_bucket(of_key, KEYS))
    (bucket,) = of_key.where("id = 5").select("bucket").first()
    n = of_key.where(F.col("bucket") == bucket).count()
    assert rows(buckets) == [(2, bucket, n, n)]
    found = compare.differing_keys(*copies, "facts", KEYS)
    assert rows(found) == [(2, 5, 1, 1, "update")]


def test_sums_are_taken_of_new_folders_only(spark, copies, at):
    left, _ = copies
    jobs.backfill_partition_table(left, FACTS, change(facts(spark, 2), 2, 5), values=[2], now=at(1))
    lose_rows(left, 1, 3)
    sums = compare.kept_sums(left, "facts", KEYS)
    assert rows(checksums.rolled_up(sums, ["value"]).select("value", "row_count")) == [(1, 40), (2, 40), (3, 40)]


def test_sums_of_a_broken_write_are_taken_again(spark, copies):
    left, right = copies
    files = sorted(Path(left.root, "facts", "sums").rglob("*.parquet"))
    files[0].unlink()
    assert compare.differing_buckets(left, right, "facts", KEYS).isEmpty()
    sums = compare.kept_sums(left, "facts", KEYS)
    assert checksums.rolled_up(sums, []).first()["row_count"] == 120


def test_sums_follow_the_schema(spark, copies, at):
    left, right = copies
    wider = facts(spark, 4).withColumn("extra", F.lit(1))
    jobs.load_partition_table(left, FACTS, wider, now=at(1))
    with pytest.raises(CheckFailed, match="differ in columns"):
        compare.differing_buckets(left, right, "facts", KEYS)
    jobs.load_partition_table(right, FACTS, wider, now=at(1))
    assert compare.differing_buckets(left, right, "facts", KEYS).isEmpty()


def test_a_copy_becomes_like_its_origin(spark, copies, at):
    left, right = copies
    wrong = change(facts(spark, 1, 2, 3), 2, 5).union(facts(spark, 9))
    jobs.backfill_partition_table(right, FACTS, wrong, values=[2, 9], now=at(1))
    assert compare.copy_differing_partitions(left, right, FACTS, KEYS, at(2)) == ("backfill", 40)
    assert rows(right.partitions("facts")) == rows(left.partitions("facts"))
    assert compare.copy_differing_partitions(left, right, FACTS, KEYS, at(3)) == ("consistent", 0)


def test_copies_before_their_first_load(spark, store, tmp_path, at):
    other = Store(spark, str(tmp_path / "other"))
    with pytest.raises(CheckFailed, match="never loaded"):
        compare.differing_values(store, other, "facts", KEYS)
    assert compare.copy_differing_partitions(store, other, FACTS, KEYS) == ("nothing_to_copy", 0)
    jobs.load_partition_table(store, FACTS, facts(spark, 1), now=at(0))
    assert compare.copy_differing_partitions(store, other, FACTS, KEYS, at(1))[1] == 40
    assert compare.differing_values(store, other, "facts", KEYS).isEmpty()


def test_all_partitions_gone(spark, copies, at):
    left, right = copies
    jobs.backfill_partition_table(left, FACTS, facts(spark, 1).limit(0), values=[1, 2, 3], now=at(1))
    found = compare.differing_values(left, right, "facts", KEYS)
    assert rows(found) == [(1, 0, 40), (2, 0, 40), (3, 0, 40)]
