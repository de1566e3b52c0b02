"""Clustered rows: the same rows, and fewer row groups to read for either column."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.config import AppendTable
from tidemark.operators.layout import clustered
from tidemark.plans import jobs
from tidemark.sinks.store import Store


def groups_to_read(folder: str, column: str, low, high) -> tuple[int, int]:
    """Row groups whose statistics meet a range, and all row groups."""
    hit = every = 0
    for file in Path(folder).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            (stats,) = [c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column]
            every += 1
            hit += stats.min <= high and stats.max >= low
    return hit, every


def test_fewer_row_groups_on_both_columns(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 4).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("a"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int")).alias("day"),
        "id",
    )
    plain, curve = str(tmp_path / "plain"), str(tmp_path / "curve")
    for df, folder in ((rows, plain), (clustered(rows, ["a", "day"]), curve)):
        df.write.option("parquet.block.size", "16384").option("parquet.block.size.row.check.min", "500").option(
            "parquet.page.size.row.check.max", "500"
        ).option("maxRecordsPerFile", "2000").parquet(folder)
    assert sorted(map(tuple, spark.read.parquet(curve).collect())) == sorted(map(tuple, rows.collect()))
    day = dt.date(2020, 6, 1)
    for column, value in (("a", 500), ("day", day)):
        hit, every = groups_to_read(plain, column, value, value)
        assert hit == every
        hit, every = groups_to_read(curve, column, value, value)
        assert hit < 0.5 * every


def test_odd_rows_stay(spark):
    rows = spark.createDataFrame(
        [(None, 1.0, "x"), (1, float("nan"), None), (1, None, "x"), (1, 2.0, "x"), (1, 2.0, "x")], "a int, b double, c string"
    )
    key = lambda df: sorted(map(str, df.collect()))
    assert key(clustered(rows, ["a", "b"])) == key(rows)
    assert clustered(rows.limit(0), ["a"]).count() == 0
    for bad in (["c"], []):
        with pytest.raises(ValueError):
            clustered(rows, bad)


def test_append_load_in_clustered_order(spark, tmp_path):
    table = AppendTable("clicks", "at", cluster=("at", "size"))
    rows = spark.range(2_000).selectExpr("id as at", "cast(pmod(xxhash64(id), 100) as int) as size")
    store = Store(spark, str(tmp_path))
    jobs.load_append_table(store, table, rows.where("at < 1500"))
    jobs.load_append_table(store, table, rows)
    found = store.read("clicks", jobs.DATA)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    assert [r["records"] for r in store.log_rows("clicks")] == [1500, 500]
    assert store.log_rows("clicks")[-1]["last_value"] == "1999"
