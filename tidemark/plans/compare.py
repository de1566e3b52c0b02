"""Copies of a partitioned table, compared by checksums that are kept beside their files.

A folder that a manifest names is never written again, so its checksums are taken once. Loads
that replace a few partitions cost the sums of those; comparing two copies reads sums, and
rows only of the partitions and buckets where the sums differ.

    <root>/<table>/sums/<part>      sums per folder and bucket, append only
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PartitionTable
from tidemark.operators import checksums, static
from tidemark.operators.checksums import BUCKETS
from tidemark.operators.ordered import join_null_safe
from tidemark.plans import jobs
from tidemark.sinks.store import LOAD_KEY, PARTITIONS, CheckFailed, Store

_KEPT = (
    T.StructType()
    .add("folder", "string")
    .add("bucket", "integer")
    .add("row_count", "long")
    .add("fingerprint", "string")
    .add("kind", "string")
)


def _columns(schema: T.StructType) -> list[str]:
    """In the order of their names: copies may have taken up columns in different order."""
    return sorted(schema.names)


def _kind(schema: T.StructType, keys: Sequence[str], buckets: int) -> str:
    """What sums mean: sums of another schema, key or number of buckets are not theirs."""
    fields = [(f, schema[f].dataType.simpleString()) for f in _columns(schema)]
    return hashlib.sha256(repr((fields, list(keys), buckets)).encode()).hexdigest()


def kept_sums(
    store: Store, table: str, keys: Sequence[str], part: str = PARTITIONS, buckets: int = BUCKETS
) -> DataFrame | None:
    """value, folder, bucket, row_count and fingerprint of the newest snapshot; None before the
    first load. Sums that are not kept yet are taken and kept: call it after a load."""
    entries = store.snapshot(table, part)
    schema = store.schema(table, part)
    if entries is None or schema is None:
        return None
    kind = _kind(schema, keys, buckets)

    def known() -> DataFrame | None:
        kept = store.kept_sums(table, part, _KEPT)
        # sums that two processes took at once are equal
        return None if kept is None else kept.where(F.col("kind") == kind).drop("kind").distinct()

    have, lacking = known(), entries
    if have is not None:
        # sums of a write that broke off do not add up to the rows of their folder
        whole = have.groupBy("folder").agg(F.sum("row_count").alias("records"))
        lacking = entries.join(whole, ["folder", "records"], "left_anti")
    folders = [row["folder"] for row in lacking.select("folder").collect()]  # names of partitions
    if folders:
        column = schema.names[-1]
        rows = store.rows_by_load(table, part, folders, schema)
        sums = checksums.bucket_sums(rows, keys, _columns(schema), buckets, by=[column, LOAD_KEY])
        place = lacking.select(F.col("value").alias(column), F.col("load").alias(LOAD_KEY), "folder")
        store.keep_sums(
            sums.join(place, [column, LOAD_KEY])
            .select("folder", "bucket", "row_count", "fingerprint")
            .withColumn("kind", F.lit(kind)),
            table,
            part,
        )
        have = known()
    if have is None:
        have = store.spark.createDataFrame([], T.StructType(_KEPT.fields[:-1]))
    return entries.select("value", "folder").join(have, "folder").select("value", *have.columns)


def _both(
    left: Store, right: Store, table: str, keys: Sequence[str], part: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    schemas = [store.schema(table, part) for store in (left, right)]
    if None in schemas:
        raise CheckFailed(f"{table}: one of the copies was never loaded")
    if len({_kind(s, keys, buckets) for s in schemas}) > 1:
        raise CheckFailed(f"{table}: the copies differ in columns or types")
    return tuple(kept_sums(s, table, keys, part, buckets) for s in (left, right))


def differing_values(
    left: Store, right: Store, table: str, keys: Sequence[str], part: str = PARTITIONS, buckets: int = BUCKETS
) -> DataFrame:
    """value, left_rows, right_rows of the partitions whose content differs."""
    sums = [checksums.rolled_up(s, ["value"]) for s in _both(left, right, table, keys, part, buckets)]
    return checksums.differing_sums(*sums, ["value"])


def differing_buckets(
    left: Store, right: Store, table: str, keys: Sequence[str], part: str = PARTITIONS, buckets: int = BUCKETS
) -> DataFrame:
    """value, bucket, left_rows, right_rows where the copies differ, from their sums alone."""
    return checksums.differing_buckets(*_both(left, right, table, keys, part, buckets), ["value"])


def differing_keys(
    left: Store, right: Store, table: str, keys: Sequence[str], part: str = PARTITIONS, buckets: int = BUCKETS
) -> DataFrame:
    """Partition, keys, rows on each side and action that would make the right copy like the left.

    Rows are read of the partitions that differ, and compared in the buckets that differ.
    """
    found = differing_buckets(left, right, table, keys, part, buckets).select("value", "bucket")
    schema = left.schema(table, part)
    column = schema.names[-1]

    def suspects(store: Store) -> DataFrame:
        rows = store.partitions(table, part, found.select("value").distinct())
        marked = rows.withColumn("_bucket_of_key", checksums.key_bucket(rows, keys, buckets))
        wanted = found.select(F.col("value").alias(column), F.col("bucket").alias("_bucket_of_key"))
        return join_null_safe(marked, wanted, [column, "_bucket_of_key"], "left_semi").drop("_bucket_of_key")

    own = [column, *[k for k in keys if k != column]]
    diff = static.table_diff(suspects(left), suspects(right), own, _columns(schema))
    return diff.where(F.col("action") != static.SAME)


def copy_differing_partitions(
    origin: Store,
    destination: Store,
    table: PartitionTable,
    keys: Sequence[str],
    now: dt.datetime | None = None,
    buckets: int = BUCKETS,
) -> jobs.Outcome:
    """Make one copy like the other: partitions that differ are replaced, those that the origin
    lacks go. Equal copies are told from their sums and nothing is loaded."""
    if origin.snapshot(table.table) is None:
        return jobs.nothing("nothing_to_copy")
    if destination.snapshot(table.table) is None:
        return jobs.copy_missing_partitions(origin, destination, table, now)
    values = differing_values(origin, destination, table.table, keys, buckets=buckets).select("value")
    listed = [row["value"] for row in values.collect()]  # names of partitions
    if not listed:
        return jobs.nothing("consistent")
    rows = origin.partitions(table.table, values=values)
    return jobs.backfill_partition_table(destination, table, rows, values=listed, now=now)
