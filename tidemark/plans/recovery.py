"""Put the load log and the files in step before a load, or rebuild a table from its other copy.

The log says what was published, the files what is there. Where they differ, the least
that both agree on counts: loads whose files are gone or short are taken back together
with all that came after them, and the next load reads the source again from there.
What the files hold is read off their footers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import AppendTable, PartitionTable, Scd2Table, StaticTable, TableConfig
from tidemark.operators import watermark
from tidemark.plans.jobs import CURRENT, DATA, HISTORY, _publish_versions, new_load_id, utc_now, versioned_rows
from tidemark.sinks.store import APPEND, PARTITIONS, REPLACE, SWITCH, CheckFailed, Store

#: Types whose least and greatest value Parquet keeps exactly in its footers.
IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)
LOADS_DIR, MANIFESTS_DIR = "load_id", "tidemark_load"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts, least and greatest values of
    Parquet files are answered from their footers."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def stored_state(
    store: Store, table: str, part: str, schema: T.StructType, column: str | None = None
) -> DataFrame:
    """folder, records and, of a column, low and high of every load whose files are there,
    whether the log knows it or not.

    Row groups are not read where the column's type allows it.
    """
    spark = footer_session(store.spark)
    kept = [f for f in schema if f.name == column]
    read = T.StructType([*kept, T.StructField(LOADS_DIR, T.StringType())])
    rows = spark.read.schema(read).parquet(store.path(table, part))
    found = [F.count(F.lit(1)).alias("records")]
    if kept:
        found += [F.min(column).alias("low"), F.max(column).alias("high")]
    return rows.groupBy(F.col(LOADS_DIR).alias("folder")).agg(*found)


def detected_mark(store: Store, table: str, part: str, schema: T.StructType, column: str):
    """The greatest value of a column in the files of a part, without the log; None if there
    are none."""
    if not _folders(store, table, part, LOADS_DIR):
        return None
    return stored_state(store, table, part, schema, column).agg(F.max("high").alias("high")).first()["high"]


def _folders(store: Store, table: str, part: str, key: str) -> set[str]:
    """Names of the load folders of a part that hold a finished write."""
    spark = store.spark
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(store.path(table, part))
    fs = base.getFileSystem(conf)
    if not fs.exists(base):
        return set()
    names = (s.getPath() for s in fs.listStatus(base) if s.isDirectory())
    done = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return {n.removeprefix(f"{key}=") for n in done if n.startswith(f"{key}=")}


def _present(store: Store, table: str, part: str, schema: T.StructType) -> dict[str, int]:
    """Stored rows of each load of a part: one entry a load."""
    there = _folders(store, table, part, LOADS_DIR)
    if not there:
        return {}
    found = {r["folder"]: r["records"] for r in stored_state(store, table, part, schema).collect()}
    return {folder: found.get(folder, 0) for folder in there}


def _needed(log: Sequence) -> list:
    """Of the log rows of one part, oldest first, those whose files readers need."""
    since = max((i for i, r in enumerate(log) if r["mode"] == REPLACE), default=0)
    return list(log[since:])


def _broken_manifest(store: Store, table: str, part: str) -> DataFrame | None:
    """Manifest rows whose files are gone or short; None if the part has no manifest."""
    entries = store.snapshot(table, part)
    if entries is None:
        return None
    there = _folders(store, table, part, MANIFESTS_DIR)
    loads = [r["load"] for r in entries.select("load").distinct().collect()]
    schema = store.schema(table, part)
    stored = store.stored_entries(table, part, [x for x in loads if x in there], schema)
    stored = stored.select("folder", F.col("records").alias("_stored"))
    joined = entries.join(stored, "folder", "left")
    return joined.where(F.coalesce(F.col("_stored"), F.lit(0)) != F.col("records")).drop("_stored")


def recover(
    store: Store, table: TableConfig, now: dt.datetime | None = None, other: Store | None = None
) -> list[tuple[str, str]]:
    """Bring the log of a table in line with its files; returns (load, what was done) pairs.

    * Partitions whose files are gone or short leave the manifest, so that the next load finds
      them missing.
    * Of other tables the first load that lacks files is taken back, and all after it.
    * Loads of an append table that the log has lost are entered again if their values lie
      apart from those of every published load; a failed attempt, whose rows were read again by
      a later load, overlaps that load and stays out.
    * With ``other``, a copy that knows less of an append table, loads above the least mark
      that log, files and copy agree on are taken back.
    """
    now = now or utc_now()
    if isinstance(table, PartitionTable):
        return _recover_partitions(store, table, now)
    done = _take_back(store, table, now)
    if isinstance(table, AppendTable):
        done += _adopt(store, table, now)
        done += _agree(store, table, now, other)
    return done


def _recover_partitions(store: Store, table: PartitionTable, now: dt.datetime) -> list[tuple[str, str]]:
    name = table.table
    broken = _broken_manifest(store, name, PARTITIONS)
    if broken is None or broken.isEmpty():
        return []
    load_id = f"lost-{new_load_id()}"
    lost = [(str(r["value"]), "partition lost") for r in broken.collect()]
    store.drop_entries(name, broken, load_id, table.kind, now)
    return lost


def _first_broken(store: Store, table: TableConfig) -> str | None:
    """The folder of the oldest needed load that lacks files."""
    rows = store.log_rows(table.table)
    order = {r["folder"]: i for i, r in reversed(list(enumerate(rows)))}
    broken = []
    for part in (DATA, HISTORY, CURRENT):
        log = [r for r in rows if r["part"] == part]
        if not log:
            continue
        if log[-1]["mode"] == SWITCH:
            found = _broken_manifest(store, table.table, part)
            broken += [r["load"] for r in found.select("load").distinct().collect()]
            continue
        there = _present(store, table.table, part, store.schema(table.table, part))
        broken += [r["folder"] for r in _needed(log) if there.get(r["folder"], -1) != r["records"]]
    return min(broken, key=lambda f: order.get(f, -1)) if broken else None


def _take_back(store: Store, table: TableConfig, now: dt.datetime) -> list[tuple[str, str]]:
    done = []
    while (folder := _first_broken(store, table)) is not None:
        rows = store.log_rows(table.table)
        loads = list(dict.fromkeys((r["folder"], r["load_id"]) for r in rows))
        start = next(i for i, (f, _) in enumerate(loads) if f == folder)
        for _, load_id in reversed(loads[start:]):
            store.undo(table.table, load_id, now)
            done.append((load_id, "taken back"))
    return done


def _adopt(store: Store, table: AppendTable, now: dt.datetime) -> list[tuple[str, str]]:
    """Enter loads again that the log has lost."""
    name, column = table.table, table.watermark_column
    there = _folders(store, name, DATA, LOADS_DIR)
    logged = {r["folder"] for r in store.logged_folders(name, DATA)}
    orphans = there - logged
    if not orphans:
        return []
    schema = store.schema(name, DATA)
    if schema is None:  # the whole log is gone: the files say what they hold
        schema = store.spark.read.option("mergeSchema", "true").parquet(store.path(name, DATA)).drop(LOADS_DIR).schema
    state = {r["folder"]: r for r in stored_state(store, name, DATA, schema, column).collect()}
    published = [state[f] for f in logged if f in state and state[f]["low"] is not None]
    done = []
    rows = sorted((state[f] for f in orphans if f in state and state[f]["low"] is not None), key=lambda r: (r["low"], r["folder"]))
    for row in rows:
        if any(row["low"] <= p["high"] and p["low"] <= row["high"] for p in published):
            continue
        if published and logged and row["low"] > max(p["high"] for p in published):
            continue  # above the mark: the next load reads these rows in any case
        store.enter(name, table.kind, DATA, row["folder"], row["records"], column, schema, now)
        published.append(row)
        done.append((row["folder"], "entered again"))
    return done


def _agree(store: Store, table: AppendTable, now: dt.datetime, other: Store | None) -> list[tuple[str, str]]:
    """Take back loads above the least mark that log, files and the other copy know."""
    name, column = table.table, table.watermark_column
    schema = store.schema(name, DATA)
    if schema is None:
        return []
    least = reconciled_mark(store, table, other)
    done = []
    while least is not None:
        mark = store.mark(name, DATA, schema[column].dataType)
        above = store.spark.range(1).select(
            (F.lit(mark).cast(schema[column].dataType) > F.lit(least).cast(schema[column].dataType)).alias("above")
        )
        if mark is None or not above.first()["above"]:
            return done
        newest = store.state(name)["load_id"]
        store.undo(name, newest, now)
        done.append((newest, "taken back"))
    return done


def reconciled_mark(store: Store, table: AppendTable, other: Store | None = None) -> str | None:
    """The least mark of an append table that its log, its files and a second copy know."""
    name, column = table.table, table.watermark_column
    kind = store.schema(name, DATA)[column].dataType
    marks = [("log", store.mark(name, DATA, kind)), ("files", store.read(name, DATA).agg(F.max(column).cast("string")).first()[0])]
    if other is not None and other.schema(name, DATA) is not None:
        marks.append(("copy", other.mark(name, DATA, kind)))
    rows = store.spark.createDataFrame([(name, o, v) for o, v in marks], "table_name string, origin string, last_value string")
    found = watermark.reconcile_state(rows.withColumn("last_value", F.col("last_value").cast(kind))).first()
    return None if found["last_value"] is None else str(found["last_value"])


def copy_table(
    origin: Store, destination: Store, table: TableConfig, now: dt.datetime | None = None
) -> tuple[str, int]:
    """Rebuild a versioned, reference or append table from its other copy, as one load.

    The mark and the content fingerprint come along, so the next load goes on from there.
    """
    name, now, load_id = table.table, now or utc_now(), new_load_id()
    state = origin.state(name)
    if state is None:
        return "nothing_to_copy", 0
    if isinstance(table, Scd2Table):
        rows = versioned_rows(origin, table)
        _publish_versions(destination, table, rows, REPLACE, load_id, now, "recovered", state["last_value"])
        return "recovered", destination.published(name, load_id)[1]
    if not isinstance(table, (StaticTable, AppendTable)):
        raise CheckFailed(f"{name}: copy_missing_partitions rebuilds partition tables")
    mark = table.watermark_column if isinstance(table, AppendTable) else None
    written = destination.write(origin.read(name, DATA), name, DATA, load_id, REPLACE, mark)
    destination.publish(name, table.kind, [written], now, "recovered", state["last_hash"])
    return "recovered", written.records
