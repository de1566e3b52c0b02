"""Where loads are written, and the log that makes them visible.

Plain Parquet cannot update rows, and overwriting a path that the same plan reads loses
data. So a load writes into folders of its own and becomes visible with one appended row
set in the load log. Before that nothing of it is seen, and a load that is run again after
a failure writes its folders anew. Folders of a published load are never written again.

Partitioned parts have a manifest with every load: which folder holds each partition. A
load writes its own partitions and a manifest that takes over the other ones, so replacing,
removing and rolling back partitions moves no rows, and a reader keeps the snapshot it began
with until ``expire`` removes what newer manifests no longer name.

    <root>/_loads                                        the load log, append only
    <root>/<table>/<part>/load_id=<folder>               rows of one load
    <root>/<table>/<part>/tidemark_load=<folder>/<column>=<value>   partitions of one load
    <root>/<table>/manifests/<part>/<folder>             all partitions after one load
    <root>/<table>/manifests/<part>/<folder>.staged      the partitions of that load alone
    <root>/<table>/sums/<part>                           checksums of partition folders, append only
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.canonical import fingerprint, row_number60
from tidemark.operators.layout import clustered
from tidemark.operators.schema import in_schema, merged_schema, type_conflicts

LOADS = (
    "table_name string, table_type string, part string, mode string, load_id string, "
    "updated_at timestamp_ntz, reason string, records bigint, last_value string, "
    "last_hash string, schema_json string, folder string, base string, undoes string"
)
PARTITIONS = "partitions"
APPEND, REPLACE, SWITCH, UNDO = "append", "replace", "switch", "undo"
#: The directory level that names the load of a partition folder.
LOAD_KEY = "tidemark_load"


class CheckFailed(RuntimeError):
    """A staged load does not meet its checks and was not published."""


@dataclass(frozen=True)
class Written:
    """What one write produced; counted during the write, without a second scan."""

    part: str
    mode: str
    load_id: str
    records: int
    last_value: str | None
    content: str | None
    schema_json: str
    folder: str
    base: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))


def _observed(seen: Observation, df: DataFrame) -> dict:
    """What a write counted. Spark folds a plan that it knows to be empty together with
    its metrics; such a write had no rows."""
    try:
        return seen.get
    except Py4JJavaError:
        if not df.isEmpty():
            raise
        return {"records": 0}


class Store:
    """Published tables under one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        compression: str = "zstd",
        row_group_bytes: int = 128 * 1024 * 1024,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_options = {
            "compression": compression,
            "parquet.block.size": str(row_group_bytes),
        }

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # ---- the load log -------------------------------------------------------

    def _log(self, table: str | None = None) -> DataFrame:
        """Every row ever logged."""
        schema = T.StructType.fromDDL(LOADS)
        rows = self._read_if_there(self.path("_loads"), schema)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows if table is None else rows.where(F.col("table_name") == table)

    def loads(self, table: str | None = None) -> DataFrame:
        """Rows of the load log without loads that were undone, each load once even if it was
        published twice."""
        log = self._log(table).dropDuplicates(["table_name", "part", "folder"])
        undone = log.where("undoes is not null").select(
            "table_name", F.col("undoes").alias("folder")
        ).distinct()
        return log.where(F.col("mode") != UNDO).join(undone, ["table_name", "folder"], "left_anti")

    def log_rows(self, table: str) -> list[Row]:
        """What ``loads`` has of one table, oldest first: a row for each load and part.

        These are names and counts of loads. One scan of the log without a shuffle answers
        every question about a table, which DataFrame steps would each ask anew.
        """
        schema = T.StructType.fromDDL(LOADS)
        log = self._read_if_there(self.path("_loads"), schema)
        rows = [] if log is None else log.where(F.col("table_name") == table).collect()
        rows.sort(key=lambda r: (r["updated_at"], r["folder"], r["part"]))
        undone = {r["undoes"] for r in rows if r["undoes"] is not None}
        known = {
            (r["part"], r["folder"]): r
            for r in reversed(rows)
            if r["mode"] != UNDO and r["folder"] not in undone
        }
        return list(known.values())[::-1]

    def state(self, table: str) -> Row | None:
        """The newest log row of a table, or None."""
        rows = self.log_rows(table)
        if not rows:
            return None
        newest = (rows[-1]["updated_at"], rows[-1]["folder"])
        return next(r for r in rows if (r["updated_at"], r["folder"]) == newest)

    def published(self, table: str, load_id: str) -> tuple[str, int] | None:
        """Reason and rows of a published load; None if no such load is published."""
        rows = [r for r in self.log_rows(table) if r["load_id"] == load_id]
        if not rows:
            return None
        return min(r["reason"] or "" for r in rows), sum(r["records"] for r in rows)

    def _folder(self, table: str, load_id: str) -> str:
        """The folder of a load that is about to be written.

        A load that was undone may be run again: it gets a folder of its own, since readers
        may still hold the former one.
        """
        log = self._log(table).select("load_id", "folder", "undoes")
        rows = log.where((F.col("load_id") == load_id) | F.col("undoes").isNotNull()).collect()
        before = {r["folder"] for r in rows if r["load_id"] == load_id}
        if before - {r["undoes"] for r in rows}:
            raise CheckFailed(f"{table}: load {load_id} is published already")
        return f"{load_id}.{len(before)}" if before else load_id

    def publish(
        self,
        table: str,
        table_type: str,
        written: Sequence[Written],
        now: dt.datetime,
        reason: str,
        last_hash: str | None = None,
        undoes: str | None = None,
    ) -> None:
        """Make the parts of one load visible together."""
        rows = [
            (
                table,
                table_type,
                w.part,
                w.mode,
                w.load_id,
                now,
                reason,
                w.records,
                w.last_value,
                last_hash,
                w.schema_json,
                w.folder,
                w.base,
                undoes,
            )
            for w in written
        ]
        log = self.spark.createDataFrame(rows, LOADS).coalesce(1)
        log.write.mode("append").parquet(self.path("_loads"))

    def undo(self, table: str, load_id: str, now: dt.datetime) -> None:
        """Take back the newest load of a table whose parts are written load by load.

        What it replaced is visible again, and its id may be used again. An older load
        cannot be taken back: newer ones were made from its rows.
        """
        rows = self.log_rows(table)
        found = next((r for r in rows if r["load_id"] == load_id), None)
        if found is None:
            raise ValueError(f"{table} has no published load {load_id}")
        if rows[-1]["folder"] != found["folder"]:
            raise CheckFailed(f"{table}: load {load_id} is not the newest one")
        row = Written(found["part"], UNDO, f"undo-{found['folder']}", 0, None, None, found["schema_json"], f"undo-{found['folder']}")
        self.publish(table, found["table_type"], [row], now, "rolled_back", undoes=found["folder"])

    def mark(self, table: str, part: str, kind: T.DataType) -> str | None:
        """The highest published mark of a part, compared as values of a type."""
        values = [(r["last_value"],) for r in self.log_rows(table) if r["part"] == part and r["last_value"] is not None]
        if not values:
            return None
        marks = self.spark.createDataFrame(values, "v string")
        return marks.agg(F.max(F.col("v").cast(kind)).cast("string")).first()[0]

    def schema(self, table: str, part: str) -> T.StructType | None:
        """The schema of the newest load of a part, None before the first."""
        rows = [r for r in self.log_rows(table) if r["part"] == part]
        return T.StructType.fromJson(json.loads(rows[-1]["schema_json"])) if rows else None

    def fitted(self, df: DataFrame, table: str, part: str) -> DataFrame:
        """df with the columns and types of the published part, and its own new columns.

        New columns and wider types are taken over, also for the rows that are published:
        columns that older files lack are null. Any other change of type fails here, before
        a file is written that the published schema could not read.
        """
        have = self.schema(table, part)
        if have is None:
            return df
        issues = type_conflicts(have, df.schema)
        if issues:
            raise CheckFailed(f"{table}: the schema does not fit the published one: {issues}")
        return in_schema(df, merged_schema(have, df.schema))

    # ---- parts written load by load ----------------------------------------

    def write(
        self,
        df: DataFrame,
        table: str,
        part: str,
        load_id: str,
        mode: str,
        mark: str | None = None,
        content: Sequence[str] | None = None,
        algorithm: str = "hashbytes_sha256",
        required: Sequence[str] = (),
        cluster: Sequence[str] = (),
    ) -> Written:
        """Write the rows of one load; ``publish`` makes them visible.

        Counts the rows, the highest ``mark`` value and the fingerprint of the ``content``
        columns on the way. A null in a ``required`` column fails the load. ``cluster`` orders
        the rows so that readers skip row groups on each of these columns; it costs a range
        shuffle and reads of ``df`` for its bounds and sample.
        """
        folder = self._folder(table, load_id)
        df = self.fitted(df, table, part)
        if cluster:
            df = clustered(df, cluster)
        seen = Observation()
        watched = df
        metrics = [F.count(F.lit(1)).alias("records")]
        if mark is not None:
            metrics.append(F.max(mark).cast("string").alias("last_value"))
        if content is not None:
            watched = df.withColumn("_number", row_number60(df, content, algorithm))
            metrics.append(fingerprint(F.col("_number")).alias("content"))
        for name in required:
            metrics.append(F.count_if(F.col(name).isNull()).alias(f"null {name}"))
        observed = watched.observe(seen, *metrics).select(*df.columns)
        self._write(observed, self.path(table, part, f"load_id={folder}"))
        found = _observed(seen, df)
        empty = {c: n for c in required if (n := found.get(f"null {c}"))}
        if empty:
            raise CheckFailed(f"{table}: rows without a value in {empty}")
        return Written(
            part,
            mode,
            load_id,
            found["records"],
            found.get("last_value"),
            found.get("content"),
            df.schema.json(),
            folder,
        )

    def read_load(self, table: str, written: Written) -> DataFrame:
        """The rows of one write, published or not."""
        folder = self.path(table, written.part, f"load_id={written.folder}")
        return self.spark.read.schema(written.schema).parquet(folder)

    def read(self, table: str, part: str) -> DataFrame | None:
        """Visible rows of a part: the newest replacing load and the appends since."""
        rows = [r for r in self.log_rows(table) if r["part"] == part]
        if not rows:
            return None
        visible = rows[max((i for i, r in enumerate(rows) if r["mode"] == REPLACE), default=0) :]
        schema = T.StructType.fromJson(json.loads(visible[-1]["schema_json"]))
        folders = [self.path(table, part, f"load_id={row['folder']}") for row in visible]
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- partitions under a manifest ----------------------------------------

    def _newest(self, table: str, part: str):
        rows = self._switches(table, part)
        return rows[-1] if rows else None

    def _switches(self, table: str, part: str) -> list[Row]:
        return [r for r in self.log_rows(table) if r["part"] == part and r["mode"] == SWITCH]

    def _manifest(self, table: str, part: str, folder: str, schema: T.StructType) -> DataFrame:
        entries = T.StructType(
            [T.StructField("value", schema.fields[-1].dataType)]
            + T.StructType.fromDDL("folder string, load string, records bigint").fields
        )
        return self.spark.read.schema(entries).parquet(self.path(table, "manifests", part, folder))

    def snapshot(self, table: str, part: str = PARTITIONS) -> DataFrame | None:
        """value, folder, load, records of each published partition; None before the first load."""
        row = self._newest(table, part)
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        return self._manifest(table, part, row["folder"], schema)

    def partitions(
        self, table: str, part: str = PARTITIONS, values: DataFrame | None = None
    ) -> DataFrame | None:
        """The published partitions, or those of the given values; None before the first load.

        The result is a snapshot: later loads write elsewhere.
        """
        row = self._newest(table, part)
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        entries = self._manifest(table, part, row["folder"], schema)
        if values is not None:
            entries = entries.join(values.toDF("value"), "value", "left_semi")
        return self._read_entries(table, part, entries, schema)

    def _read_entries(
        self, table: str, part: str, entries: DataFrame, schema: T.StructType
    ) -> DataFrame:
        # names of folders, which Spark lists on the driver anyway
        folders = sorted(row["folder"] for row in entries.select("folder").distinct().collect())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self._read_folders(table, part, folders, schema).drop(LOAD_KEY)

    def _read_folders(
        self, table: str, part: str, folders: Sequence[str], schema: T.StructType
    ) -> DataFrame:
        # the name of a load is text, also if it looks like a number
        named = T.StructType([*schema.fields, T.StructField(LOAD_KEY, T.StringType())])
        reader = self.spark.read.schema(named).option("basePath", self.path(table, part))
        return reader.parquet(*[self.path(table, part, f) for f in folders])

    def rows_by_load(
        self, table: str, part: str, folders: Sequence[str], schema: T.StructType
    ) -> DataFrame:
        """The rows of some partition folders, with the load that wrote them in ``LOAD_KEY``."""
        return self._read_folders(table, part, folders, schema)

    def kept_sums(self, table: str, part: str, schema: T.StructType) -> DataFrame | None:
        """All checksums kept beside the folders of a part, None before the first."""
        return self._read_if_there(self.path(table, "sums", part), schema)

    def keep_sums(self, sums: DataFrame, table: str, part: str) -> None:
        """Add checksums of folders; folders never change, so kept sums stay true."""
        sums.write.mode("append").options(**self.file_options).parquet(self.path(table, "sums", part))

    def stage(
        self, df: DataFrame, table: str, column: str, load_id: str, part: str = PARTITIONS
    ) -> Written:
        """Write partitions where only their load will name them. Large ones are spread over
        several tasks and files."""
        folder = self._folder(table, load_id)
        ordered = self.fitted(df.select(*[c for c in df.columns if c != column], column), table, part)
        seen = Observation()
        observed = ordered.observe(
            seen, F.count(F.lit(1)).alias("records"), F.max(column).cast("string").alias("high")
        )
        spread = observed.hint("rebalance", F.col(column))
        self._write(spread, self.path(table, part, f"{LOAD_KEY}={folder}"), column)
        found = _observed(seen, df)
        staged = Written(
            part,
            SWITCH,
            load_id,
            found["records"],
            found.get("high"),
            None,
            ordered.schema.json(),
            folder,
        )
        # what the files hold is looked up once, for the checks and for the manifest
        held = self.stored_entries(table, part, [folder], staged.schema)
        self._write(held.coalesce(1), self.path(table, "manifests", part, f"{folder}.staged"))
        return staged

    def staged_values(self, table: str, column: str, staged: Written) -> DataFrame:
        """The partition values that a staged load brings."""
        return self._entries(table, staged).select(F.col("value").alias(column)).distinct()

    def staged(self, table: str, staged: Written) -> DataFrame:
        """The rows of a load that is staged, published or not."""
        folder = f"{LOAD_KEY}={staged.folder}"
        return self._read_folders(table, staged.part, [folder], staged.schema).drop(LOAD_KEY)

    def _entries(self, table: str, staged: Written) -> DataFrame:
        """The manifest rows of a staged load."""
        return self._manifest(table, staged.part, f"{staged.folder}.staged", staged.schema)

    def stored_entries(
        self, table: str, part: str, loads: Sequence[str], schema: T.StructType
    ) -> DataFrame:
        """value, folder, load, records of the partitions that the files of some loads hold:
        only their footers are read."""
        if not loads:
            kind = schema.fields[-1].dataType.simpleString()
            return self.spark.createDataFrame([], f"value {kind}, folder string, load string, records bigint")
        rows = self._read_folders(table, part, [f"{LOAD_KEY}={x}" for x in loads], schema)
        # value and load are constant in a file; the path is looked at once for each of them
        held = rows.groupBy(F.col(schema.names[-1]).alias("value"), F.col(LOAD_KEY).alias("load")).agg(
            F.count(F.lit(1)).alias("records"), F.any_value("_metadata.file_path").alias("path")
        )
        # a path is written with escapes, of which a plus is none
        path = F.regexp_extract("path", "([^/]+/[^/]+)/[^/]*$", 1)
        folder = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
        return held.select("value", folder.alias("folder"), "load", "records")

    def check_staged(
        self, table: str, column: str, staged: Written, inside: DataFrame | None = None
    ) -> None:
        """Row count, null values and, if given, the values allowed in ``inside``.

        The schema was checked before the rows were written.
        """
        entries = self._entries(table, staged)
        found = entries.agg(
            F.coalesce(F.sum("records"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("records"))), F.lit(0)).alias("nulls"),
        ).first()
        if found["n"] != staged.records:
            raise CheckFailed(f"{table}: staged {found['n']} of {staged.records} rows")
        if found["nulls"]:
            raise CheckFailed(f"{table}: {found['nulls']} staged rows without {column}")
        if inside is not None:
            outside = entries.join(inside.select(F.col(column).alias("value")), "value", "left_anti")
            if not outside.isEmpty():
                raise CheckFailed(f"{table}: staged rows outside the partitions to load")

    def switch(
        self, table: str, column: str, staged: Written, gone: DataFrame | None = None
    ) -> Written:
        """The manifest with the staged partitions in the place of the published ones and
        without the values in ``gone``; ``publish`` makes it the newest. No rows move."""
        entries = self._entries(table, staged)
        row = self._newest(table, staged.part)
        if row is not None:
            before = self._manifest(table, staged.part, row["folder"], staged.schema)
            before = before.join(entries.select("value"), "value", "left_anti")
            if gone is not None:
                before = before.join(gone.select(F.col(column).alias("value")), "value", "left_anti")
            entries = entries.unionByName(before)
        self._write(entries.coalesce(1), self.path(table, "manifests", staged.part, staged.folder))
        return replace(staged, base=row["folder"] if row is not None else None)

    def replaced(self, table: str, load_id: str, part: str = PARTITIONS) -> DataFrame | None:
        """The rows that a published load replaced or removed: its archive."""
        row = self._logged(table, part, load_id)
        if row["base"] is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        after = self._manifest(table, part, row["folder"], schema)
        before = self._manifest(table, part, row["base"], schema)
        return self._read_entries(table, part, before.join(after, "folder", "left_anti"), schema)

    def _logged(self, table: str, part: str, load_id: str):
        row = next((r for r in self._switches(table, part) if r["load_id"] == load_id), None)
        if row is None:
            raise ValueError(f"{table} has no published load {load_id}")
        return row

    def roll_back(
        self, table: str, column: str, load_id: str, now: dt.datetime | None = None, part: str = PARTITIONS
    ) -> None:
        """Undo a load: partitions it replaced or removed return, partitions it added go.

        Partitions that a later load has replaced stay as that load left them. The undoing
        is one row of the log, and the id may be loaded again.
        """
        row, newest = self._logged(table, part, load_id), self._newest(table, part)
        schema = T.StructType.fromJson(json.loads(newest["schema_json"]))
        after = self._manifest(table, part, row["folder"], schema)
        kept = self._manifest(table, part, newest["folder"], schema).where(F.col("load") != row["folder"])
        entries = kept
        if row["base"] is not None:
            before = self._manifest(table, part, row["base"], schema)
            touched = before.join(after, "folder", "left_anti")
            entries = kept.unionByName(touched.join(kept.select("value"), "value", "left_anti"))
        folder = f"undo-{row['folder']}"
        self._write(entries.coalesce(1), self.path(table, "manifests", part, folder))
        left = self._manifest(table, part, folder, schema)
        found = left.agg(F.sum("records").alias("n"), F.max("value").cast("string").alias("high")).first()
        moment = now or max(newest["updated_at"], row["updated_at"]) + dt.timedelta(microseconds=1)
        undone = Written(
            part, SWITCH, folder, found["n"] or 0, found["high"], None, newest["schema_json"], folder, newest["folder"]
        )
        self.publish(table, row["table_type"], [undone], moment, "rolled_back", undoes=row["folder"])

    def drop_entries(
        self, table: str, lost: DataFrame, load_id: str, table_type: str, now: dt.datetime, part: str = PARTITIONS
    ) -> None:
        """Publish a manifest without some of the entries of the newest one."""
        row = self._newest(table, part)
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        entries = self._manifest(table, part, row["folder"], schema)
        left = entries.join(lost.select("folder"), "folder", "left_anti").select(*entries.columns)
        self._write(left.coalesce(1), self.path(table, "manifests", part, load_id))
        high = self._manifest(table, part, load_id, schema).agg(F.max("value").cast("string")).first()[0]
        made = Written(part, SWITCH, load_id, 0, high, None, row["schema_json"], load_id, row["folder"])
        self.publish(table, table_type, [made], now, "lost_partitions")

    def logged_folders(self, table: str, part: str) -> list:
        """Folders of a part that the log names, also those of loads that were undone."""
        return self._log(table).where(F.col("part") == part).select("folder").distinct().collect()

    def enter(
        self,
        table: str,
        table_type: str,
        part: str,
        folder: str,
        records: int,
        mark: str,
        schema: T.StructType,
        now: dt.datetime,
    ) -> None:
        """Log a load whose files are there but whose log row is lost.

        It is dated before all logged loads, so the newest one stays the newest.
        """
        rows = self.spark.read.schema(schema).parquet(self.path(table, part, f"load_id={folder}"))
        high = rows.agg(F.max(mark).cast("string")).first()[0]
        rows_known = self.log_rows(table)
        first = rows_known[0]["updated_at"] if rows_known else None
        found = Written(part, APPEND, folder, records, high, None, schema.json(), folder)
        moment = first - dt.timedelta(microseconds=1) if first else now
        self.publish(table, table_type, [found], moment, "entered_again")

    def expire(self, table: str, keep: int, part: str = PARTITIONS) -> int:
        """Delete partition folders that the newest ``keep`` manifests do not name, and give
        their number. Readers and roll-backs that need older manifests fail afterwards.

        Folders of loads that are not published yet are left alone.
        """
        if keep < 1:
            raise ValueError("the newest manifest has to stay")
        # one row a load: names of manifests, not data
        log = self._log(table).where((F.col("part") == part) & (F.col("mode") == SWITCH))
        rows = log.orderBy(F.desc("updated_at"), F.desc("folder")).collect()
        effective = [r["folder"] for r in self._switches(table, part)[-keep:]]
        if not rows:
            return 0
        schema = T.StructType.fromJson(json.loads(rows[0]["schema_json"]))
        named = [self._manifest(table, part, f, schema).select("folder") for f in effective]
        stay = reduce(DataFrame.union, named)
        known = [
            m.select("folder")
            for r in rows
            if (m := self._manifest_if_there(table, part, r["folder"], schema)) is not None
        ]
        dead = reduce(DataFrame.union, known).distinct().join(stay, "folder", "left_anti").collect()
        for row in dead:
            self._delete(self.path(table, part, row["folder"]))
        for r in rows:
            if r["folder"] not in effective:
                self._delete(self.path(table, "manifests", part, r["folder"]))
                self._delete(self.path(table, "manifests", part, f"{r['folder']}.staged"))
        return len(dead)

    def _manifest_if_there(
        self, table: str, part: str, folder: str, schema: T.StructType
    ) -> DataFrame | None:
        try:
            return self._manifest(table, part, folder, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _delete(self, folder: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)

    def _write(self, df: DataFrame, path: str, column: str | None = None) -> None:
        writer = (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .options(**self.file_options)
        )
        (writer.partitionBy(column) if column else writer).parquet(path)

    def _read_if_there(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
