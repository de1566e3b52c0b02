"""One load per table and run, and the run over all tables.

Each job reads the source and what is published, writes a load and publishes it. Running
a job again after a failure, or twice, gives the same table.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace
from functools import reduce, wraps
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import (
    AppendTable,
    PartitionTable,
    Scd2Table,
    StaticTable,
    TableConfig,
    select_tables,
)
from tidemark.functions.canonical import table_fingerprint
from tidemark.operators import partitions, scd2, scd2_checks, static, watermark
from tidemark.operators.ordered import join_null_safe
from tidemark.operators.schema import (
    in_schema,
    merged_schema,
    quarantine,
    require_error_rate,
    type_conflicts,
)
from tidemark.sinks.store import APPEND, REPLACE, CheckFailed, Store
from tidemark.sources.tables import only, rows_above, rows_from, typed_lit

RUN_LOG = (
    "run_id string, table_name string, table_type string, success boolean, error string, "
    "reason string, total_records bigint, duration_seconds double, finished_at timestamp_ntz"
)
DATA, CURRENT, HISTORY = "data", "current", "history"
EXTRACT, PLANNED, UNPLACED = "extract", "planned", "unplaced"
BUCKET = "_bucket"
Outcome = tuple[str, int]


def new_load_id() -> str:
    return uuid.uuid4().hex


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def nothing(reason: str) -> Outcome:
    return reason, 0


def once_per_id(load):
    """A load whose id is published already gives its recorded outcome and writes nothing.

    So a scheduler may repeat a run under the same id, however far the first one came.
    """

    @wraps(load)
    def guarded(store: Store, table: TableConfig, *args, **named) -> Outcome:
        load_id = signature(load).bind(store, table, *args, **named).arguments.get("load_id")
        found = store.published(table.table, load_id) if load_id else None
        return load(store, table, *args, **named) if found is None else found

    return guarded


def set_aside(
    store: Store, table: TableConfig, rows: DataFrame, load_id: str, now: dt.datetime
) -> int:
    """Keep rows that a load cannot place, as they came, under ``<table>.rejected``.

    The part ``unplaced`` holds those of the newest load that met any.
    """
    name = f"{table.table}.rejected"
    if not rows.agg(F.count(F.lit(1)).alias("n")).first()["n"] or store.published(name, load_id):
        return 0
    written = store.write(rows, name, UNPLACED, load_id, REPLACE)
    if written.records:
        store.publish(name, table.kind, [written], now, "without_value")
    return written.records


def _evolved(name: str, have: DataFrame, rows: DataFrame) -> DataFrame:
    """Published rows with the new columns and wider types of the source; anything else a
    source may change stops the load before it writes."""
    issues = type_conflicts(have.schema, rows.schema)
    if issues:
        raise CheckFailed(f"{name}: the schema of the source does not fit: {issues}")
    return in_schema(have, merged_schema(have.schema, rows.schema))


# ---- sources that arrive as text --------------------------------------------


def convert_source(
    store: Store,
    table: TableConfig,
    raw: DataFrame,
    schema: T.StructType,
    error_threshold: float = 0.0,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """The raw rows in declared types. Rows that do not convert are kept aside as they came,
    under ``<table>.rejected``; above ``error_threshold`` the load stops."""
    require_error_rate(raw, schema, error_threshold)
    good, bad = quarantine(raw, schema)
    rejected = f"{table.table}.rejected"
    written = store.write(bad, rejected, DATA, load_id or new_load_id(), APPEND)
    if written.records:
        store.publish(rejected, table.kind, [written], now or utc_now(), "rejected")
    return good


# ---- partition tables -------------------------------------------------------


def _load_partitions(
    store: Store,
    table: PartitionTable,
    rows: DataFrame,
    values: DataFrame | None,
    load_id: str,
    now: dt.datetime,
    reason: str,
    scope: DataFrame | None = None,
) -> Outcome:
    """Stage, check, switch, publish. Published values in ``scope`` that the load does not
    bring are removed; earlier manifests still name them."""
    column = table.partition_column
    staged = store.stage(rows, table.table, column, load_id)
    gone = None
    if scope is not None:
        brought = store.staged_values(table.table, column, staged)
        gone = scope.select(column).distinct().join(brought, column, "left_anti")
    if not staged.records and (gone is None or gone.isEmpty()):
        return nothing("no_new_partitions")
    store.check_staged(table.table, column, staged, values)
    switched = store.switch(table.table, column, staged, gone)
    store.publish(table.table, table.kind, [switched], now, reason)
    return reason, staged.records


@once_per_id
def load_partition_table(
    store: Store,
    table: PartitionTable,
    source: DataFrame,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Load the partition values the target lacks, and changed ones if asked to.

    The first load takes the last ``initial_load_count`` values, or all. Rows without a
    partition value are set aside.
    """
    column = table.partition_column
    rows = only(source, table.where)
    load_id, now = load_id or new_load_id(), now or utc_now()
    set_aside(store, table, rows.where(F.col(column).isNull()), load_id, now)
    rows = rows.where(F.col(column).isNotNull())
    have = store.partitions(table.table)
    if have is None:
        if table.initial_load_count is not None:
            rows = partitions.last_n_partitions(rows, column, table.initial_load_count)
        return _load_partitions(store, table, rows, None, load_id, now, "initial_load")
    held = store.snapshot(table.table).select(F.col("value").alias(column))
    if table.replace_changed:
        values = (
            partitions.partition_load_strategy(rows, have, column, sorted(rows.columns))
            .where(F.col("strategy") != "skip")
            .select(column)
        )
    else:
        values = partitions.missing_partitions(rows, held, column)
    if table.initial_load_count is not None:
        # what the first load left out on purpose is not a gap
        first = held.agg(F.min(column).alias("low")).first()["low"]
        values = values.where(F.col(column) >= F.lit(first))
    # the decision is taken once: the source may grow while its rows are copied
    planned = store.write(values, table.table, PLANNED, load_id, REPLACE)
    values = store.read_load(table.table, planned)
    wanted = rows.join(values, column, "left_semi")
    return _load_partitions(store, table, wanted, values, load_id, now, "new_partitions")


@once_per_id
def backfill_partition_table(
    store: Store,
    table: PartitionTable,
    source: DataFrame,
    low=None,
    high=None,
    values=None,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Load a range or a list of partition values again, whatever is published.

    The range or list says what is replaced: values that the source no longer has go.
    """
    column = table.partition_column
    rows = partitions.backfill_rows(only(source, table.where), column, low, high, values)
    known = store.snapshot(table.table)
    scope = None
    if known is not None:
        held = known.select(F.col("value").alias(column))
        scope = partitions.backfill_rows(held, column, low, high, values)
    load_id, now = load_id or new_load_id(), now or utc_now()
    return _load_partitions(store, table, rows, None, load_id, now, "backfill", scope)


def copy_missing_partitions(
    origin: Store, destination: Store, table: PartitionTable, now: dt.datetime | None = None
) -> Outcome:
    """Rebuild partitions that one copy of a table lost from the other copy."""
    rows = origin.partitions(table.table)
    if rows is None:
        return nothing("nothing_to_copy")
    have = destination.partitions(table.table)
    if have is not None:
        lost = partitions.missing_partitions(rows, have, table.partition_column)
        rows = rows.join(lost, table.partition_column, "left_semi").select(*have.columns)
    return _load_partitions(
        destination, table, rows, None, new_load_id(), now or utc_now(), "recovered"
    )


# ---- versioned tables -------------------------------------------------------


def versioned_rows(store: Store, table: Scd2Table) -> DataFrame | None:
    """All published versions: superseded history and current rows."""
    current = current_rows(store, table)
    if current is None:
        return None
    history = store.read(table.table, HISTORY)
    return current if history is None else history.unionByName(current)


def _bucketed(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """rows with the bucket of their key as the last column."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*table.keys), F.lit(table.buckets)).cast("int"))


def current_rows(
    store: Store, table: Scd2Table, batch: DataFrame | None = None
) -> DataFrame | None:
    """The published current versions, of bucketed tables only those in the buckets of a batch."""
    if not table.buckets:
        return store.read(table.table, CURRENT)
    touched = None if batch is None else _bucketed(batch, table).select(BUCKET).distinct()
    rows = store.partitions(table.table, CURRENT, touched)
    return None if rows is None else rows.drop(BUCKET)


def _first_versions(rows: DataFrame, table: Scd2Table) -> DataFrame:
    if table.mode == "full_history":
        return scd2.full_history(rows, table)
    # in mode "append" rows are kept as they come, the first load's too
    newest = rows if table.mode == "append" else scd2.batch_latest(rows, table)
    control = {table.is_latest: F.lit(True)}
    if table.effective_date:
        control[table.effective_date] = F.col(table.last_modified)
    if table.end_date:
        control[table.end_date] = F.lit(None).cast(rows.schema[table.last_modified].dataType)
    return newest.withColumns(control)


def _publish_versions(
    store: Store,
    table: Scd2Table,
    after: DataFrame,
    history_mode: str,
    load_id: str,
    now: dt.datetime,
    reason: str,
    last_value: str | None,
) -> None:
    """Write the current slice anew and add to, or replace, the history.

    Of a bucketed table only the buckets that ``after`` has rows of are written; where it
    replaces the history it holds the whole table, and other buckets are empty.
    """
    name, is_latest = table.table, F.col(table.is_latest)
    history = store.write(after.where(~is_latest), name, HISTORY, load_id, history_mode)
    latest = after.where(is_latest)
    if table.buckets:
        current = store.stage(_bucketed(latest, table), name, BUCKET, load_id, CURRENT)
        store.check_staged(name, BUCKET, current)
        rows = store.staged(name, current)
    else:
        current = store.write(latest, name, CURRENT, load_id, REPLACE)
        rows = store.read_load(name, current)
    # rows appended as they come may leave several current rows by design
    if table.mode != "append":
        broken = scd2_checks.multiple_latest(rows, table)
        if not broken.isEmpty():
            raise CheckFailed(f"{name}: a key has several current rows")
    if table.buckets:
        gone = None
        known = store.snapshot(name, CURRENT)
        if history_mode == REPLACE and known is not None:
            brought = store.staged_values(name, BUCKET, current)
            gone = known.select(F.col("value").alias(BUCKET)).join(brought, BUCKET, "left_anti")
        current = store.switch(name, BUCKET, current, gone)
    slices = [replace(w, last_value=last_value) for w in (history, current)]
    store.publish(name, table.kind, slices, now, reason)


@once_per_id
def load_scd2_table(
    store: Store,
    table: Scd2Table,
    source: DataFrame,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Extract source changes above the published mark and apply them.

    The current slice, or the buckets of it that the changes touch, is rewritten; superseded
    versions are only added to the history, so the cost of a run does not grow with the
    length of the history. Source rows that turn up below the mark are a matter for
    ``backfill_scd2_table``.
    """
    name, mark = table.table, table.last_modified
    rows = only(source, table.where)
    load_id, now = load_id or new_load_id(), now or utc_now()
    first = store.schema(name, CURRENT) is None
    if first:
        if table.initial_load_days is not None:
            rows = watermark.last_n_days(rows, mark, table.initial_load_days)
    else:
        # the mark is published together with the rows it speaks of; rows that brought no
        # change move it too, so it may be above every stored stamp
        rows = rows_above(rows, mark, store.state(name)["last_value"], table.overlap_seconds)
    extract = store.write(
        rows, name, EXTRACT, load_id, REPLACE, mark, required=[*table.keys, mark]
    )
    if not extract.records:
        return nothing("no_data_in_source" if first else "no_new_records")
    batch = store.read_load(name, extract)
    if first:
        after, mode, reason = _first_versions(batch, table), REPLACE, "initial_load"
    else:
        # Every batch row is above the mark, so nothing falls between older versions and
        # the current slice is all that is needed. It holds no superseded rows: what is
        # superseded afterwards is new history.
        apply = {
            "collapse": scd2.apply_batch,
            "append": scd2.append_and_expire,
            "full_history": scd2.backfill,
        }[table.mode]
        current = _evolved(name, current_rows(store, table, batch), batch)
        after, mode, reason = apply(batch, current, table), APPEND, "incremental_update"
    _publish_versions(store, table, after, mode, load_id, now, reason, extract.last_value)
    return reason, extract.records


@once_per_id
def backfill_scd2_table(
    store: Store,
    table: Scd2Table,
    source: DataFrame,
    low=None,
    high=None,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Fit source changes in ``(low, high]`` into the published history.

    All source rows of the touched keys up to the published mark are read again: a late
    row may part a version from repeats that were folded into it. In mode "append" stored
    rows stay as they are and the late ones they lack are added.
    """
    target = versioned_rows(store, table)
    if target is None:
        raise ValueError(f"{table.table} has not been loaded yet")
    load_id = load_id or new_load_id()
    # a backfill never moves the mark
    mark = store.state(table.table)["last_value"]
    rows, stamp = only(source, table.where), table.last_modified
    target = _evolved(table.table, target, rows)
    late = scd2.changed_since(rows, table, low, high)
    if table.mode == "append":
        extract = store.write(
            late, table.table, EXTRACT, load_id, REPLACE, stamp, required=[*table.keys, stamp]
        )
        if not extract.records:
            return nothing("no_data_in_source")
        known = store.read_load(table.table, extract)
        published = F.col(stamp) <= F.lit(mark).cast(rows.schema[stamp].dataType)
        after = scd2.backfill_appended(known.where(published), target, table)
        _publish_versions(store, table, after, REPLACE, load_id, now or utc_now(), "backfill", mark)
        return "backfill", extract.records
    touched = late.select(*table.keys).distinct()
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(stamp) <= typed_lit(rows, stamp, low))
    if high is not None:
        outside = outside | (F.col(stamp) > typed_lit(rows, stamp, high))
    published = F.col(stamp) <= F.lit(mark).cast(rows.schema[stamp].dataType)
    earlier = join_null_safe(rows.where(published & outside), touched, table.keys, "left_semi")
    extract = store.write(
        earlier.unionByName(late), table.table, EXTRACT, load_id, REPLACE, stamp, required=table.keys
    )
    if not extract.records:
        return nothing("no_data_in_source")
    known = store.read_load(table.table, extract)
    after = scd2.backfill(known, target, table)
    _publish_versions(store, table, after, REPLACE, load_id, now or utc_now(), "backfill", mark)
    return "backfill", scd2.changed_since(known, table, low, high).count()


def repair_scd2_table(
    store: Store,
    table: Scd2Table,
    rebuild: bool = False,
    dry_run: bool = True,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> tuple[int, int]:
    """Keys with several current rows and rows to close; written unless a dry run.

    ``rebuild`` sets every flag anew from the modification stamps.
    """
    target = versioned_rows(store, table)
    if target is None:
        return 0, 0
    found = scd2_checks.repair_counts(target, table).first()
    counts = found["n_keys"], found["n_rows"]
    if dry_run or (not counts[0] and not rebuild):
        return counts
    fixed = (scd2_checks.rebuild_flags if rebuild else scd2_checks.repair)(target, table)
    mark = store.state(table.table)["last_value"]
    load_id, now = load_id or new_load_id(), now or utc_now()
    _publish_versions(store, table, fixed, REPLACE, load_id, now, "repair", mark)
    return counts


# ---- reference tables -------------------------------------------------------


@once_per_id
def load_static_table(
    store: Store,
    table: StaticTable,
    source: DataFrame,
    force: bool = False,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Load if the content differs from what was published last, or is due again.

    An empty source never replaces a table.
    """
    rows = only(source, table.where)
    load_id, now = load_id or new_load_id(), now or utc_now()
    printed = table_fingerprint(rows, algorithm=table.hash_algorithm).withColumn(
        "table_name", F.lit(table.table)
    )
    states = (
        store.loads(table.table)
        .groupBy("table_name")
        .agg(F.max_by("last_hash", "updated_at").alias("last_hash"),
             F.max("updated_at").alias("last_loaded"))
    )
    decision = static.load_decisions(
        printed, states, F.lit(str(now)).cast("timestamp_ntz"), table.force_reload_after_days, force
    ).first()
    if not decision["needs_load"]:
        return nothing("unchanged")
    if decision["row_count"] == 0:
        return nothing("empty_source")
    content = decision["fingerprint"]
    have = store.read(table.table, DATA)
    result, columns = rows, rows.columns
    if table.load_strategy == "upsert":
        if not rows.groupBy(*table.primary_keys).count().where("count > 1").isEmpty():
            raise CheckFailed(f"{table.table}: the source repeats a primary key")
        if have is not None:
            own = have.drop(*static.LINEAGE) if table.lineage else have
            known = _evolved(table.table, own, rows)
            step = static.sync_with_deletes if table.allow_deletes else static.upsert
            result = step(in_schema(rows, known.schema), known, table.primary_keys)
    whole = table.load_strategy == "replace" or table.allow_deletes or have is None
    stored = static.with_lineage(result, load_id, content) if table.lineage else result
    written = store.write(
        stored, table.table, DATA, load_id, REPLACE,
        content=columns, algorithm=table.hash_algorithm, required=table.primary_keys,
    )
    if whole and written.content != content:
        raise CheckFailed(f"{table.table}: the source changed while it was copied")
    store.publish(table.table, table.kind, [written], now, decision["reason"], content)
    return decision["reason"], written.records


def repair_static_table(store: Store, table: StaticTable, source: DataFrame) -> Outcome:
    """Load again if the published rows are not those of the source."""
    have = store.read(table.table, DATA)
    rows = only(source, table.where)
    if have is not None:
        match = static.source_target_match(
            rows, have.select(*rows.columns), algorithm=table.hash_algorithm
        ).first()
        if not match["row_count_mismatch"] and not match["hash_mismatch"]:
            return nothing("consistent")
    return load_static_table(store, table, source, force=True)


# ---- append tables ----------------------------------------------------------


@once_per_id
def load_append_table(
    store: Store,
    table: AppendTable,
    source: DataFrame,
    load_id: str | None = None,
    now: dt.datetime | None = None,
) -> Outcome:
    """Append source rows above the highest published value.

    The mark comes from the load log, not from a scan of the table. With ``keys``, rows at the
    mark, up to ``overlap`` below it or without a value come too if no published row there
    has their key; only that stretch of the table is read. Without keys, rows that have no
    value are set aside.
    """
    rows, column = only(source, table.where), table.watermark_column
    load_id, now = load_id or new_load_id(), now or utc_now()
    mark = store.mark(table.table, DATA, rows.schema[column].dataType)
    have = store.read(table.table, DATA)
    reason = "initial_load" if have is None else "incremental_update"
    unmarked = F.col(column).isNull()
    if not table.keys:
        set_aside(store, table, rows.where(unmarked), load_id, now)
        fresh = rows.where(~unmarked) if mark is None else rows_above(rows, column, mark)
    else:
        near = rows if mark is None else rows_from(rows, column, mark, table.overlap).unionByName(rows.where(unmarked))
        fresh = near.dropDuplicates(list(table.keys))
        if have is not None:
            known = have
            if mark is not None:
                known = rows_from(have, column, mark, table.overlap).unionByName(have.where(unmarked))
            fresh = join_null_safe(fresh, known.select(*table.keys), table.keys, "left_anti")
    written = store.write(fresh, table.table, DATA, load_id, APPEND, column, cluster=table.cluster)
    if not written.records:
        return nothing("no_new_records")
    store.publish(table.table, table.kind, [written], now, reason)
    return reason, written.records


# ---- the run over all tables ------------------------------------------------

LOADERS: dict[str, Callable[..., Outcome]] = {
    "partition": load_partition_table,
    "scd": load_scd2_table,
    "static": load_static_table,
    "append": load_append_table,
}


def load_table(store: Store, table: TableConfig, source: DataFrame, **settings) -> Outcome:
    """One load of one table by its pattern."""
    return LOADERS[table.kind](store, table, source, **settings)


def run(
    store: Store,
    tables: Iterable[TableConfig],
    sources: Mapping[str, Callable[[SparkSession], DataFrame]],
    kinds: Iterable[str] | None = None,
    names: Iterable[str] | None = None,
    run_id: str | None = None,
    now: dt.datetime | None = None,
    before: Callable[[Store, TableConfig], object] | None = None,
) -> DataFrame:
    """Load the chosen tables, reference tables first; returns the run's log rows.

    A table that fails is logged with its error and does not stop the others. ``before`` is
    called ahead of each load; ``recovery.recover`` there brings log and files in line.
    """
    run_id = run_id or new_load_id()
    rows = []
    for table in select_tables(tables, kinds, names):
        started = time.monotonic()
        reason, records, error = None, 0, None
        try:
            source = sources[table.table](store.spark)
            if before is not None:
                before(store, table)
            load_id = f"{run_id}-{table.table}"
            reason, records = load_table(store, table, source, load_id=load_id, now=now)
        except Exception as failure:
            error = f"{type(failure).__name__}: {failure}"
        seconds = time.monotonic() - started
        finished = now or utc_now()
        rows.append(
            (run_id, table.table, table.kind, error is None, error, reason, records, seconds, finished)
        )
    log = store.spark.createDataFrame(rows, RUN_LOG)
    if rows:
        log.coalesce(1).write.mode("append").parquet(store.path("_run_log"))
    return log


def status(
    store: Store,
    tables: Iterable[TableConfig],
    sources: Mapping[str, Callable[[SparkSession], DataFrame]],
) -> DataFrame:
    """Per table: the newest load and what waits in the source.

    ``n_pending`` counts rows above the mark, for partition tables the partition values
    not loaded yet, and for reference tables all rows if their content has changed.
    """
    waiting = [store.spark.createDataFrame([], "table_name string, table_type string, n_pending bigint")]
    for table in tables:
        rows = only(sources[table.table](store.spark), table.where)
        state = store.state(table.table)
        if isinstance(table, PartitionTable):
            have = store.partitions(table.table)
            column = table.partition_column
            values = partitions.new_partition_values(rows, column)
            if have is not None:
                values = partitions.missing_partitions(rows, have, column)
            pending = values.agg(F.count(F.lit(1)).alias("n_pending"))
        elif isinstance(table, StaticTable):
            printed = table_fingerprint(rows, algorithm=table.hash_algorithm)
            same = F.col("fingerprint").eqNullSafe(F.lit(state["last_hash"] if state else None))
            pending = printed.select(F.when(same, 0).otherwise(F.col("row_count")).alias("n_pending"))
        else:
            mark = table.last_modified if isinstance(table, Scd2Table) else table.watermark_column
            fresh = rows_above(rows, mark, state["last_value"]) if state else rows
            pending = fresh.agg(F.count(F.lit(1)).alias("n_pending"))
        waiting.append(
            pending.select(
                F.lit(table.table).alias("table_name"),
                F.lit(table.kind).alias("table_type"),
                F.col("n_pending").cast("bigint"),
            )
        )
    newest = watermark.latest_state(store.loads()).select(
        "table_name", "last_value", "last_hash", "updated_at", "records"
    )
    return reduce(DataFrame.unionByName, waiting).join(newest, "table_name", "left")


def run_log(store: Store) -> DataFrame:
    """The log of every run."""
    return store.spark.read.schema(RUN_LOG).parquet(store.path("_run_log"))
