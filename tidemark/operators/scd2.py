"""Slowly changing dimension, type 2: apply changes, keep history, view it.

The change batch is small next to the target, so every join has the batch (or what is
derived from it) on the right: Spark broadcasts it when it is small and otherwise
splits skewed keys of the target side. Superseded history never takes part in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Scd2Table
from tidemark.operators.ordered import OrderedRows, join_null_safe, latest_per_key
from tidemark.operators.schema import in_schema
from tidemark.sources.tables import range_rows

NEW, UPDATED, UNCHANGED = "new", "updated", "unchanged"
_TIE = "_tie"


def with_total_order(df: DataFrame, table: Scd2Table) -> tuple[DataFrame, list[str]]:
    """``df`` and its order columns; without a tie-break the row content decides ties."""
    if table.tie_break:
        return df, list(table.order)
    content = [c for c in df.columns if c != table.last_modified]
    return df.withColumn(_TIE, F.xxhash64(*content)), [table.last_modified, _TIE]


def batch_latest(batch: DataFrame, table: Scd2Table) -> DataFrame:
    """Newest row per business key of a batch."""
    ordered, order = with_total_order(batch, table)
    return latest_per_key(ordered, table.keys, order).drop(_TIE)


def current(target: DataFrame, table: Scd2Table) -> DataFrame:
    """The rows flagged as current."""
    return target.where(F.col(table.is_latest))


def as_of(target: DataFrame, table: Scd2Table, moment: Column) -> DataFrame:
    """The version of each key that was valid at ``moment``."""
    started = F.col(table.effective_date) <= moment
    open_end = F.col(table.end_date).isNull() | (F.col(table.end_date) > moment)
    return target.where(started & open_end)


def changed_since(source: DataFrame, table: Scd2Table, low=None, high=None) -> DataFrame:
    """Source rows with ``low < last_modified <= high``; a missing bound is open."""
    return range_rows(source, table.last_modified, low, high)


def _newest_values(newest: DataFrame, table: Scd2Table, tracked: list[str]) -> DataFrame:
    """Keys of a reduced batch with what a current row has to be compared with."""
    return newest.select(
        *table.keys, F.struct(*tracked).alias("_new"), F.col(table.last_modified).alias("_end")
    )


def classify(batch: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Newest batch row per key with ``change``: new, updated or unchanged.

    A key is unchanged if a current row has the same tracked attributes, null included.
    """
    newest = batch_latest(batch, table)
    tracked = table.tracked_in(batch.columns)
    keys = list(table.keys)
    known = (
        current(target, table)
        .join(_newest_values(newest, table, tracked), keys)
        .groupBy(*keys)
        .agg(F.bool_or(F.struct(*tracked).eqNullSafe(F.col("_new"))).alias("_same"))
    )
    change = F.when(F.col("_same").isNull(), NEW).when(F.col("_same"), UNCHANGED)
    return (
        newest.join(known, keys, "left")
        .withColumn("change", change.otherwise(UPDATED))
        .select(*batch.columns, "change")
    )


def changed_rows(batch: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Batch rows that differ from the current version of a known key."""
    return classify(batch, target, table).where(F.col("change") == UPDATED).drop("change")


def change_counts(batch: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Keys per kind of change."""
    return classify(batch, target, table).groupBy("change").agg(F.count(F.lit(1)).alias("n_keys"))


def _new_versions(rows: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Rows shaped like the target with the control columns of a current version.

    Columns that the rows no longer have are null.
    """
    control = {table.is_latest: F.lit(True)}
    if table.effective_date:
        control[table.effective_date] = F.col(table.last_modified)
    if table.end_date:
        control[table.end_date] = F.lit(None).cast(target.schema[table.end_date].dataType)
    return in_schema(rows.withColumns(control), target.schema)


def inserts(batch: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """New current versions: new keys and changed keys."""
    rows = classify(batch, target, table).where(F.col("change") != UNCHANGED)
    return _new_versions(rows, target, table)


def _close(joined: DataFrame, table: Scd2Table, hit: Column, end_ts: Column | None) -> DataFrame:
    """Rows joined with ``_end``: those that are hit are no longer current and end there."""
    changes = {table.is_latest: F.col(table.is_latest) & ~hit}
    if table.end_date:
        end = F.col("_end") if end_ts is None else end_ts
        changes[table.end_date] = F.when(hit, end).otherwise(F.col(table.end_date))
    return joined.withColumns(changes)


def _differs(tracked: list[str]) -> Column:
    return F.col("_end").isNotNull() & ~F.struct(*tracked).eqNullSafe(F.col("_new"))


def expired(
    batch: DataFrame, target: DataFrame, table: Scd2Table, end_ts: Column | None = None
) -> DataFrame:
    """Current versions closed by the batch, as they look afterwards."""
    tracked = table.tracked_in(batch.columns)
    values = _newest_values(batch_latest(batch, table), table, tracked)
    touched = current(target, table).join(values, list(table.keys)).where(_differs(tracked))
    return _close(touched, table, F.lit(True), end_ts).select(*target.columns)


def apply_batch(
    batch: DataFrame, target: DataFrame, table: Scd2Table, end_ts: Column | None = None
) -> DataFrame:
    """The target after the batch, each key collapsed to its newest batch row.

    The old version ends when the new one was modified, or at ``end_ts``. A key with
    several current rows is left with the rows that equal the batch, or the new one.
    """
    tracked = table.tracked_in(batch.columns)
    values = _newest_values(batch_latest(batch, table), table, tracked)
    history = target.where(~F.col(table.is_latest))
    joined = current(target, table).join(values, list(table.keys), "left")
    kept = _close(joined, table, _differs(tracked), end_ts).select(*target.columns)
    return history.unionByName(kept).unionByName(inserts(batch, target, table))


def append_and_expire(
    batch: DataFrame, target: DataFrame, table: Scd2Table, end_ts: Column | None = None
) -> DataFrame:
    """The simple variant: close every current row of a key in the batch and append the
    batch as it comes, without a change test."""
    ends = batch.groupBy(*table.keys).agg(F.min(table.last_modified).alias("_end"))
    history = target.where(~F.col(table.is_latest))
    joined = current(target, table).join(ends, list(table.keys), "left")
    kept = _close(joined, table, F.col("_end").isNotNull(), end_ts).select(*target.columns)
    return history.unionByName(kept).unionByName(_new_versions(batch, target, table))


def backfill_appended(late: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """The target of mode "append" with late source rows it lacks fitted in as they come.

    No stored row is dropped or folded. A late row ends at the next stamp of its key and is
    current if there is none. A stored row ends at a late row that follows it at once; one
    that was current also ends if any late row is newer.
    """
    keys, stamp = list(table.keys), table.last_modified
    content = [c for c in late.columns if c in target.columns]
    known = join_null_safe(target, late.select(*keys).distinct(), keys, "left_semi")
    missing = late.select(*content).exceptAll(known.select(*content))
    fitted = _new_versions(missing, target, table).withColumn("_late", F.lit(True))
    both = target.withColumn("_late", F.lit(False)).unionByName(fitted)
    touched = missing.groupBy(*keys).agg(F.min(stamp).alias("_low"), F.max(stamp).alias("_high"))
    rows = join_null_safe(both, touched, keys, "inner")
    others = join_null_safe(target, touched.select(*keys), keys, "left_anti")
    stamps = rows.groupBy(*keys, stamp).agg(F.bool_or("_late").alias("_late_next"))
    following = (
        OrderedRows.of(stamps, keys, [stamp])
        .next([stamp, "_late_next"], "_after")
        .rows()
        .select(*keys, stamp, "_after")
    )
    placed = join_null_safe(rows, following, [*keys, stamp], "left")
    after, is_latest = F.col("_after")[stamp], F.col(table.is_latest)
    at_once = F.when(F.coalesce(F.col("_after")["_late_next"], F.lit(False)), after)
    passed = F.when(
        is_latest & (F.col(stamp) < F.col("_high")),
        F.when(F.col("_low") > F.col(stamp), F.col("_low")).otherwise(F.col("_high")),
    )
    closing = F.when(F.col("_late"), after).otherwise(F.coalesce(at_once, passed))
    changes = {
        table.is_latest: F.when(F.col("_late"), after.isNull()).otherwise(is_latest & closing.isNull())
    }
    if table.end_date:
        changes[table.end_date] = F.when(F.col("_late"), closing).otherwise(
            F.least(F.col(table.end_date), closing)
        )
    return others.unionByName(placed.withColumns(changes).select(*target.columns))


def full_history(
    rows: DataFrame, table: Scd2Table, max_group_rows: int | None = None
) -> DataFrame:
    """Every distinct version of every key.

    Rows that repeat the tracked attributes of the row before make no version. A
    version ends when the next one starts.
    """
    tracked = table.tracked_in(rows.columns)
    ordered, order = with_total_order(rows, table)
    versions = (
        OrderedRows.of(
            ordered, table.keys, order, unique_on=[table.last_modified], max_rows=max_group_rows
        )
        .previous(tracked, "_before")
        .apply(lambda df: df.where(~F.struct(*tracked).eqNullSafe(F.col("_before"))))
        .next([table.last_modified], "_after")
        .rows()
    )
    control = {table.is_latest: F.col("_after").isNull()}
    if table.effective_date:
        control[table.effective_date] = F.col(table.last_modified)
    if table.end_date:
        control[table.end_date] = F.col("_after")[table.last_modified]
    return versions.withColumns(control).drop("_before", "_after", _TIE)


def backfill(
    source: DataFrame,
    target: DataFrame,
    table: Scd2Table,
    low=None,
    high=None,
    max_group_rows: int | None = None,
) -> DataFrame:
    """The target after source changes in ``(low, high]`` are fitted into its history.

    Late rows land between versions that exist, and may part a version from repeats that
    were folded into it. So the touched keys are rebuilt from all their source rows and
    from the stored versions, which the source may have lost; other keys pass through.
    """
    late = changed_since(source, table, low, high)
    keys = list(table.keys)
    touched = late.select(*keys).distinct()
    content = [c for c in source.columns if c in target.columns]
    again = join_null_safe(target, touched, keys, "left_semi").select(*content)
    known = source.where(F.col(table.last_modified).isNotNull())
    known = join_null_safe(known, touched, keys, "left_semi").select(*content)
    rebuilt = full_history(again.unionByName(known), table, max_group_rows)
    others = join_null_safe(target, touched, keys, "left_anti")
    return others.unionByName(in_schema(rebuilt, target.schema))
