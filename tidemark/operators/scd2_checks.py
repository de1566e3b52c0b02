"""Integrity checks of versioned tables, and the repairs that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Scd2Table
from tidemark.operators.ordered import OrderedRows, join_null_safe
from tidemark.operators.quality import null_counts
from tidemark.operators.scd2 import with_total_order

# Timestamps listed in one report row; a key with more of them gets further rows.
REPORT_PIECE = 1000


def multiple_latest(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """Keys with more than one current row."""
    return (
        rows.where(F.col(table.is_latest))
        .groupBy(*table.keys)
        .agg(F.count(F.lit(1)).alias("n_latest"))
        .where(F.col("n_latest") > 1)
    )


def first_violations(rows: DataFrame, table: Scd2Table, n: int = 10) -> DataFrame:
    """The ``n`` worst keys of ``multiple_latest``, for a message."""
    return multiple_latest(rows, table).orderBy(F.desc("n_latest"), *table.keys).limit(n)


def no_latest(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """Keys that have versions but no current one."""
    return (
        rows.groupBy(*table.keys)
        .agg(
            F.count(F.lit(1)).alias("n_versions"),
            F.max(table.last_modified).alias("newest"),
            F.bool_or(F.coalesce(F.col(table.is_latest), F.lit(False))).alias("_any"),
        )
        .where(~F.col("_any"))
        .drop("_any")
    )


def violation_report(
    rows: DataFrame,
    table: Scd2Table,
    piece: int = REPORT_PIECE,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Keys with several current rows and the list of their modification stamps.

    Up to ``piece`` stamps go into one row; ``piece_no`` numbers the rows of a key, so
    nothing is cut off and no task has to hold one key's whole list.
    """
    broken = multiple_latest(rows, table).withColumnRenamed("n_latest", "_rows")
    # only rows of broken keys are put in order
    flagged = join_null_safe(
        rows.where(F.col(table.is_latest)), broken.select(*table.keys), table.keys, "left_semi"
    )
    ordered, order = with_total_order(flagged, table)
    numbered = (
        OrderedRows.of(ordered, table.keys, order, max_rows=max_group_rows, counts=broken)
        .positions("_pos")
        .rows()
    )
    return (
        numbered.withColumn("piece_no", F.floor((F.col("_pos") - 1) / piece).cast("bigint") + 1)
        .groupBy(*table.keys, "piece_no")
        .agg(
            F.count(F.lit(1)).alias("n_listed"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_pos", table.last_modified))),
                    lambda item: item[table.last_modified].cast("string"),
                ),
                ", ",
            ).alias("stamps"),
        )
    )


def _superseded(
    rows: DataFrame, table: Scd2Table, max_group_rows: int | None, counts: DataFrame | None = None
) -> DataFrame:
    """Rows with ``_after``: what follows in the key; null for one row of each key, also
    where rows are equal in every column."""
    ordered, order = with_total_order(rows, table)
    return (
        OrderedRows.of(ordered, table.keys, order, max_rows=max_group_rows, counts=counts)
        .next([table.last_modified], "_after")
        .rows()
    )


def repair(
    rows: DataFrame, table: Scd2Table, max_group_rows: int | None = None
) -> DataFrame:
    """Leave the newest of several current rows current, and end the others.

    Of equal rows one stays current. Sound keys and superseded rows pass through; only
    the current rows of keys that break the rule are put in order. A closed row without
    an end gets the modification stamp of the row that stays.
    """
    is_latest = F.coalesce(F.col(table.is_latest), F.lit(False))
    broken = (
        rows.where(is_latest)
        .groupBy(*table.keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max(table.last_modified).alias("_newest"))
        .where(F.col("_rows") > 1)
    )
    # one join marks the rows of broken keys; all others pass
    marked = join_null_safe(
        rows, broken.select(*table.keys, "_newest", F.lit(True).alias("_broken")), table.keys, "left"
    )
    is_unsound = is_latest & F.coalesce(F.col("_broken"), F.lit(False))
    unsound = marked.where(is_unsound).drop("_broken")
    loses = F.col("_after").isNotNull()
    changes = {table.is_latest: ~loses}
    if table.end_date:
        closed = F.coalesce(F.col(table.end_date), F.col("_newest"))
        changes[table.end_date] = F.when(loses, closed).otherwise(F.col(table.end_date))
    counts = broken.select(*table.keys, "_rows")
    repaired = _superseded(unsound, table, max_group_rows, counts).withColumns(changes)
    passing = marked.where(~is_unsound).select(*rows.columns)
    return passing.unionByName(repaired.select(*rows.columns))


def repair_counts(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """``n_keys`` that break the rule and ``n_rows`` whose flag a repair clears."""
    broken = multiple_latest(rows, table)
    return broken.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("n_latest") - 1), F.lit(0)).alias("n_rows"),
    )


def rebuild_flags(
    rows: DataFrame, table: Scd2Table, max_group_rows: int | None = None
) -> DataFrame:
    """Set the flag of every row anew: current is the newest row of its key, one of them
    if several are equal."""
    placed = _superseded(rows, table, max_group_rows)
    return placed.withColumn(table.is_latest, F.col("_after").isNull()).select(*rows.columns)


def recent_sample(rows: DataFrame, table: Scd2Table, n: int = 10) -> DataFrame:
    """The ``n`` most recently modified rows."""
    ordered, order = with_total_order(rows, table)
    return ordered.orderBy(*[F.col(c).desc() for c in order]).limit(n).select(*rows.columns)


def stale_batch_rows(batch: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Batch rows that are older than the version the target holds as current."""
    known = (
        target.where(F.col(table.is_latest))
        .groupBy(*table.keys)
        .agg(F.max(table.last_modified).alias("current_modified"))
    )
    return batch.join(known, list(table.keys), "inner").where(
        F.col(table.last_modified) < F.col("current_modified")
    )


def order_violations(
    rows: DataFrame, table: Scd2Table, load_order: list[str], max_group_rows: int | None = None
) -> DataFrame:
    """Rows processed after a row of the same key that carries a later stamp."""
    stamp = table.last_modified
    before = OrderedRows.of(rows, table.keys, load_order, max_rows=max_group_rows).previous(
        [stamp], "_before"
    )
    return (
        before.rows()
        .withColumn("previous_modified", F.col("_before")[stamp])
        .where(F.col(stamp) < F.col("previous_modified"))
        .drop("_before")
    )


def history_gaps(
    rows: DataFrame, table: Scd2Table, max_group_rows: int | None = None
) -> DataFrame:
    """Versions whose end is not the start of the next version of the key."""
    start, end = table.effective_date, table.end_date
    ordered, order = with_total_order(rows, table)
    following = (
        OrderedRows.of(ordered, table.keys, order, max_rows=max_group_rows)
        .next([start], "_after")
        .rows()
        .where(F.col("_after").isNotNull())
        .withColumn("next_start", F.col("_after")[start])
    )
    kind = (
        F.when(F.col(end).isNull(), "open")
        .when(F.col(end) < F.col("next_start"), "gap")
        .when(F.col(end) > F.col("next_start"), "overlap")
    )
    return (
        following.withColumn("problem", kind)
        .where(F.col("problem").isNotNull())
        .select(*table.keys, start, end, "next_start", "problem")
    )


def null_keys(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """Per key column: rows without a value."""
    return null_counts(rows, table.keys)


def missing_changes(source: DataFrame, target: DataFrame, table: Scd2Table) -> DataFrame:
    """Source versions (keys, stamp) that the target does not hold."""
    identity = [*table.keys, table.last_modified]
    return (
        source.select(*identity)
        .distinct()
        .join(target.select(*identity).distinct(), identity, "left_anti")
    )


def timestamp_ties(rows: DataFrame, table: Scd2Table) -> DataFrame:
    """(keys, stamp) carried by several rows."""
    return (
        rows.groupBy(*table.keys, table.last_modified)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
