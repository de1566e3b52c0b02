"""High-water marks: what was loaded, what waits, and which range comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import OrderedRows, latest_per_key
from tidemark.sources.tables import typed_lit


def high_watermark(df: DataFrame, column: str, default: Column | None = None) -> DataFrame:
    """One row, ``high``: the largest value, or ``default`` for an empty table."""
    high = F.max(column)
    return df.agg((high if default is None else F.coalesce(high, default)).alias("high"))


def timestamp_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row, ``low`` and ``high``: the range of the non-null values."""
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def pending_count(df: DataFrame, column: str, last) -> DataFrame:
    """One row, ``n_pending``: rows above the mark; every row if nothing was loaded."""
    waits = F.col(column).isNotNull() if last is None else F.col(column) > typed_lit(df, column, last)
    return df.agg(F.count_if(waits).alias("n_pending"))


def last_n_days(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows of the ``days`` before the newest value, for a first load."""
    newest = df.agg(F.max(column).alias("high")).first()["high"]
    if newest is None:
        return df
    return df.where(F.col(column) > typed_lit(df, column, newest) - F.make_dt_interval(F.lit(days)))


def processing_range(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """One row: ``low`` (exclusive), ``high`` (inclusive) and the ``reason``.

    A first load has no lower bound, so that the oldest rows are part of it.
    """
    both = source.select(F.lit(True).alias("_source"), F.col(column).alias("_value")).unionByName(
        target.select(F.lit(False).alias("_source"), F.col(column).alias("_value"))
    )
    marks = both.agg(
        F.max(F.when(F.col("_source"), F.col("_value"))).alias("high"),
        F.max(F.when(~F.col("_source"), F.col("_value"))).alias("low"),
    )
    reason = (
        F.when(F.col("high").isNull(), "no_data_in_source")
        .when(F.col("low").isNull(), "initial_load")
        .when(F.col("high") > F.col("low"), "incremental_update")
        .otherwise("no_new_records")
    )
    return marks.select("low", "high", reason.alias("reason"))


def latest_state(states: DataFrame) -> DataFrame:
    """The newest state row of every table."""
    return latest_per_key(states, ["table_name"], ["updated_at", "load_id"])


def detected_state(rows: DataFrame, table_column: str, column: str) -> DataFrame:
    """State read off the data itself: ``table_name, last_value, n_rows``."""
    return rows.groupBy(F.col(table_column).alias("table_name")).agg(
        F.max(column).alias("last_value"), F.count(F.lit(1)).alias("n_rows")
    )


def reconcile_state(marks: DataFrame) -> DataFrame:
    """The safe mark of every table from ``table_name, origin, last_value`` rows.

    The least known value wins, so at worst rows are loaded again and never left out.
    Origins without a value are listed as known to be empty, and do not win.
    """
    known = F.when(F.col("last_value").isNotNull(), F.struct("last_value", "origin"))
    return (
        marks.groupBy("table_name")
        .agg(
            F.min(known).alias("_least"),
            F.array_join(
                F.array_sort(
                    F.collect_set(F.when(F.col("last_value").isNotNull(), F.col("origin")))
                ),
                ",",
            ).alias("known_origins"),
        )
        .select(
            "table_name",
            F.col("_least.last_value").alias("last_value"),
            F.col("_least.origin").alias("decided_by"),
            "known_origins",
        )
    )


def timestamp_gaps(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Stretches of days without any row: ``*by, last_seen, next_seen, n_missing``.

    Days are dates of the stamps, so no time zone takes part.
    """
    seen = df.where(F.col(column).isNotNull()).select(
        *by, F.col(column).cast("date").alias("last_seen")
    )
    following = (
        OrderedRows.of(seen.distinct(), by, ["last_seen"]).next(["last_seen"], "_after").rows()
    )
    between = F.date_diff("next_seen", "last_seen").cast("bigint") - 1
    return (
        following.withColumn("next_seen", F.col("_after.last_seen"))
        .withColumn("n_missing", between)
        .where(F.col("n_missing") > 0)
        .select(*by, "last_seen", "next_seen", "n_missing")
    )
