"""Reports over the run log and the load states.

A run log row is one table in one run: ``run_id, table_name, table_type, success,
total_records, duration_seconds, finished_at``. Durations are added as exact decimals, so
a report does not depend on the order the rows are read in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Table types, and the thresholds of the alert rules.
TABLE_TYPES = ("partition", "scd", "static", "append")
SILENT_HOURS = 24
SLOW_FACTOR = 5.0
MIN_SECONDS = 0.001


def _seconds() -> Column:
    return F.col("duration_seconds").cast("decimal(18,3)")


def _total_seconds() -> Column:
    return F.sum(_seconds()).cast("double")


def run_summary(run_log: DataFrame) -> DataFrame:
    """One row per run: tables by outcome and type, rows, duration, speed."""
    return (
        run_log.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("tables_processed"),
            F.count_if("success").alias("successful_tables"),
            F.count_if(~F.col("success")).alias("failed_tables"),
            F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
            _total_seconds().alias("total_duration"),
            *[F.count_if(F.col("table_type") == t).alias(f"{t}_tables") for t in TABLE_TYPES],
        )
        .withColumn(
            "records_per_second",
            F.col("total_records").cast("double")
            / F.greatest(F.col("total_duration"), F.lit(MIN_SECONDS)),
        )
        .withColumn("average_duration", F.col("total_duration") / F.col("tables_processed"))
        .withColumn("all_successful", F.col("failed_tables") == 0)
    )


def load_metrics(run_log: DataFrame) -> DataFrame:
    """Per table: runs, success rate, mean duration of the successful ones, last success."""
    good = F.col("success")
    return (
        run_log.groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.count_if(good).alias("n_success"),
            F.sum(F.when(good, _seconds())).cast("double").alias("_seconds"),
            F.max(F.when(good, F.col("finished_at"))).alias("last_success"),
        )
        .withColumn("success_rate", F.col("n_success").cast("double") / F.col("n_runs"))
        .withColumn("mean_duration", F.try_divide("_seconds", F.col("n_success").cast("double")))
        .drop("_seconds")
    )


def data_freshness(source_marks: DataFrame, target_marks: DataFrame) -> DataFrame:
    """Per table: newest value on both sides and the days between.

    Both inputs have ``table_name, high``.
    """
    target = target_marks.select("table_name", F.col("high").alias("target_high"))
    return (
        source_marks.select("table_name", F.col("high").alias("source_high"))
        .join(target, "table_name", "left")
        .withColumn("days_behind", F.date_diff("source_high", "target_high").cast("bigint"))
    )


def load_alerts(run_log: DataFrame, now: Column, retries: int = 3) -> DataFrame:
    """``table_name, severity, alert`` for every rule a table breaks.

    - failed_after_retries: at least ``retries`` failures since the last success
    - no_recent_load: no success in the last 24 hours
    - slow_load: the newest success took over five times the mean of those before it
    """
    good = F.col("success")
    newest = F.max(F.when(good, F.struct("finished_at", _seconds().alias("seconds"))))
    per_table = run_log.groupBy("table_name").agg(
        newest.alias("_newest"),
        F.count_if(good).alias("_n_good"),
        F.sum(F.when(good, _seconds())).alias("_seconds"),
    )
    last = per_table.select("table_name", F.col("_newest.finished_at").alias("_last_success"))
    since = (
        run_log.where(~good)
        .join(last, "table_name")
        .where(F.col("_last_success").isNull() | (F.col("finished_at") > F.col("_last_success")))
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("_failures"))
    )
    joined = per_table.join(since, "table_name", "left")
    limit = now - F.make_dt_interval(hours=F.lit(SILENT_HOURS))
    silent = F.col("_newest").isNull() | (F.col("_newest.finished_at") <= limit)
    earlier = (F.col("_seconds") - F.col("_newest.seconds")).cast("double")
    mean_before = F.try_divide(earlier, (F.col("_n_good") - 1).cast("double"))
    slow = F.col("_newest.seconds").cast("double") > mean_before * SLOW_FACTOR

    def alert(condition: Column, severity: str, name: str) -> Column:
        entry = F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("alert"))
        return F.when(condition, entry)

    alerts = F.array_compact(
        F.array(
            alert(F.col("_failures") >= retries, "critical", "failed_after_retries"),
            alert(silent, "critical", "no_recent_load"),
            alert(slow, "warning", "slow_load"),
        )
    )
    return joined.select("table_name", F.inline(alerts))


def pipeline_status(states: DataFrame, pending: DataFrame, consistency: DataFrame) -> DataFrame:
    """Per table: last state, rows that wait, and whether stored and target agree.

    ``states`` is the newest state row per table (``table_name, last_value, updated_at,
    records``); ``pending`` has ``table_name, n_pending``; ``consistency`` has
    ``table_name, stored_fingerprint, target_fingerprint``. A table without a pending row
    has a null count, and one without fingerprints is "unknown": neither was looked at.
    """
    stored, target = F.col("stored_fingerprint"), F.col("target_fingerprint")
    return (
        states.join(pending, "table_name", "left")
        .join(consistency, "table_name", "left")
        .select(
            *states.columns,
            "n_pending",
            F.when(stored.isNull() & target.isNull(), "unknown")
            .when(stored.eqNullSafe(target), "consistent")
            .otherwise("inconsistent")
            .alias("consistency"),
        )
    )
