"""Reports: every event is one table in one run of the day the event happened on.

The event type decides the outcome and the table type, the user is the table, the number
in the properties the loaded rows, and the value the duration.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Case, load, with_ctes
from suite.partitions import SOURCE, target
from suite.partitions import TARGET as ORDERS_TARGET
from suite.partitions import source as orders
from suite.scd2 import ACCOUNTS, DAMAGED, damaged
from tidemark.config import PartitionTable, StaticTable
from tidemark.functions.canonical import table_fingerprint
from tidemark.operators import quality, report

NOW = "2024-01-31 12:00:00"

LINES = StaticTable("lines", primary_keys=("l_orderkey", "l_linenumber"))
PARTS = StaticTable("parts", primary_keys=("p_partkey",))
ORDERS = PartitionTable("orders", partition_column="cobid")


def run_log(spark, sf):
    kind = (
        F.when(F.col("event_type") == "signup", "static")
        .when(F.col("event_type") == "purchase", "scd")
        .when(F.col("event_type") == "view", "append")
        .otherwise("partition")
    )
    return load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        kind.alias("table_type"),
        (~F.col("event_type").isin("error", "click")).alias("success"),
        F.get_json_object("props", "$.k").cast("bigint").alias("total_records"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("finished_at"),
    )


def marks(df):
    return df.groupBy(F.col("o_orderstatus").alias("table_name")).agg(
        F.max("o_orderdate").alias("high")
    )


def checked_tables(spark, sf):
    return [
        (ACCOUNTS, damaged(spark, sf)),
        (LINES, load(spark, sf, "lineitem")),
        (PARTS, load(spark, sf, "part")),
        (ORDERS, orders(spark, sf)),
    ]


def status(spark, sf):
    by = ["o_orderstatus"]

    def prints(df, name):
        return table_fingerprint(df, by=by).select(
            F.col("o_orderstatus").alias("table_name"), F.col("fingerprint").alias(name)
        )

    loaded = target(spark, sf)
    states = loaded.groupBy(F.col("o_orderstatus").alias("table_name")).agg(
        F.max("o_orderdate").alias("last_value"), F.count(F.lit(1)).alias("records")
    )
    last = states.select("table_name", "last_value")
    pending = (
        orders(spark, sf)
        .withColumnRenamed("o_orderstatus", "table_name")
        .join(last, "table_name")
        .groupBy("table_name")
        .agg(F.count_if(F.col("o_orderdate") > F.col("last_value")).alias("n_pending"))
    )
    day = F.col("cobid")
    stored = orders(spark, sf).where((day <= 19991231) & ~day.between(19970601, 19970630))
    consistency = prints(stored, "stored_fingerprint").join(
        prints(loaded, "target_fingerprint"), "table_name"
    )
    return report.pipeline_status(states, pending, consistency)


LOG = """run_log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'user_' || user_id AS table_name,
         CASE event_type WHEN 'signup' THEN 'static' WHEN 'purchase' THEN 'scd' WHEN 'view' THEN 'append' ELSE 'partition' END AS table_type,
         event_type NOT IN ('error', 'click') AS success, CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_records,
         CAST(value AS DECIMAL(18,3)) AS duration_seconds, ts AS finished_at FROM events)"""
COUNTED = """counted AS (
  SELECT 'accounts' AS table_name, 'multiple_latest' AS rule, 'customer,channel' AS column_name,
         (SELECT count(*) FROM (SELECT 1 FROM damaged WHERE is_latest GROUP BY customer, channel HAVING count(*) > 1)) AS n
  UNION ALL
  SELECT 'accounts', 'no_latest', 'customer,channel',
         (SELECT count(*) FROM (SELECT 1 FROM damaged GROUP BY customer, channel HAVING NOT bool_or(is_latest)))
  UNION ALL
  SELECT 'lines', 'duplicate_key', 'l_orderkey,l_linenumber',
         (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL
  SELECT 'parts', 'duplicate_key', 'p_partkey',
         (SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1))
  UNION ALL SELECT 'orders', 'null_key', 'cobid', (SELECT count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders))"""

CASES: dict[str, Case] = {
    "run_summary": Case(
        lambda spark, sf: report.run_summary(run_log(spark, sf)),
        with_ctes(
            [LOG],
            """SELECT *, CAST(total_records AS DOUBLE) / greatest(total_duration, 0.001) AS records_per_second,
  total_duration / tables_processed AS average_duration, failed_tables = 0 AS all_successful
FROM (SELECT run_id, count(*) AS tables_processed, count(*) FILTER (WHERE success) AS successful_tables,
        count(*) FILTER (WHERE NOT success) AS failed_tables, CAST(sum(total_records) AS BIGINT) AS total_records,
        CAST(sum(duration_seconds) AS DOUBLE) AS total_duration,
        count(*) FILTER (WHERE table_type = 'partition') AS partition_tables, count(*) FILTER (WHERE table_type = 'scd') AS scd_tables,
        count(*) FILTER (WHERE table_type = 'static') AS static_tables,
        count(*) FILTER (WHERE table_type = 'append') AS append_tables FROM run_log GROUP BY run_id)""",
        ),
    ),
    "load_metrics": Case(
        lambda spark, sf: report.load_metrics(run_log(spark, sf)),
        with_ctes(
            [LOG],
            """SELECT table_name, count(*) AS n_runs, count(*) FILTER (WHERE success) AS n_success,
  max(CASE WHEN success THEN finished_at END) AS last_success,
  CAST(count(*) FILTER (WHERE success) AS DOUBLE) / count(*) AS success_rate,
  CAST(sum(CASE WHEN success THEN duration_seconds END) AS DOUBLE) / nullif(count(*) FILTER (WHERE success), 0) AS mean_duration
FROM run_log GROUP BY table_name""",
        ),
    ),
    "load_alerts": Case(
        lambda spark, sf: report.load_alerts(run_log(spark, sf), F.lit(NOW).cast("timestamp_ntz")),
        with_ctes(
            [
                LOG,
                """newest AS (
  SELECT table_name, finished_at AS last_success, duration_seconds AS last_seconds FROM run_log WHERE success
  QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY finished_at DESC, duration_seconds DESC) = 1)""",
                """facts AS (
  SELECT l.table_name, n.last_success, n.last_seconds,
         count(*) FILTER (WHERE NOT success AND (n.last_success IS NULL OR finished_at > n.last_success)) AS failures,
         count(*) FILTER (WHERE success) AS n_good, sum(CASE WHEN success THEN duration_seconds END) AS seconds
  FROM run_log l LEFT JOIN newest n ON n.table_name = l.table_name
  GROUP BY l.table_name, n.last_success, n.last_seconds)""",
            ],
            f"""SELECT table_name, 'critical' AS severity, 'failed_after_retries' AS alert FROM facts WHERE failures >= 3
UNION ALL SELECT table_name, 'critical', 'no_recent_load' FROM facts
WHERE last_success IS NULL OR last_success <= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR
UNION ALL SELECT table_name, 'warning', 'slow_load' FROM facts
WHERE n_good > 1 AND CAST(last_seconds AS DOUBLE) > 5 * CAST(seconds - last_seconds AS DOUBLE) / (n_good - 1)""",
        ),
    ),
    "data_freshness": Case(
        lambda spark, sf: report.data_freshness(marks(orders(spark, sf)), marks(target(spark, sf))),
        with_ctes(
            [SOURCE, ORDERS_TARGET],
            """SELECT s.table_name, source_high, target_high, date_diff('day', target_high, source_high) AS days_behind
FROM (SELECT o_orderstatus AS table_name, max(o_orderdate) AS source_high FROM source GROUP BY 1) s
LEFT JOIN (SELECT o_orderstatus AS table_name, max(o_orderdate) AS target_high FROM target GROUP BY 1) t
  ON s.table_name = t.table_name""",
        ),
    ),
    "pipeline_status": Case(
        status,
        with_ctes(
            [
                SOURCE,
                ORDERS_TARGET,
                "stored AS (SELECT * FROM source WHERE cobid <= 19991231 AND cobid NOT BETWEEN 19970601 AND 19970630)",
                "states AS (SELECT o_orderstatus AS table_name, max(o_orderdate) AS last_value, count(*) AS records FROM target GROUP BY 1)",
            ],
            """SELECT s.*, (SELECT count(*) FROM source o WHERE o.o_orderstatus = s.table_name AND o.o_orderdate > s.last_value) AS n_pending,
  CASE WHEN EXISTS (
    (SELECT * FROM stored x WHERE x.o_orderstatus = s.table_name EXCEPT ALL SELECT * FROM target y WHERE y.o_orderstatus = s.table_name)
    UNION ALL
    (SELECT * FROM target y WHERE y.o_orderstatus = s.table_name EXCEPT ALL SELECT * FROM stored x WHERE x.o_orderstatus = s.table_name))
  THEN 'inconsistent' ELSE 'consistent' END AS consistency FROM states s""",
        ),
    ),
    "validate_all": Case(
        lambda spark, sf: quality.validate_all(checked_tables(spark, sf)),
        with_ctes([*DAMAGED, COUNTED], "SELECT * FROM counted WHERE n > 0"),
    ),
    "validation_summary": Case(
        lambda spark, sf: quality.validation_summary(checked_tables(spark, sf)),
        with_ctes(
            [*DAMAGED, COUNTED],
            """SELECT count(*) AS total_tables, count(*) FILTER (WHERE valid) AS valid_tables, count(*) FILTER (WHERE NOT valid) AS invalid_tables
FROM (SELECT max(n) = 0 AS valid FROM counted GROUP BY table_name)""",
        ),
    ),
}
