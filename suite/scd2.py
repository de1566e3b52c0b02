"""Versioned tables: customer accounts per order channel, and users by last action.

An account is (customer, order priority); its status is that of its newest order.
The target holds the history up to ``CUTOFF``, the batch is everything after it. Users
have deep histories: their tracked attribute is the type of their last event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.base import Case, load, with_ctes
from tidemark.config import Scd2Table
from tidemark.operators import scd2, scd2_checks

CUTOFF = "1998-04-15"
LATE_FROM, LATE_TO = "1997-01-01", "1997-12-31"
MOMENT = "1997-06-30"

ACCOUNTS = Scd2Table(
    table="accounts",
    keys=("customer", "channel"),
    last_modified="modified",
    is_latest="is_latest",
    effective_date="valid_from",
    end_date="valid_to",
    tracked=("status",),
    tie_break=("order_no",),
)
USERS = Scd2Table(
    table="users",
    keys=("user_id",),
    last_modified="modified",
    is_latest="is_latest",
    effective_date="valid_from",
    end_date="valid_to",
    tracked=("action",),
    tie_break=("event_no",),
)


# Five keys, each with a fifth of all rows, cut into slices of at most this many rows.
HOT_ROWS = 1500
AMOUNTS = Scd2Table(
    table="amounts",
    keys=("action",),
    last_modified="modified",
    is_latest="is_latest",
    effective_date="valid_from",
    end_date="valid_to",
    tracked=("band",),
    tie_break=("event_no",),
)


def stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("modified"),
        F.col("o_orderkey").alias("order_no"),
    )


def batch(spark, sf):
    return changes(spark, sf).where(F.col("modified") >= stamp(CUTOFF))


def target(spark, sf):
    return scd2.full_history(changes(spark, sf).where(F.col("modified") < stamp(CUTOFF)), ACCOUNTS)


def user_changes(spark, sf):
    return load(spark, sf, "events").select(
        "user_id",
        F.col("event_type").alias("action"),
        F.col("ts").alias("modified"),
        F.col("event_id").alias("event_no"),
    )


def amount_changes(spark, sf):
    value = F.col("value")
    return load(spark, sf, "events").select(
        F.col("event_type").alias("action"),
        F.when(value < 20, "low").when(value < 80, "middle").otherwise("high").alias("band"),
        F.col("ts").alias("modified"),
        F.col("event_id").alias("event_no"),
    )


def damaged(spark, sf):
    """History whose flags were set wrongly by hand, both ways."""
    flag = (
        F.when((F.col("status") == "P"), True)
        .when((F.col("channel") == "3-MEDIUM") & (F.col("status") == "F"), False)
        .otherwise(F.col("is_latest"))
    )
    return scd2.full_history(changes(spark, sf), ACCOUNTS).withColumn("is_latest", flag)


def repeated(spark, sf):
    """The damaged history with some rows in it twice."""
    rows = damaged(spark, sf)
    return rows.unionByName(rows.where(F.col("status") != "O"))


CHANGES = """changes AS (
  SELECT o_custkey AS customer, o_orderpriority AS channel, o_orderstatus AS status,
         o_orderdate AS modified, o_orderkey AS order_no
  FROM orders)"""
USER_CHANGES = """user_changes AS (
  SELECT user_id, event_type AS action, ts AS modified, event_id AS event_no FROM events)"""


AMOUNT_CHANGES = """amount_changes AS (
  SELECT event_type AS action, CASE WHEN value < 20 THEN 'low' WHEN value < 80 THEN 'middle' ELSE 'high' END AS band,
         ts AS modified, event_id AS event_no FROM events)"""


def history_ctes(source: str, out: str, keys: str, tracked: str, tie: str) -> list[str]:
    """Full history by definition: one row per stamp, repeats out, end = next start."""
    return [
        f"""{out}_ids AS (
  SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY {keys}, modified ORDER BY {tie} DESC) = 1)""",
        f"""{out}_runs AS (
  SELECT *, lag({tracked}) OVER (PARTITION BY {keys} ORDER BY modified) AS was,
         row_number() OVER (PARTITION BY {keys} ORDER BY modified) AS nth FROM {out}_ids)""",
        f"""{out} AS (
  SELECT {keys}, {tracked}, modified, {tie},
         lead(modified) OVER (PARTITION BY {keys} ORDER BY modified) IS NULL AS is_latest,
         modified AS valid_from,
         lead(modified) OVER (PARTITION BY {keys} ORDER BY modified) AS valid_to
  FROM {out}_runs WHERE nth = 1 OR {tracked} IS DISTINCT FROM was)""",
    ]


def account_history(out: str, condition: str = "TRUE") -> list[str]:
    return history_ctes(
        f"SELECT * FROM changes WHERE {condition}", out, "customer, channel", "status", "order_no"
    )


TARGET = [CHANGES, *account_history("target", f"modified < TIMESTAMP '{CUTOFF}'")]
BATCH = f"batch AS (SELECT * FROM changes WHERE modified >= TIMESTAMP '{CUTOFF}')"
NEWEST = """newest AS (
  SELECT * FROM batch QUALIFY row_number() OVER (
    PARTITION BY customer, channel ORDER BY modified DESC, order_no DESC) = 1)"""
CLASSIFIED = """classified AS (
  SELECT n.*, CASE WHEN t.customer IS NULL THEN 'new'
                   WHEN n.status IS DISTINCT FROM t.status THEN 'updated'
                   ELSE 'unchanged' END AS change
  FROM newest n LEFT JOIN (SELECT * FROM target WHERE is_latest) t
    ON n.customer = t.customer AND n.channel = t.channel)"""
APPLY = [*TARGET, BATCH, NEWEST, CLASSIFIED]
COLUMNS = "customer, channel, status, modified, order_no, is_latest, valid_from, valid_to"
EXPIRED = """expired AS (
  SELECT t.customer, t.channel, t.status, t.modified, t.order_no, FALSE AS is_latest,
         t.valid_from, c.modified AS valid_to
  FROM target t JOIN classified c ON t.customer = c.customer AND t.channel = c.channel
  WHERE t.is_latest AND c.change = 'updated')"""
INSERTS = """inserts AS (
  SELECT customer, channel, status, modified, order_no, TRUE AS is_latest,
         modified AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM classified WHERE change <> 'unchanged')"""
DAMAGED = [
    CHANGES,
    *account_history("sound"),
    """damaged AS (
  SELECT customer, channel, status, modified, order_no,
         CASE WHEN status = 'P' THEN TRUE
              WHEN channel = '3-MEDIUM' AND status = 'F' THEN FALSE
              ELSE is_latest END AS is_latest,
         valid_from, valid_to FROM sound)""",
]
REPEATED = """repeated AS (
  SELECT * FROM damaged UNION ALL SELECT * FROM damaged WHERE status <> 'O')"""
CURRENT_RANK = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer, channel, is_latest
                               ORDER BY modified DESC, order_no DESC) AS nth,
         first_value(modified) OVER (PARTITION BY customer, channel, is_latest
                               ORDER BY modified DESC, order_no DESC) AS winner
  FROM damaged)"""

CASES: dict[str, Case] = {
    "scd2_batch_latest": Case(
        lambda spark, sf: scd2.batch_latest(batch(spark, sf), ACCOUNTS),
        with_ctes([CHANGES, BATCH, NEWEST], "SELECT * FROM newest"),
    ),
    "scd2_classify": Case(
        lambda spark, sf: scd2.classify(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes(APPLY, "SELECT * FROM classified"),
    ),
    "scd2_counts": Case(
        lambda spark, sf: scd2.change_counts(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes(APPLY, "SELECT change, count(*) AS n_keys FROM classified GROUP BY change"),
    ),
    "scd2_changed_rows": Case(
        lambda spark, sf: scd2.changed_rows(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes(
            APPLY,
            "SELECT customer, channel, status, modified, order_no FROM classified WHERE change = 'updated'",
        ),
    ),
    "scd2_expired": Case(
        lambda spark, sf: scd2.expired(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes([*APPLY, EXPIRED], "SELECT * FROM expired"),
    ),
    "scd2_inserts": Case(
        lambda spark, sf: scd2.inserts(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes([*APPLY, INSERTS], "SELECT * FROM inserts"),
    ),
    "scd2_apply": Case(
        lambda spark, sf: scd2.apply_batch(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes(
            [*APPLY, EXPIRED, INSERTS],
            f"""SELECT {COLUMNS} FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM expired e WHERE e.customer = t.customer AND e.channel = t.channel AND t.is_latest)
UNION ALL SELECT {COLUMNS} FROM expired UNION ALL SELECT {COLUMNS} FROM inserts""",
        ),
    ),
    "scd2_append_expire": Case(
        lambda spark, sf: scd2.append_and_expire(batch(spark, sf), target(spark, sf), ACCOUNTS),
        with_ctes(
            [*TARGET, BATCH],
            """SELECT t.customer, t.channel, t.status, t.modified, t.order_no,
       t.is_latest AND b.first_at IS NULL AS is_latest, t.valid_from,
       CASE WHEN t.is_latest AND b.first_at IS NOT NULL THEN b.first_at ELSE t.valid_to END AS valid_to
FROM target t LEFT JOIN (SELECT customer, channel, min(modified) AS first_at FROM batch GROUP BY 1, 2) b
  ON t.customer = b.customer AND t.channel = b.channel
UNION ALL
SELECT customer, channel, status, modified, order_no, TRUE, modified, NULL FROM batch""",
        ),
    ),
    "scd2_full_history": Case(
        lambda spark, sf: scd2.full_history(user_changes(spark, sf), USERS),
        with_ctes(
            [
                USER_CHANGES,
                *history_ctes("SELECT * FROM user_changes", "h", "user_id", "action", "event_no"),
            ],
            "SELECT * FROM h",
        ),
    ),
    "scd2_full_history_split_keys": Case(
        lambda spark, sf: scd2.full_history(
            amount_changes(spark, sf), AMOUNTS, max_group_rows=HOT_ROWS
        ),
        with_ctes(
            [
                AMOUNT_CHANGES,
                *history_ctes("SELECT * FROM amount_changes", "h", "action", "band", "event_no"),
            ],
            "SELECT * FROM h",
        ),
    ),
    "backfill_scd": Case(
        lambda spark, sf: scd2.backfill(
            changes(spark, sf),
            scd2.full_history(
                changes(spark, sf).where(
                    (F.col("modified") <= stamp(LATE_FROM)) | (F.col("modified") > stamp(LATE_TO))
                ),
                ACCOUNTS,
            ),
            ACCOUNTS,
            stamp(LATE_FROM),
            stamp(LATE_TO),
        ),
        with_ctes(
            # nothing may differ from the history of a source that was complete at once
            [CHANGES, *account_history("refilled")],
            f"SELECT {COLUMNS} FROM refilled",
        ),
    ),
    "scd2_as_of": Case(
        lambda spark, sf: scd2.as_of(
            scd2.full_history(changes(spark, sf), ACCOUNTS), ACCOUNTS, stamp(MOMENT)
        ),
        with_ctes(
            [CHANGES, *account_history("h")],
            f"""SELECT {COLUMNS} FROM h WHERE valid_from <= TIMESTAMP '{MOMENT}'
AND (valid_to > TIMESTAMP '{MOMENT}' OR valid_to IS NULL)""",
        ),
    ),
    "scd2_current": Case(
        lambda spark, sf: scd2.current(scd2.full_history(user_changes(spark, sf), USERS), USERS),
        with_ctes(
            [
                USER_CHANGES,
                *history_ctes("SELECT * FROM user_changes", "h", "user_id", "action", "event_no"),
            ],
            "SELECT * FROM h WHERE is_latest",
        ),
    ),
    "scd2_multi_latest": Case(
        lambda spark, sf: scd2_checks.multiple_latest(damaged(spark, sf), ACCOUNTS),
        with_ctes(
            DAMAGED,
            """SELECT customer, channel, count(*) AS n_latest FROM damaged WHERE is_latest
GROUP BY customer, channel HAVING count(*) > 1""",
        ),
    ),
    "scd2_first_violations": Case(
        lambda spark, sf: scd2_checks.first_violations(damaged(spark, sf), ACCOUNTS),
        with_ctes(
            DAMAGED,
            """SELECT customer, channel, count(*) AS n_latest FROM damaged WHERE is_latest
GROUP BY customer, channel HAVING count(*) > 1 ORDER BY n_latest DESC, customer, channel LIMIT 10""",
        ),
    ),
    "scd2_no_latest": Case(
        lambda spark, sf: scd2_checks.no_latest(damaged(spark, sf), ACCOUNTS),
        with_ctes(
            DAMAGED,
            """SELECT customer, channel, count(*) AS n_versions, max(modified) AS newest FROM damaged
GROUP BY customer, channel HAVING NOT bool_or(is_latest)""",
        ),
    ),
    "scd2_violation_report": Case(
        lambda spark, sf: scd2_checks.violation_report(damaged(spark, sf), ACCOUNTS),
        with_ctes(
            DAMAGED,
            """SELECT customer, channel, CAST(1 AS BIGINT) AS piece_no, count(*) AS n_listed,
       string_agg(CAST(modified AS VARCHAR), ', ' ORDER BY modified, order_no) AS stamps
FROM damaged WHERE is_latest GROUP BY customer, channel HAVING count(*) > 1""",
        ),
    ),
    "scd2_repair": Case(
        lambda spark, sf: scd2_checks.repair(repeated(spark, sf), ACCOUNTS),
        with_ctes(
            [*DAMAGED, REPEATED, CURRENT_RANK.replace("FROM damaged", "FROM repeated")],
            """SELECT customer, channel, status, modified, order_no, is_latest AND nth = 1 AS is_latest,
       valid_from,
       CASE WHEN is_latest AND nth > 1 THEN coalesce(valid_to, winner) ELSE valid_to END AS valid_to
FROM ranked""",
        ),
    ),
    "scd2_repair_counts": Case(
        lambda spark, sf: scd2_checks.repair_counts(damaged(spark, sf), ACCOUNTS),
        with_ctes(
            DAMAGED,
            """SELECT count(*) AS n_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_rows FROM (
  SELECT count(*) AS n FROM damaged WHERE is_latest GROUP BY customer, channel HAVING count(*) > 1)""",
        ),
    ),
    "scd2_rebuild_flags": Case(
        lambda spark, sf: scd2_checks.rebuild_flags(repeated(spark, sf), ACCOUNTS),
        with_ctes(
            [*DAMAGED, REPEATED],
            """SELECT customer, channel, status, modified, order_no,
       row_number() OVER (PARTITION BY customer, channel ORDER BY modified DESC, order_no DESC) = 1 AS is_latest,
       valid_from, valid_to FROM repeated""",
        ),
    ),
    "scd2_recent_sample": Case(
        lambda spark, sf: scd2_checks.recent_sample(changes(spark, sf), ACCOUNTS),
        with_ctes([CHANGES], "SELECT * FROM changes ORDER BY modified DESC, order_no DESC LIMIT 10"),
    ),
    "scd2_stale_rows": Case(
        lambda spark, sf: scd2_checks.stale_batch_rows(
            changes(spark, sf), target(spark, sf), ACCOUNTS
        ),
        with_ctes(
            TARGET,
            """SELECT c.customer, c.channel, c.status, c.modified, c.order_no, t.modified AS current_modified
FROM changes c JOIN target t ON c.customer = t.customer AND c.channel = t.channel
WHERE t.is_latest AND c.modified < t.modified""",
        ),
    ),
    "scd2_temporal_violations": Case(
        lambda spark, sf: scd2_checks.order_violations(changes(spark, sf), ACCOUNTS, ["order_no"]),
        with_ctes(
            [CHANGES],
            """SELECT * FROM (SELECT *, lag(modified) OVER (
  PARTITION BY customer, channel ORDER BY order_no) AS previous_modified FROM changes)
WHERE modified < previous_modified""",
        ),
    ),
    "scd2_history_gaps": Case(
        # the history after applying a batch to a target whose ends were moved
        lambda spark, sf: scd2_checks.history_gaps(
            scd2.full_history(changes(spark, sf), ACCOUNTS).withColumn(
                "valid_to",
                F.when(F.col("status") == "F", F.col("valid_to") - F.expr("INTERVAL 1 DAY"))
                .when(F.col("status") == "O", F.col("valid_to") + F.expr("INTERVAL 1 DAY"))
                .when(F.col("channel") != "5-LOW", F.col("valid_to")),
            ),
            ACCOUNTS,
        ),
        with_ctes(
            [
                CHANGES,
                *account_history("h"),
                """moved AS (
  SELECT * REPLACE (CASE WHEN status = 'F' THEN valid_to - INTERVAL 1 DAY
                         WHEN status = 'O' THEN valid_to + INTERVAL 1 DAY
                         WHEN channel <> '5-LOW' THEN valid_to END AS valid_to) FROM h)""",
                """paired AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer, channel ORDER BY modified, order_no) AS next_start
  FROM moved)""",
            ],
            """SELECT customer, channel, valid_from, valid_to, next_start,
       CASE WHEN valid_to IS NULL THEN 'open' WHEN valid_to < next_start THEN 'gap' ELSE 'overlap' END AS problem
FROM paired WHERE next_start IS NOT NULL AND valid_to IS DISTINCT FROM next_start""",
        ),
    ),
    "scd2_null_keys": Case(
        lambda spark, sf: scd2_checks.null_keys(
            changes(spark, sf).withColumn("channel", F.nullif("channel", F.lit("5-LOW"))), ACCOUNTS
        ),
        with_ctes(
            [CHANGES],
            """SELECT 'customer' AS column_name, count(*) FILTER (WHERE customer IS NULL) AS n_nulls FROM changes
UNION ALL SELECT 'channel', count(*) FILTER (WHERE nullif(channel, '5-LOW') IS NULL) FROM changes""",
        ),
    ),
    "scd2_missing_changes": Case(
        lambda spark, sf: scd2_checks.missing_changes(
            scd2.full_history(changes(spark, sf), ACCOUNTS), target(spark, sf), ACCOUNTS
        ),
        with_ctes(
            [*TARGET, *account_history("h")],
            """SELECT DISTINCT customer, channel, modified FROM h c WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.customer = c.customer AND t.channel = c.channel AND t.modified = c.modified)""",
        ),
    ),
    "scd2_timestamp_ties": Case(
        lambda spark, sf: scd2_checks.timestamp_ties(changes(spark, sf), ACCOUNTS),
        with_ctes(
            [CHANGES],
            """SELECT customer, channel, modified, count(*) AS n_rows FROM changes
GROUP BY customer, channel, modified HAVING count(*) > 1""",
        ),
    ),
}
