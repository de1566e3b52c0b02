"""Partition tables and high-water marks: orders by day, as YYYYMMDD numbers.

The target was loaded up to 1999 and lost June 1997; the stored files lack 1998.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Case, load, with_ctes
from tidemark.operators import partitions, watermark
from tidemark.sources import tables

DAY = "cobid"
LAST = 19991231
GAP = (19970601, 19970630)
STORED_GAP = (19980101, 19981231)
BACKFILL = (19970615, 19970715)
YEARS = [19960101, 19970101, 19980101, 19990101, 20000101, 20010101, 20020101]


def day_number(column: str):
    c = F.col(column)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def source(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderdate",
        day_number("o_orderdate").alias(DAY),
    )


def target(spark, sf):
    """Loaded to the mark, with a lost month and prices of one day rewritten."""
    day = F.col(DAY)
    wrong = (F.month("o_orderdate") == 5) & (F.col("o_orderstatus") == "F")
    return (
        source(spark, sf)
        .where((day <= LAST) & ~day.between(*GAP))
        .withColumn(
            "o_totalprice",
            F.when(wrong, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("o_totalprice")),
        )
    )


def stored(spark, sf):
    day = F.col(DAY)
    return source(spark, sf).where((day <= LAST) & ~day.between(*STORED_GAP))


def shipped(spark, sf):
    return load(spark, sf, "lineitem").withColumn(DAY, day_number("l_shipdate"))


def within(df, column: str, first: str | None = None, last: str | None = None):
    """Rows of whole days, both ends included, by literals on the date itself.

    The day number is computed, so a condition on it does not reach the scan; this one does.
    """
    kind = df.schema[column].dataType
    if first is not None:
        df = df.where(F.col(column) >= F.lit(first).cast(kind))
    if last is not None:
        df = df.where(F.col(column) < F.date_add(F.lit(last).cast("date"), 1).cast(kind))
    return df


def visible(df):
    """Decimals as text: both engines then return the same value type."""
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


def marks(spark, sf):
    """Per priority, marks from three places; one place knows nothing of one table."""
    orders = load(spark, sf, "orders")
    place = (
        F.when(F.col("o_orderstatus") == "F", "recorded")
        .when(F.col("o_orderstatus") == "O", "stored")
        .otherwise("target")
    )
    known = F.when(
        ~((F.col("origin") == "stored") & (F.col("table_name") == "5-LOW")), F.col("o_orderdate")
    )
    return (
        orders.select(F.col("o_orderpriority").alias("table_name"), place.alias("origin"), "o_orderdate")
        .groupBy("table_name", "origin")
        .agg(F.max(known).alias("last_value"))
    )


def states(spark, sf):
    """Every event as a state row its type's table wrote."""
    return load(spark, sf, "events").select(
        F.col("event_type").alias("table_name"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("load_id"),
        F.col("user_id").alias("last_value"),
    )


SOURCE = """source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS cobid
  FROM orders)"""
TARGET = f"""target AS (
  SELECT * REPLACE (CASE WHEN month(o_orderdate) = 5 AND o_orderstatus = 'F' THEN 0.00
                         ELSE o_totalprice END::DECIMAL(18,2) AS o_totalprice)
  FROM source WHERE cobid <= {LAST} AND cobid NOT BETWEEN {GAP[0]} AND {GAP[1]})"""
STORED = f"""stored AS (
  SELECT * FROM source WHERE cobid <= {LAST} AND cobid NOT BETWEEN {STORED_GAP[0]} AND {STORED_GAP[1]})"""
SHIPPED = """shipped AS (
  SELECT *, CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS cobid
  FROM lineitem)"""
NUMBERED = (
    "numbered AS (SELECT cobid, count(*) AS row_count, 1 + "
    + " + ".join(f"CAST(cobid >= {y} AS BIGINT)" for y in YEARS)
    + " AS partition_number FROM shipped GROUP BY cobid)"
)
EDGES = "edges AS (" + " UNION ALL ".join(
    f"SELECT CAST({n} AS BIGINT) AS partition_number, CAST({edge} AS INTEGER) AS boundary_value"
    for n, edge in enumerate(["NULL", *YEARS], start=1)
) + ")"
INVENTORY = """inventory AS (
  SELECT e.partition_number, CAST(coalesce(sum(n.row_count), 0) AS BIGINT) AS row_count, e.boundary_value
  FROM edges e LEFT JOIN numbered n ON n.partition_number = e.partition_number
  GROUP BY e.partition_number, e.boundary_value)"""
CANONICAL = """concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
  CAST(o_totalprice AS VARCHAR), CAST(o_orderdate AS VARCHAR), CAST(cobid AS VARCHAR))"""


def fingerprints(side: str) -> str:
    number = f"CAST('0x' || substr(sha256({CANONICAL}), 1, 15) AS BIGINT)"
    return f"""{side}_prints AS (
  SELECT cobid, count(*) AS n, CAST(sum(CAST({number} AS HUGEINT)) AS VARCHAR) AS f FROM {side} GROUP BY cobid)"""


COMPARED = [
    SOURCE,
    TARGET,
    fingerprints("source"),
    fingerprints("target"),
    """compared AS (
  SELECT coalesce(s.cobid, t.cobid) AS cobid, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
         coalesce(s.f, '0') AS source_fingerprint, coalesce(t.f, '0') AS target_fingerprint
  FROM source_prints s FULL JOIN target_prints t ON s.cobid = t.cobid)""",
]
VISIBLE = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderdate, cobid"


def inventory(spark, sf):
    return partitions.partition_inventory(shipped(spark, sf), DAY, YEARS)


CASES: dict[str, Case] = {
    "full_scan": Case(
        lambda spark, sf: load(spark, sf, "orders"),
        "SELECT * FROM orders",
    ),
    "partition_scan": Case(
        lambda spark, sf: tables.partition_rows(
            within(shipped(spark, sf), "l_shipdate", "1997-06-15", "1997-06-15"), DAY, 19970615
        ),
        with_ctes([SHIPPED], "SELECT * FROM shipped WHERE cobid = 19970615"),
    ),
    "range_scan": Case(
        lambda spark, sf: tables.range_rows(
            load(spark, sf, "lineitem"),
            "l_shipdate",
            F.lit("1997-01-31").cast("timestamp_ntz"),
            F.lit("1997-02-28").cast("timestamp_ntz"),
        ),
        """SELECT * FROM lineitem
WHERE l_shipdate > TIMESTAMP '1997-01-31' AND l_shipdate <= TIMESTAMP '1997-02-28'""",
    ),
    "incremental_scan": Case(
        lambda spark, sf: visible(
            tables.rows_after(source(spark, sf), target(spark, sf), "o_orderdate")
        ),
        with_ctes(
            [SOURCE, TARGET],
            f"SELECT {VISIBLE} FROM source WHERE o_orderdate > (SELECT max(o_orderdate) FROM target)",
        ),
    ),
    "filtered_scan": Case(
        lambda spark, sf: tables.only(
            load(spark, sf, "lineitem"), "l_returnflag = 'R' AND l_discount > 0.05"
        ),
        "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05",
    ),
    "high_watermark": Case(
        lambda spark, sf: watermark.high_watermark(source(spark, sf), DAY, F.lit(0)),
        with_ctes([SOURCE], "SELECT coalesce(max(cobid), 0) AS high FROM source"),
    ),
    "timestamp_bounds": Case(
        lambda spark, sf: watermark.timestamp_bounds(load(spark, sf, "lineitem"), "l_shipdate"),
        "SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem",
    ),
    "partition_values": Case(
        lambda spark, sf: partitions.partition_values(
            within(shipped(spark, sf), "l_shipdate", "1998-01-01", "1998-12-31"), DAY, *STORED_GAP
        ),
        with_ctes(
            [SHIPPED],
            f"SELECT DISTINCT cobid FROM shipped WHERE cobid BETWEEN {STORED_GAP[0]} AND {STORED_GAP[1]}",
        ),
    ),
    "new_partition_values": Case(
        lambda spark, sf: partitions.new_partition_values(
            within(shipped(spark, sf), "l_shipdate", "1999-12-31"), DAY, LAST
        ),
        with_ctes([SHIPPED], f"SELECT DISTINCT cobid FROM shipped WHERE cobid > {LAST}"),
    ),
    "missing_partitions": Case(
        lambda spark, sf: partitions.missing_partitions(source(spark, sf), target(spark, sf), DAY),
        with_ctes(
            [SOURCE, TARGET],
            "SELECT DISTINCT cobid FROM source WHERE cobid NOT IN (SELECT cobid FROM target)",
        ),
    ),
    "initial_last_n_partitions": Case(
        lambda spark, sf: partitions.last_n_partitions(shipped(spark, sf), DAY, 10),
        with_ctes(
            [SHIPPED],
            """SELECT * FROM shipped WHERE cobid IN (
  SELECT DISTINCT cobid FROM shipped ORDER BY cobid DESC LIMIT 10)""",
        ),
    ),
    "initial_last_n_days": Case(
        lambda spark, sf: watermark.last_n_days(load(spark, sf, "events"), "ts", 7),
        "SELECT * FROM events WHERE ts > (SELECT max(ts) - INTERVAL 7 DAY FROM events)",
    ),
    "pending_count": Case(
        lambda spark, sf: watermark.pending_count(shipped(spark, sf), DAY, LAST),
        with_ctes([SHIPPED], f"SELECT count(*) FILTER (WHERE cobid > {LAST}) AS n_pending FROM shipped"),
    ),
    "processing_range": Case(
        lambda spark, sf: watermark.processing_range(
            source(spark, sf), target(spark, sf), "o_orderdate"
        ),
        with_ctes(
            [SOURCE, TARGET],
            """SELECT *, CASE WHEN high IS NULL THEN 'no_data_in_source' WHEN low IS NULL THEN 'initial_load'
  WHEN high > low THEN 'incremental_update' ELSE 'no_new_records' END AS reason
FROM (SELECT (SELECT max(o_orderdate) FROM target) AS low, (SELECT max(o_orderdate) FROM source) AS high)""",
        ),
    ),
    "value_inventory": Case(
        lambda spark, sf: partitions.value_inventory(shipped(spark, sf), DAY),
        with_ctes(
            [SHIPPED],
            """SELECT cobid, count(*) AS row_count, dense_rank() OVER (ORDER BY cobid) AS partition_number
FROM shipped GROUP BY cobid""",
        ),
    ),
    "partition_inventory": Case(
        inventory, with_ctes([SHIPPED, NUMBERED, EDGES, INVENTORY], "SELECT * FROM inventory")
    ),
    "partition_number": Case(
        lambda spark, sf: partitions.partition_numbers(shipped(spark, sf), DAY, YEARS),
        with_ctes([SHIPPED, NUMBERED], "SELECT * FROM numbered"),
    ),
    "partition_number_by_table": Case(
        lambda spark, sf: partitions.partition_numbers_by(
            shipped(spark, sf), DAY, shipped(spark, sf).where(F.col(DAY) % 100 == 1).select(DAY)
        ),
        with_ctes(
            [SHIPPED],
            """SELECT v.cobid, v.row_count, 1 + count(b.cobid) AS partition_number
FROM (SELECT cobid, count(*) AS row_count FROM shipped GROUP BY cobid) v
LEFT JOIN (SELECT DISTINCT cobid FROM shipped WHERE cobid % 100 = 1) b ON b.cobid <= v.cobid
GROUP BY v.cobid, v.row_count""",
        ),
    ),
    "partitions_to_process": Case(
        lambda spark, sf: partitions.partitions_to_process(inventory(spark, sf), LAST),
        with_ctes(
            [SHIPPED, NUMBERED, EDGES, INVENTORY],
            f"SELECT * FROM inventory WHERE boundary_value IS NULL OR boundary_value > {LAST}",
        ),
    ),
    "backfill_partitions": Case(
        lambda spark, sf: visible(
            partitions.replace_partitions(
                target(spark, sf),
                partitions.backfill_rows(
                    within(source(spark, sf), "o_orderdate", "1997-06-15", "1997-07-15"), DAY, *BACKFILL
                ),
                DAY,
            )
        ),
        with_ctes(
            [SOURCE, TARGET],
            f"""SELECT {VISIBLE} FROM target WHERE cobid NOT BETWEEN {BACKFILL[0]} AND {BACKFILL[1]}
UNION ALL SELECT {VISIBLE} FROM source WHERE cobid BETWEEN {BACKFILL[0]} AND {BACKFILL[1]}""",
        ),
    ),
    "partition_replace": Case(
        lambda spark, sf: visible(
            partitions.replace_partitions(
                target(spark, sf),
                source(spark, sf).where(F.month("o_orderdate") == 5),
                DAY,
            )
        ),
        with_ctes(
            [SOURCE, TARGET],
            f"""SELECT {VISIBLE} FROM target WHERE cobid NOT IN (SELECT cobid FROM source WHERE month(o_orderdate) = 5)
UNION ALL SELECT {VISIBLE} FROM source WHERE month(o_orderdate) = 5""",
        ),
    ),
    "partition_alignment": Case(
        lambda spark, sf: partitions.partition_alignment(
            shipped(spark, sf), DAY, [19970101, 19970102, 19970103]
        ),
        with_ctes(
            [SHIPPED],
            """SELECT count(*) AS n_rows, count(*) FILTER (WHERE cobid NOT IN (19970101, 19970102, 19970103)) AS n_misaligned,
       bool_and(cobid IN (19970101, 19970102, 19970103)) AS aligned
FROM shipped""",
        ),
    ),
    "reconcile_state": Case(
        lambda spark, sf: watermark.reconcile_state(marks(spark, sf)),
        """WITH marks AS (
  SELECT o_orderpriority AS table_name,
         CASE o_orderstatus WHEN 'F' THEN 'recorded' WHEN 'O' THEN 'stored' ELSE 'target' END AS origin,
         max(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END) AS last_value
  FROM orders GROUP BY ALL)
SELECT table_name, min(last_value) AS last_value,
       first(origin ORDER BY last_value, origin) AS decided_by,
       string_agg(origin, ',' ORDER BY origin) AS known_origins
FROM marks WHERE last_value IS NOT NULL GROUP BY table_name""",
    ),
    "detected_state": Case(
        lambda spark, sf: watermark.detected_state(
            load(spark, sf, "events"), "event_type", "ts"
        ),
        """SELECT event_type AS table_name, max(ts) AS last_value, count(*) AS n_rows
FROM events GROUP BY event_type""",
    ),
    "latest_state": Case(
        lambda spark, sf: watermark.latest_state(states(spark, sf)),
        """SELECT event_type AS table_name, ts AS updated_at, event_id AS load_id, user_id AS last_value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "inconsistent_partitions": Case(
        lambda spark, sf: partitions.inconsistent_partitions(
            source(spark, sf), target(spark, sf), DAY
        ),
        with_ctes(
            COMPARED,
            """SELECT * FROM compared WHERE source_rows > 0 AND target_rows > 0
AND (source_rows <> target_rows OR source_fingerprint <> target_fingerprint)""",
        ),
    ),
    "checksum_comparison": Case(
        lambda spark, sf: partitions.compare_partitions(
            source(spark, sf), target(spark, sf), DAY, algorithm="checksum"
        ).select(
            DAY,
            "source_rows",
            "target_rows",
            (F.col("source_fingerprint") == F.col("target_fingerprint")).alias("same"),
        ),
        with_ctes(
            [SOURCE, TARGET],
            """SELECT cobid, CAST(sum(n_source) AS BIGINT) AS source_rows, CAST(sum(n_target) AS BIGINT) AS target_rows,
  bool_and(n_source = n_target) AS same
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cobid,
        count(*) FILTER (WHERE side = 1) AS n_source, count(*) FILTER (WHERE side = 2) AS n_target
      FROM (SELECT *, 1 AS side FROM source UNION ALL SELECT *, 2 FROM target)
      GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cobid)
GROUP BY cobid""",
        ),
    ),
    "partition_load_strategy": Case(
        lambda spark, sf: partitions.partition_load_strategy(
            source(spark, sf), target(spark, sf), DAY
        ),
        with_ctes(
            COMPARED,
            """SELECT cobid, source_rows, target_rows, CASE WHEN target_rows = 0 THEN 'append'
  WHEN source_rows = target_rows AND source_fingerprint = target_fingerprint THEN 'skip'
  ELSE 'replace' END AS strategy FROM compared WHERE source_rows > 0""",
        ),
    ),
    "missing_data_analysis": Case(
        lambda spark, sf: partitions.missing_data_analysis(
            source(spark, sf), stored(spark, sf), target(spark, sf), DAY
        ),
        with_ctes(
            [SOURCE, TARGET, STORED],
            """SELECT *, CASE WHEN source_rows = 0 THEN 'not_in_source'
  WHEN stored_rows = 0 AND target_rows = 0 THEN 'not_loaded' WHEN stored_rows = 0 THEN 'not_stored'
  WHEN target_rows = 0 THEN 'not_in_target'
  WHEN source_rows = stored_rows AND source_rows = target_rows THEN 'complete'
  ELSE 'row_counts_differ' END AS status
FROM (SELECT cobid, count(*) FILTER (WHERE side = 1) AS source_rows, count(*) FILTER (WHERE side = 2) AS stored_rows,
             count(*) FILTER (WHERE side = 3) AS target_rows
      FROM (SELECT cobid, 1 AS side FROM source UNION ALL SELECT cobid, 2 FROM stored
            UNION ALL SELECT cobid, 3 FROM target) GROUP BY cobid)""",
        ),
    ),
    "timestamp_gaps": Case(
        lambda spark, sf: watermark.timestamp_gaps(
            load(spark, sf, "orders"), "o_orderdate", ("o_custkey",)
        ).withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("last_seen", "next_seen")}
        ),
        """SELECT * FROM (
  SELECT o_custkey, o_orderdate AS last_seen, lead(o_orderdate) OVER w AS next_seen,
         date_diff('day', o_orderdate, lead(o_orderdate) OVER w) - 1 AS n_missing
  FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)) WHERE n_missing > 0""",
    ),
}
