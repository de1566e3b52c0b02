"""Exact decimals and typed reads: line prices and order totals as text and decimals."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.base import Case, load, with_ctes
from tidemark.functions.decimals import decimal_text
from tidemark.operators import decimals, schema

PRICE = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_linenumber", T.ShortType(), False),
        T.StructField("l_extendedprice", T.DecimalType(7, 2)),
        T.StructField("l_discount", T.DecimalType(1, 1)),
        T.StructField("l_shipdate", T.DateType()),
    ]
)


def as_text(spark, sf):
    """Line items the way a text export has them."""
    return load(spark, sf, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in PRICE.names]
    )


def totals(spark, sf):
    money = F.col("o_totalprice").cast("decimal(18,2)")
    known = F.when(F.col("o_orderpriority") != "5-LOW", money)
    return load(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", known.alias("total")
    )


def compared(spark, sf):
    """Stored totals were rounded for status P; the target lost those of priority 2."""
    source = totals(spark, sf)
    stored = source.withColumn(
        "total",
        F.when(F.col("o_orderstatus") == "P", F.round("total", 1).cast("decimal(18,2)")).otherwise(
            F.col("total")
        ),
    )
    target = stored.where(F.col("o_orderstatus") != "O").withColumn(
        "total", F.when(F.col("o_orderpriority") != "2-HIGH", F.col("total"))
    )
    return decimals.decimal_compare_rows(source, stored, target, ["o_orderkey"], "total")


def compared_text(df):
    names = ["source_value", "stored_value", "target_value", "source_stored_diff", "stored_target_diff"]
    return df.withColumns({c: F.col(c).cast("string") for c in names})


def all_text(df):
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DecimalType, T.DateType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


COMPARED = [
    """totals AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total FROM orders)""",
    """stored AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN CAST(round(total, 1) AS DECIMAL(18,2)) ELSE total END AS total)
  FROM totals)""",
    """target AS (
  SELECT * REPLACE (CASE WHEN o_orderpriority <> '2-HIGH' THEN total END AS total)
  FROM stored WHERE o_orderstatus <> 'O')""",
    """compared AS (
  SELECT s.o_orderkey, CAST(s.total AS VARCHAR) AS source_value, CAST(m.total AS VARCHAR) AS stored_value,
         CAST(t.total AS VARCHAR) AS target_value, CAST(abs(s.total - m.total) AS VARCHAR) AS source_stored_diff,
         CAST(abs(m.total - t.total) AS VARCHAR) AS stored_target_diff,
         CASE WHEN t.o_orderkey IS NULL THEN 'missing'
              WHEN s.total IS NULL AND m.total IS NULL AND t.total IS NULL THEN 'all_null'
              WHEN s.total IS NULL OR m.total IS NULL OR t.total IS NULL THEN 'null_mismatch'
              WHEN s.total = m.total AND m.total = t.total THEN 'match' ELSE 'mismatch' END AS outcome
  FROM totals s JOIN stored m ON s.o_orderkey = m.o_orderkey LEFT JOIN target t ON s.o_orderkey = t.o_orderkey)""",
]
# a value keeps its digits in decimal(7,2) / decimal(1,1) if it is below these bounds
BAD_PRICE = "l_extendedprice >= 100000"
BAD_DISCOUNT = "l_discount <> round(l_discount, 1)"
PROBLEMS = f"""concat_ws(',', CASE WHEN {BAD_PRICE} THEN 'l_extendedprice' END,
                    CASE WHEN {BAD_DISCOUNT} THEN 'l_discount' END)"""
TEXTS = ", ".join(
    [
        "CAST(l_orderkey AS VARCHAR) AS l_orderkey",
        "CAST(l_linenumber AS VARCHAR) AS l_linenumber",
        "CAST(l_extendedprice AS VARCHAR) AS l_extendedprice",
        "CAST(l_discount AS VARCHAR) AS l_discount",
        "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate",
    ]
)
LINEITEM_TYPES = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]

CASES: dict[str, Case] = {
    "typed_projection": Case(
        lambda spark, sf: all_text(
            schema.typed(
                load(spark, sf, "orders"),
                T.StructType(
                    [
                        T.StructField("o_orderkey", T.LongType()),
                        T.StructField("o_totalprice", T.DecimalType(18, 4)),
                        T.StructField("o_orderdate", T.DateType()),
                    ]
                ),
            )
        ),
        """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
    ),
    "schema_profile": Case(
        lambda spark, sf: schema.schema_profile(load(spark, sf, "lineitem")),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {n} AS ordinal, '{t}' AS data_type,
  CAST(NULL AS INTEGER) AS precision, CAST(NULL AS INTEGER) AS scale,
  count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM lineitem"""
            for n, (c, t) in enumerate(LINEITEM_TYPES, start=1)
        ),
    ),
    "decimal_overflow_rows": Case(
        lambda spark, sf: decimals.decimal_overflow_rows(
            load(spark, sf, "lineitem")
            .select(
                "l_orderkey",
                "l_linenumber",
                F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
            ),
            "price",
            7,
            2,
        ),
        """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
       'precision' AS problem FROM lineitem WHERE l_extendedprice >= 100000""",
    ),
    "decimal_scale_rows": Case(
        lambda spark, sf: decimals.decimal_overflow_rows(
            load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"),
            "l_discount",
            1,
            1,
        ).withColumn("l_discount", F.col("l_discount").cast("string")),
        """SELECT l_orderkey, l_linenumber, CAST(l_discount AS VARCHAR) AS l_discount,
       CASE WHEN l_discount >= 0.1 THEN 'precision' ELSE 'scale' END AS problem
FROM lineitem WHERE l_discount <> round(l_discount, 1)""",
    ),
    "decimal_format": Case(
        lambda spark, sf: load(spark, sf, "orders").select(
            "o_orderkey",
            decimal_text(F.col("o_totalprice"), 18, 4).alias("total_text"),
            decimal_text(
                F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(
                    F.col("o_totalprice").cast("string")
                ),
                7,
                2,
                strict=False,
            ).alias("short_text"),
        ),
        """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS total_text,
       CASE WHEN o_orderstatus <> 'P' AND o_totalprice < 100000
            THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS short_text FROM orders""",
    ),
    "decimal_cast": Case(
        lambda spark, sf: all_text(
            decimals.decimal_cast(
                load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"),
                {"l_quantity": (38, 18), "l_tax": (9, 4)},
            )
        ),
        """SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR) AS l_quantity,
       CAST(CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(9,4)) AS VARCHAR) AS l_tax FROM lineitem""",
    ),
    "decimal_compare": Case(
        lambda spark, sf: decimals.decimal_compare(compared(spark, sf)),
        with_ctes(
            COMPARED,
            """SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'match') AS n_match,
  count(*) FILTER (WHERE outcome = 'mismatch') AS n_mismatch, count(*) FILTER (WHERE outcome = 'all_null') AS n_all_null,
  count(*) FILTER (WHERE outcome = 'null_mismatch') AS n_null_mismatch, count(*) FILTER (WHERE outcome = 'missing') AS n_missing,
  count(*) FILTER (WHERE outcome = 'duplicate') AS n_duplicate,
  CAST(count(*) FILTER (WHERE outcome IN ('match', 'all_null')) AS DOUBLE) / count(*) AS match_rate FROM compared""",
        ),
    ),
    "decimal_mismatch_rows": Case(
        lambda spark, sf: compared_text(decimals.decimal_mismatch_rows(compared(spark, sf))),
        with_ctes(
            COMPARED, "SELECT * FROM compared WHERE outcome NOT IN ('match', 'all_null')"
        ),
    ),
    "decimal_stats": Case(
        lambda spark, sf: decimals.decimal_stats(totals(spark, sf), "total"),
        with_ctes(
            COMPARED[:1],
            """SELECT 'total' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE total IS NULL) AS null_count,
  count(total) AS non_null_count, CAST(min(total) AS VARCHAR) AS min_value, CAST(max(total) AS VARCHAR) AS max_value,
  18 AS precision, 2 AS scale,
  (SELECT string_agg(CAST(total AS VARCHAR), ', ' ORDER BY total)
   FROM (SELECT total FROM totals WHERE total IS NOT NULL ORDER BY total LIMIT 5)) AS sample_values FROM totals""",
        ),
    ),
    "quarantine_rows": Case(
        lambda spark, sf: schema.quarantine(as_text(spark, sf), PRICE)[1],
        f"SELECT {TEXTS}, {PROBLEMS} AS problems FROM lineitem WHERE {BAD_PRICE} OR {BAD_DISCOUNT}",
    ),
    "typed_good_rows": Case(
        lambda spark, sf: all_text(schema.quarantine(as_text(spark, sf), PRICE)[0]),
        f"""SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS l_extendedprice,
  CAST(CAST(l_discount AS DECIMAL(9,1)) AS VARCHAR) AS l_discount, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem WHERE NOT ({BAD_PRICE} OR {BAD_DISCOUNT})""",
    ),
    "error_rate": Case(
        lambda spark, sf: schema.error_rate(as_text(spark, sf), PRICE),
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE {BAD_PRICE} OR {BAD_DISCOUNT}) AS n_bad,
  CAST(count(*) FILTER (WHERE {BAD_PRICE} OR {BAD_DISCOUNT}) AS DOUBLE) / count(*) AS error_rate FROM lineitem""",
    ),
}
