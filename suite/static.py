"""Reference tables: parts against an earlier copy of them, and order fingerprints.

The earlier copy lacks one brand, has other prices for economy parts, and still has the
large parts under old numbers. Per-table decisions take every brand as a table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from suite.base import Case, load, with_ctes
from suite.partitions import CANONICAL, SOURCE, source as orders
from tidemark.functions import canonical
from tidemark.operators import checksums, quality, static

KEYS = ["p_partkey"]
OLD_NUMBERS = 1_000_000_000
NOW = "2024-01-31"
MONEY = "decimal(18,2)"


def parts(spark, sf):
    return load(spark, sf, "part").withColumn("p_retailprice", F.col("p_retailprice").cast(MONEY))


def earlier_parts(spark, sf):
    kept = parts(spark, sf).where(F.col("p_brand") != "Brand#7")
    price = F.when(F.col("p_type") == "ECONOMY", (F.col("p_retailprice") + 1).cast(MONEY))
    old = kept.where(F.col("p_type") == "LARGE").withColumn(
        "p_partkey", F.col("p_partkey") + OLD_NUMBERS
    )
    return kept.withColumn("p_retailprice", F.coalesce(price, F.col("p_retailprice"))).unionByName(
        old
    )


def visible(df):
    return df.withColumn("p_retailprice", F.col("p_retailprice").cast("string"))


def altered_orders(spark, sf):
    """Another copy of the orders: January 1998 has other states, some February orders are lost."""
    df = orders(spark, sf)
    january = F.col("cobid").between(19980101, 19980131) & (F.col("o_orderkey") % 3 == 0)
    lost = F.col("cobid").between(19980201, 19980210) & (F.col("o_orderkey") % 5 == 0)
    return df.withColumn("o_orderstatus", F.when(january, "X").otherwise(F.col("o_orderstatus"))).where(~lost)


def order_sums(df):
    return checksums.bucket_sums(df, ["o_orderkey"], buckets=64, by=["cobid"])


def brand_prints(spark, sf):
    return canonical.table_fingerprint(parts(spark, sf), by=["p_brand"]).withColumnRenamed(
        "p_brand", "table_name"
    )


def brand_states(spark, sf):
    """What was published for each brand: changed brands, and ages from 62 to 96 days."""
    published = parts(spark, sf).where(F.col("p_brand") != "Brand#7")
    changed = published.withColumn(
        "p_size", F.when(F.col("p_brand").like("Brand#2%"), 0).otherwise(F.col("p_size"))
    )
    days = F.make_dt_interval((F.col("row_count") - F.lit(60)).cast("int"))
    return canonical.table_fingerprint(changed, by=["p_brand"]).select(
        F.col("p_brand").alias("table_name"),
        F.col("fingerprint").alias("last_hash"),
        (F.lit(NOW).cast("timestamp_ntz") - days).alias("last_loaded"),
    )


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def marks(df):
    return df.groupBy(F.col("o_orderpriority").alias("table_name")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("o_orderdate").alias("max_modified")
    )


def last_marks(spark, sf):
    df = load(spark, sf, "orders")
    seen = (
        ((F.col("o_orderpriority") != "2-HIGH") | (F.col("o_orderstatus") != "F"))
        & (F.col("o_orderpriority") != "5-LOW")
    )
    later = F.when(
        F.col("table_name") == "1-URGENT", F.col("max_modified") - F.make_dt_interval(F.lit(1))
    ).otherwise(F.col("max_modified"))
    return marks(df.where(seen)).withColumn("max_modified", later)


PARTS = """parts AS (
  SELECT * REPLACE (CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice) FROM part)"""
EARLIER = f"""earlier AS (
  SELECT * REPLACE (CAST(CASE WHEN p_type = 'ECONOMY' THEN p_retailprice + 1 ELSE p_retailprice END
                         AS DECIMAL(18,2)) AS p_retailprice) FROM parts WHERE p_brand <> 'Brand#7'
  UNION ALL
  SELECT * REPLACE (p_partkey + {OLD_NUMBERS} AS p_partkey) FROM parts
  WHERE p_brand <> 'Brand#7' AND p_type = 'LARGE')"""
VISIBLE = "p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice"
DIFF = """diff AS (
  SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey,
         CAST(s.p_partkey IS NOT NULL AS BIGINT) AS source_rows,
         CAST(t.p_partkey IS NOT NULL AS BIGINT) AS target_rows,
         CASE WHEN t.p_partkey IS NULL THEN 'insert' WHEN s.p_partkey IS NULL THEN 'delete'
              WHEN s = t THEN 'unchanged' ELSE 'update' END AS action
  FROM parts s FULL JOIN earlier t ON s.p_partkey = t.p_partkey)"""
PART_TEXT = """concat_ws('|', CAST(p_partkey AS VARCHAR), replace(replace(p_name, '\\', '\\\\'), '|', '\\|'),
  p_brand, p_type, CAST({size} AS VARCHAR), CAST(p_retailprice AS VARCHAR))"""


def number(text: str, algorithm: str) -> str:
    return f"CAST(CAST('0x' || substr({algorithm}({text}), 1, 15) AS BIGINT) AS HUGEINT)"


def brand_ctes(name: str, size: str, condition: str) -> str:
    text = PART_TEXT.format(size=size)
    return f"""{name} AS (
  SELECT p_brand AS table_name, count(*) AS row_count,
         CAST(sum({number(text, 'sha256')}) AS VARCHAR) AS fingerprint
  FROM parts WHERE {condition} GROUP BY p_brand)"""


BRANDS = [
    PARTS,
    brand_ctes("prints", "p_size", "TRUE"),
    brand_ctes(
        "published",
        "CASE WHEN p_brand LIKE 'Brand#2%' THEN 0 ELSE p_size END",
        "p_brand <> 'Brand#7'",
    ),
    f"""states AS (
  SELECT table_name, fingerprint AS last_hash,
         TIMESTAMP '{NOW}' - to_days(CAST(row_count - 60 AS INTEGER)) AS last_loaded FROM published)""",
    f"""joined AS (
  SELECT p.*, s.last_hash, s.last_loaded, date_diff('day', s.last_loaded, TIMESTAMP '{NOW}') AS age
  FROM prints p LEFT JOIN states s ON s.table_name = p.table_name)""",
]


def table_sql(algorithm: str, text: str = CANONICAL) -> str:
    return f"""SELECT count(*) AS row_count, CAST(sum({number(text, algorithm)}) AS VARCHAR) AS fingerprint
FROM source"""


ALTERED = """altered AS (
  SELECT * REPLACE (CASE WHEN cobid BETWEEN 19980101 AND 19980131 AND o_orderkey % 3 = 0 THEN 'X'
                    ELSE o_orderstatus END AS o_orderstatus)
  FROM source WHERE NOT (cobid BETWEEN 19980201 AND 19980210 AND o_orderkey % 5 = 0))"""


def order_sums_sql(name: str, table: str) -> str:
    return f"""{name} AS (
  SELECT cobid, CAST({number('CAST(o_orderkey AS VARCHAR)', 'md5')} % 64 AS INTEGER) AS bucket,
         count(*) AS n, sum({number(CANONICAL, 'sha256')}) AS total
  FROM {table} GROUP BY 1, 2)"""


CUSTOMER_TEXT = "concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus)"

ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
CASES: dict[str, Case] = {
    "table_checksum": Case(
        lambda spark, sf: canonical.table_fingerprint(orders(spark, sf), algorithm="checksum"), None
    ),
    "table_fingerprint_md5": Case(
        lambda spark, sf: canonical.table_fingerprint(orders(spark, sf), algorithm="hashbytes_md5"),
        with_ctes([SOURCE], table_sql("md5")),
    ),
    "table_fingerprint_sha256": Case(
        lambda spark, sf: canonical.table_fingerprint(orders(spark, sf)),
        with_ctes([SOURCE], table_sql("sha256")),
    ),
    "row_hash": Case(
        lambda spark, sf: static.with_row_hash(orders(spark, sf)).select("o_orderkey", "row_hash"),
        with_ctes([SOURCE], f"SELECT o_orderkey, sha256({CANONICAL}) AS row_hash FROM source"),
    ),
    "text_row_hash": Case(
        lambda spark, sf: static.with_row_hash(
            load(spark, sf, "documents"), ["doc_id", "text", "lang"]
        ).select("doc_id", "row_hash"),
        r"""SELECT doc_id, sha256(concat_ws('|', CAST(doc_id AS VARCHAR),
  replace(replace(text, '\', '\\'), '|', '\|'), lang)) AS row_hash FROM documents""",
    ),
    "column_subset_hash": Case(
        lambda spark, sf: canonical.table_fingerprint(
            orders(spark, sf), ["o_custkey", "o_orderstatus"]
        ),
        with_ctes([SOURCE], table_sql("sha256", CUSTOMER_TEXT)),
    ),
    "hash_comparison": Case(
        lambda spark, sf: canonical.compare_fingerprints(
            orders(spark, sf),
            {
                "md5": ("hashbytes_md5", None),
                "sha256": ("hashbytes_sha256", None),
                "sha256_customer": ("hashbytes_sha256", ["o_custkey", "o_orderstatus"]),
            },
        ),
        with_ctes(
            [SOURCE],
            f"""SELECT count(*) AS row_count,
  CAST(sum({number(CANONICAL, 'md5')}) AS VARCHAR) AS md5,
  CAST(sum({number(CANONICAL, 'sha256')}) AS VARCHAR) AS sha256,
  CAST(sum({number(CUSTOMER_TEXT, 'sha256')}) AS VARCHAR) AS sha256_customer FROM source""",
        ),
    ),
    "checksum_tree_diff": Case(
        lambda spark, sf: checksums.differing_buckets(
            order_sums(orders(spark, sf)), order_sums(altered_orders(spark, sf)), ["cobid"]
        ),
        with_ctes(
            [SOURCE, ALTERED, order_sums_sql("l", "source"), order_sums_sql("r", "altered")],
            """SELECT coalesce(l.cobid, r.cobid) AS cobid, coalesce(l.bucket, r.bucket) AS bucket,
  coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows
FROM l FULL JOIN r ON l.cobid = r.cobid AND l.bucket = r.bucket
WHERE l.n IS DISTINCT FROM r.n OR l.total IS DISTINCT FROM r.total""",
        ),
    ),
    "lineage_columns": Case(
        lambda spark, sf: visible(
            static.with_lineage(
                parts(spark, sf),
                "load-1",
                canonical.table_fingerprint(parts(spark, sf)).first()["fingerprint"],
            )
        ),
        with_ctes(
            [PARTS],
            f"""SELECT {VISIBLE}, 'load-1' AS _load_id,
  (SELECT CAST(sum({number(PART_TEXT.format(size='p_size'), 'sha256')}) AS VARCHAR) FROM parts) AS _table_hash
FROM parts""",
        ),
    ),
    "static_load_decision": Case(
        lambda spark, sf: static.load_decisions(
            brand_prints(spark, sf), brand_states(spark, sf), now(), force_after_days=30
        ),
        with_ctes(
            BRANDS,
            """SELECT table_name, row_count, fingerprint, reason, reason <> 'unchanged' AS needs_load
FROM (SELECT *, CASE WHEN last_hash IS NULL THEN 'initial_load' WHEN last_hash <> fingerprint THEN 'hash_changed'
             WHEN age >= 30 THEN 'forced_by_age' ELSE 'unchanged' END AS reason FROM joined)""",
        ),
    ),
    "change_analysis": Case(
        lambda spark, sf: static.change_analysis(
            brand_prints(spark, sf), brand_states(spark, sf), now()
        ),
        with_ctes(
            BRANDS,
            """SELECT table_name, fingerprint AS current_hash, row_count AS current_row_count,
  last_hash AS last_known_hash, fingerprint IS DISTINCT FROM last_hash AS hash_changed,
  age AS days_since_last_change,
  CASE WHEN age IS NULL THEN NULL WHEN age < 1 THEN 'high' WHEN age < 7 THEN 'medium' ELSE 'low' END
    AS change_frequency FROM joined""",
        ),
    ),
    "cheap_change_check": Case(
        lambda spark, sf: static.cheap_change_check(
            marks(load(spark, sf, "orders")), last_marks(spark, sf)
        ),
        """WITH marks AS (
  SELECT o_orderpriority AS table_name, count(*) AS row_count, max(o_orderdate) AS max_modified
  FROM orders GROUP BY 1),
last AS (
  SELECT o_orderpriority AS table_name, count(*) AS last_row_count,
         CASE WHEN o_orderpriority = '1-URGENT' THEN max(o_orderdate) - INTERVAL 1 DAY
              ELSE max(o_orderdate) END AS last_max_modified
  FROM orders WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F') AND o_orderpriority <> '5-LOW'
  GROUP BY 1)
SELECT m.*, l.last_row_count, l.last_max_modified,
  CASE WHEN l.table_name IS NULL THEN 'initial_load' WHEN row_count <> last_row_count THEN 'row_count_changed'
       WHEN max_modified <> last_max_modified THEN 'modified_changed' ELSE 'maybe_unchanged' END AS hint
FROM marks m LEFT JOIN last l ON m.table_name = l.table_name""",
    ),
    "static_upsert": Case(
        lambda spark, sf: visible(static.upsert(parts(spark, sf), earlier_parts(spark, sf), KEYS)),
        with_ctes(
            [PARTS, EARLIER],
            f"""SELECT {VISIBLE} FROM parts UNION ALL
SELECT {VISIBLE} FROM earlier WHERE p_partkey NOT IN (SELECT p_partkey FROM parts)""",
        ),
    ),
    "static_sync_with_deletes": Case(
        lambda spark, sf: visible(
            static.sync_with_deletes(parts(spark, sf), earlier_parts(spark, sf), KEYS)
        ),
        with_ctes([PARTS], f"SELECT {VISIBLE} FROM parts"),
    ),
    "merge_changes": Case(
        lambda spark, sf: visible(
            static.merge_changes(parts(spark, sf), earlier_parts(spark, sf), KEYS, True)
        ),
        with_ctes(
            [PARTS, EARLIER, DIFF],
            f"""SELECT {VISIBLE}, action FROM parts JOIN diff USING (p_partkey)
WHERE action IN ('insert', 'update')
UNION ALL SELECT {VISIBLE}, action FROM earlier JOIN diff USING (p_partkey) WHERE action = 'delete'""",
        ),
    ),
    "table_diff": Case(
        lambda spark, sf: static.table_diff(parts(spark, sf), earlier_parts(spark, sf), KEYS),
        with_ctes([PARTS, EARLIER, DIFF], "SELECT * FROM diff"),
    ),
    "table_diff_counts": Case(
        lambda spark, sf: static.table_diff_counts(parts(spark, sf), earlier_parts(spark, sf), KEYS),
        with_ctes(
            [PARTS, EARLIER, DIFF], "SELECT action, count(*) AS n_keys FROM diff GROUP BY action"
        ),
    ),
    "source_target_match": Case(
        lambda spark, sf: static.source_target_match(parts(spark, sf), earlier_parts(spark, sf)),
        with_ctes(
            [PARTS, EARLIER],
            """SELECT *, source_rows <> target_rows AS row_count_mismatch, EXISTS (
  (SELECT * FROM parts EXCEPT ALL SELECT * FROM earlier) UNION ALL
  (SELECT * FROM earlier EXCEPT ALL SELECT * FROM parts)) AS hash_mismatch
FROM (SELECT (SELECT count(*) FROM parts) AS source_rows, (SELECT count(*) FROM earlier) AS target_rows)""",
        ),
    ),
    "pk_null_counts": Case(
        lambda spark, sf: quality.null_counts(
            load(spark, sf, "part")
            .withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#7")))
            .withColumn("p_size", F.nullif("p_size", F.lit(1))),
            ["p_partkey", "p_brand", "p_size"],
        ),
        """SELECT 'p_partkey' AS column_name, count(*) FILTER (WHERE p_partkey IS NULL) AS n_nulls FROM part
UNION ALL SELECT 'p_brand', count(*) FILTER (WHERE nullif(p_brand, 'Brand#7') IS NULL) FROM part
UNION ALL SELECT 'p_size', count(*) FILTER (WHERE nullif(p_size, 1) IS NULL) FROM part""",
    ),
    "pk_duplicate_count": Case(
        lambda spark, sf: quality.duplicate_key_count(
            load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        """SELECT count(*) AS n_duplicated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    ),
    "row_count": Case(
        lambda spark, sf: quality.row_count(load(spark, sf, "lineitem"), "l_linestatus = 'O'"),
        "SELECT count(*) AS n_rows FROM lineitem WHERE l_linestatus = 'O'",
    ),
    "key_candidates": Case(
        lambda spark, sf: quality.key_candidates(
            load(spark, sf, "orders"),
            [("o_custkey", "o_orderdate"), ("o_orderkey", "o_orderstatus")],
        ),
        """SELECT * FROM (
  SELECT 'o_orderkey' AS key_columns, count(*) AS n_rows, count(DISTINCT o_orderkey) AS d FROM orders
  UNION ALL SELECT 'o_custkey', count(*), count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 'o_totalprice', count(*), count(DISTINCT o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', count(*), count(DISTINCT o_orderdate) FROM orders
  UNION ALL SELECT 'o_custkey,o_orderdate', count(*), count(DISTINCT (o_custkey, o_orderdate)) FROM orders
  UNION ALL SELECT 'o_orderkey,o_orderstatus', count(*), count(DISTINCT (o_orderkey, o_orderstatus)) FROM orders)
WHERE n_rows = d""".replace("SELECT * FROM (", "SELECT key_columns, n_rows FROM (", 1),
    ),
    "column_profile": Case(
        lambda spark, sf: quality.column_profile(load(spark, sf, "orders"), 3000),
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS key_columns, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_values,
  CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS n_nulls, max(n) AS largest,
  count(*) = sum(n) AND bool_and(v IS NOT NULL) AS is_key,
  bool_and(v IS NOT NULL) AND count(*) BETWEEN 2 AND 3000 AS can_partition
FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1)"""
            for c in ORDER_COLUMNS
        ),
    ),
    "unique_column_sets": Case(
        lambda spark, sf: quality.unique_column_sets(load(spark, sf, "orders")),
        "WITH ones AS ("
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS a, count(*) AS n_rows, count(DISTINCT {c}) AS d FROM orders" for c in ORDER_COLUMNS
        )
        + "), pairs AS ("
        + "\nUNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n_rows, count(DISTINCT ({a}, {b})) AS d FROM orders"
            for a, b in combinations(ORDER_COLUMNS, 2)
        )
        + """)
SELECT a AS key_columns, n_rows FROM ones WHERE n_rows = d
UNION ALL SELECT a || ',' || b, n_rows FROM pairs p WHERE n_rows = d
  AND NOT EXISTS (SELECT 1 FROM ones o WHERE o.n_rows = o.d AND o.a IN (p.a, p.b))""",
    ),
    "partition_candidates": Case(
        lambda spark, sf: quality.partition_candidates(load(spark, sf, "orders"), 3000),
        """SELECT * FROM (
  SELECT 'o_orderkey' AS column_name, count(*) AS n_values, max(n) AS largest
  FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
  UNION ALL SELECT 'o_custkey', count(*), max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)
  UNION ALL SELECT 'o_orderdate', count(*), max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderdate))
WHERE n_values BETWEEN 2 AND 3000""",
    ),
}
