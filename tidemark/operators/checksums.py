"""A tree of checksums: sums per partition, below them sums per bucket of the key.

Sums of row numbers add up, so the upper level comes from the lower one without the rows. Two
copies are compared from above: buckets are looked at only where their partition differs, and
rows only where their bucket differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.canonical import fingerprint, row_number60, row_text
from tidemark.operators.ordered import join_null_safe

BUCKETS = 256
SUMS = ("row_count", "fingerprint")


def key_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket of a row's key; a null in a key is a value of its own."""
    digits = F.substring(F.md5(row_text(df, keys)), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def bucket_sums(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    by: Sequence[str] = (),
) -> DataFrame:
    """``row_count`` and ``fingerprint`` of each bucket in each group of ``by``."""
    numbered = df.select(
        *by, key_bucket(df, keys, buckets).alias("bucket"), row_number60(df, columns).alias("_number")
    )
    return numbered.groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("row_count"), fingerprint(F.col("_number")).alias("fingerprint")
    )


def rolled_up(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sums of an upper level; the same as if taken over the rows."""
    return sums.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"),
        F.sum(F.col("fingerprint").cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias("fingerprint"),
    )


def differing_sums(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose sums differ or that one side lacks: by, left_rows, right_rows."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*by, *SUMS, F.lit(name).alias("_side"))

    def on(name: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == name, F.col(column)))

    both = side(left, "left").unionByName(side(right, "right")).groupBy(*by).agg(
        F.coalesce(on("left", "row_count"), F.lit(0)).alias("left_rows"),
        F.coalesce(on("right", "row_count"), F.lit(0)).alias("right_rows"),
        on("left", "fingerprint").alias("_left"),
        on("right", "fingerprint").alias("_right"),
    )
    same = (F.col("left_rows") == F.col("right_rows")) & F.col("_left").eqNullSafe(F.col("_right"))
    return both.where(~same).select(*by, "left_rows", "right_rows")


def differing_buckets(left: DataFrame, right: DataFrame, upper: Sequence[str]) -> DataFrame:
    """From sums per ``upper`` and bucket: the buckets that differ, below the groups that do."""
    groups = differing_sums(rolled_up(left, upper), rolled_up(right, upper), upper).select(*upper)
    inside = [join_null_safe(side, groups, upper, "left_semi") for side in (left, right)]
    return differing_sums(*inside, [*upper, "bucket"])
