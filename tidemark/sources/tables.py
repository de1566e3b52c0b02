"""Reading source tables: files, a database through JDBC, and the row ranges of a load.

A range is a literal predicate, so it reaches the Parquet footer, the partition
directories or the database. Reading in pieces is left to Spark's scan tasks; a JDBC
read is split over a numeric or date column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_lit(df: DataFrame, column: str, value) -> Column:
    """A literal in the type of a column, so that comparing them needs no cast of the column
    and the predicate reaches the scan."""
    if isinstance(value, Column):
        return value
    if isinstance(df.schema[column].dataType, T.TimestampNTZType) and not isinstance(value, str):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast(df.schema[column].dataType)


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files or folders, read with the schema they were written with."""
    return spark.read.parquet(*paths)


def jdbc_options(
    url: str,
    table: str,
    where: str | None = None,
    split_on: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read, split into ``partitions`` ranges of ``split_on``.

    The bounds place the cuts only; rows outside them belong to the outer ranges.
    """
    dbtable = f"(SELECT * FROM {table} WHERE {where}) AS filtered" if where else table
    options = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_rows)}
    if split_on is None:
        return options
    if bounds is None or not partitions or partitions < 1:
        raise ValueError("a split read needs bounds and a positive number of partitions")
    low, high = bounds
    return options | {
        "partitionColumn": split_on,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def only(df: DataFrame, where: str | None) -> DataFrame:
    """The extra row filter of a table description."""
    return df.where(F.expr(where)) if where else df


def partition_rows(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one partition value."""
    return df.where(F.col(column) == typed_lit(df, column, value))


def range_rows(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows with ``low < column <= high``; a missing bound is open."""
    if low is not None:
        df = df.where(F.col(column) > typed_lit(df, column, low))
    if high is not None:
        df = df.where(F.col(column) <= typed_lit(df, column, high))
    return df


def rows_above(
    df: DataFrame, column: str, mark: str, overlap_seconds: int | None = None
) -> DataFrame:
    """Rows above a mark that was recorded as text, or above ``overlap_seconds`` before it."""
    low = F.lit(mark).cast(df.schema[column].dataType)
    if overlap_seconds is not None:
        low = low - F.make_dt_interval(secs=F.lit(overlap_seconds))
    return df.where(F.col(column) > low)


def rows_from(df: DataFrame, column: str, mark: str, overlap: float | None = None) -> DataFrame:
    """Rows at or above a mark that was recorded as text, or ``overlap`` below it.

    The overlap is seconds for times and a number for other columns.
    """
    kind = df.schema[column].dataType
    low = F.lit(mark).cast(kind)
    if overlap is not None:
        timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
        low = low - (F.make_dt_interval(secs=F.lit(overlap)) if timed else F.lit(overlap).cast(kind))
    return df.where(F.col(column) >= low)


def rows_after(source: DataFrame, target: DataFrame, column: str, overlap: Column | None = None):
    """Source rows above the highest value of the target; all of them if it has none.

    ``overlap`` (an interval or a number) lowers the mark, for rows that arrive late with
    a value already passed; the caller removes what it then reads twice.
    """
    mark = target.agg(F.max(column).alias("high"))
    if overlap is not None:
        mark = mark.select((F.col("high") - overlap).cast(target.schema[column].dataType).alias("high"))
    high = mark.first()["high"]
    return source if high is None else source.where(
        F.col(column) > typed_lit(source, column, high)
    )
