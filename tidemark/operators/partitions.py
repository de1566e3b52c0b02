"""Partition values: which exist, which are new, missing or different, and backfills.

Comparisons of two or three copies of a table tag the rows with their side and
aggregate once by partition value. Rows are combined before the shuffle, so neither a
large partition nor a repeated value moves more than one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.canonical import fingerprint, row_number60
from tidemark.operators.ordered import OrderedRows
from tidemark.sources.tables import typed_lit


def partition_values(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Sorted distinct non-null values, optionally within inclusive bounds."""
    out = df.where(F.col(column).isNotNull())
    if low is not None:
        out = out.where(F.col(column) >= typed_lit(df, column, low))
    if high is not None:
        out = out.where(F.col(column) <= typed_lit(df, column, high))
    return out.select(column).distinct().orderBy(column)


def new_partition_values(df: DataFrame, column: str, last=None) -> DataFrame:
    """Distinct values above the last one loaded; all of them on a first run."""
    out = df.where(F.col(column).isNotNull())
    if last is not None:
        out = out.where(F.col(column) > typed_lit(df, column, last))
    return out.select(column).distinct()


def missing_partitions(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Values the source has and the target lacks, gaps in the past included."""
    have = target.select(column).distinct()
    return new_partition_values(source, column).join(have, column, "left_anti")


def last_n_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` highest partition values."""
    return new_partition_values(df, column).orderBy(F.col(column).desc()).limit(n)


def last_n_partitions(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows of the ``n`` highest partition values, for a first load.

    The lowest of the ``n`` values becomes a literal bound, which prunes the scan.
    """
    lowest = last_n_values(df, column, n).agg(F.min(column).alias("low")).first()["low"]
    return df.where(F.col(column) >= typed_lit(df, column, lowest)) if lowest is not None else df


def value_inventory(df: DataFrame, column: str) -> DataFrame:
    """Every value with its row count and its rank, counted from 1."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return OrderedRows.of(counts, (), [column]).positions("partition_number").rows()


def range_partition_number(value: Column, boundaries: Sequence) -> Column:
    """Number of the range partition of a value; a boundary opens the next partition.

    The number is 1 + the boundaries at or below the value.
    """
    if not boundaries:
        return F.when(value.isNotNull(), F.lit(1).cast("bigint"))
    edges = F.array(*[F.lit(b) for b in sorted(boundaries)])
    below = F.size(F.filter(edges, lambda edge: edge <= value))
    return F.when(value.isNotNull(), (below + 1).cast("bigint"))


def partition_numbers(df: DataFrame, column: str, boundaries: Sequence) -> DataFrame:
    """Every distinct value with its range partition number and row count."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("partition_number", range_partition_number(F.col(column), boundaries))


def partition_numbers_by(df: DataFrame, column: str, boundaries: DataFrame) -> DataFrame:
    """``partition_numbers`` for boundaries that are rows of a table (one column), however many.

    Values and boundaries are put in order together; the place of a value less its place
    among the values alone is the number of boundaries at or below it. Nulls and repeated
    boundaries count for nothing.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    values = counts.where(F.col(column).isNotNull())
    edges = boundaries.toDF(column).where(F.col(column).isNotNull()).distinct()
    # a boundary comes before the value that equals it
    both = edges.withColumn("_kind", F.lit(0)).unionByName(
        values.select(column, F.lit(1).alias("_kind"))
    )
    places = OrderedRows.of(both, (), [column, "_kind"]).positions("_all").rows().where("_kind = 1")
    own = OrderedRows.of(values, (), [column]).positions("_own").rows().drop("row_count")
    numbers = places.join(own, column).select(
        column, (F.col("_all") - F.col("_own") + 1).alias("partition_number")
    )
    return counts.join(numbers, column, "left").select(column, "row_count", "partition_number")


def partition_inventory(df: DataFrame, column: str, boundaries: Sequence) -> DataFrame:
    """``partition_number, row_count, boundary_value`` of all range partitions.

    The boundary is the lower edge, null for the first partition. Empty partitions are
    listed too.
    """
    filled = (
        partition_numbers(df, column, boundaries)
        .groupBy("partition_number")
        .agg(F.sum("row_count").alias("row_count"))
    )
    edges = sorted(boundaries)
    lower = F.array(*[F.lit(b) for b in edges]) if edges else F.array().cast("array<int>")
    numbers = df.sparkSession.range(1, len(edges) + 2).select(
        F.col("id").alias("partition_number"),
        F.when(F.col("id") > 1, F.try_element_at(lower, F.col("id").cast("int") - 1)).alias(
            "boundary_value"
        ),
    )
    return numbers.join(filled, "partition_number", "left").select(
        "partition_number",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        "boundary_value",
    )


def partitions_to_process(inventory: DataFrame, last=None) -> DataFrame:
    """Range partitions whose lower edge is unknown or above the last value."""
    if last is None:
        return inventory
    edge = F.col("boundary_value")
    return inventory.where(edge.isNull() | (edge > F.lit(last)))


def backfill_rows(
    df: DataFrame, column: str, low=None, high=None, values: Sequence | None = None
) -> DataFrame:
    """Rows of an inclusive range of partition values, or of listed values."""
    if values is not None:
        return df.where(F.col(column).isin(list(values)))
    if low is None or high is None:
        raise ValueError("give a range or a list of partition values")
    return df.where(F.col(column).between(typed_lit(df, column, low), typed_lit(df, column, high)))


def replace_partitions(target: DataFrame, staged: DataFrame, column: str) -> DataFrame:
    """The target once the staged partition values have taken the place of its own."""
    values = staged.select(column).distinct()
    return target.join(values, column, "left_anti").unionByName(staged)


def _sides(frames: dict[str, DataFrame], column: str) -> DataFrame:
    """All copies in one DataFrame, each row tagged with the name of its copy."""
    tagged = [df.withColumn("_side", F.lit(side)) for side, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged).where(F.col(column).isNotNull())


def compare_partitions(
    source: DataFrame,
    target: DataFrame,
    column: str,
    columns: Sequence[str] | None = None,
    algorithm: str = "hashbytes_sha256",
) -> DataFrame:
    """Row count and content fingerprint of every partition value on both sides."""
    wanted = list(columns or source.columns)
    numbered = {
        side: df.select(column, row_number60(df, wanted, algorithm).alias("_number"))
        for side, df in {"source": source, "target": target}.items()
    }
    both = _sides(numbered, column)

    def on(side: str, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    return both.groupBy(column).agg(
        F.count_if(F.col("_side") == "source").alias("source_rows"),
        F.count_if(F.col("_side") == "target").alias("target_rows"),
        fingerprint(on("source", F.col("_number"))).alias("source_fingerprint"),
        fingerprint(on("target", F.col("_number"))).alias("target_fingerprint"),
    )


def inconsistent_partitions(
    source: DataFrame, target: DataFrame, column: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Values on both sides whose row count or content differs."""
    both = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    differs = (F.col("source_rows") != F.col("target_rows")) | (
        F.col("source_fingerprint") != F.col("target_fingerprint")
    )
    return compare_partitions(source, target, column, columns).where(both & differs)


def partition_load_strategy(
    source: DataFrame, target: DataFrame, column: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """``strategy`` per source value: append if new, replace if different, else skip."""
    same = (F.col("source_rows") == F.col("target_rows")) & (
        F.col("source_fingerprint") == F.col("target_fingerprint")
    )
    strategy = (
        F.when(F.col("target_rows") == 0, "append").when(same, "skip").otherwise("replace")
    )
    return (
        compare_partitions(source, target, column, columns)
        .where(F.col("source_rows") > 0)
        .select(column, "source_rows", "target_rows", strategy.alias("strategy"))
    )


def partition_alignment(staged: DataFrame, column: str, values: Sequence) -> DataFrame:
    """One row: staged rows, how many lie outside the partitions being replaced."""
    inside = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return staged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~inside).alias("n_misaligned"),
        F.coalesce(F.bool_and(inside), F.lit(True)).alias("aligned"),
    )


def missing_data_analysis(
    source: DataFrame, stored: DataFrame, target: DataFrame, column: str
) -> DataFrame:
    """Rows of every partition value in the source, the stored files and the target."""
    frames = {"source": source, "stored": stored, "target": target}
    values = {side: df.select(column) for side, df in frames.items()}
    counts = _sides(values, column).groupBy(column).agg(
        *[F.count_if(F.col("_side") == side).alias(f"{side}_rows") for side in frames]
    )
    status = (
        F.when(F.col("source_rows") == 0, "not_in_source")
        .when((F.col("stored_rows") == 0) & (F.col("target_rows") == 0), "not_loaded")
        .when(F.col("stored_rows") == 0, "not_stored")
        .when(F.col("target_rows") == 0, "not_in_target")
        .when(
            (F.col("source_rows") == F.col("stored_rows"))
            & (F.col("source_rows") == F.col("target_rows")),
            "complete",
        )
        .otherwise("row_counts_differ")
    )
    return counts.withColumn("status", status)
