"""Decimal columns: values that do not fit, comparison along the way, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decimals import decimal_problem, exact_decimal
from tidemark.functions.once import with_once


def decimal_cast(df: DataFrame, sizes: Mapping[str, tuple[int, int]], strict: bool = True):
    """The named columns as exact decimals of the given (precision, scale)."""
    return df.withColumns({c: exact_decimal(F.col(c), *size, strict) for c, size in sizes.items()})


def decimal_overflow_rows(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Rows whose value has too many digits, with the ``problem``."""
    problem = decimal_problem(F.col(column), precision, scale)
    return with_once(df, "problem", problem).where(F.col("problem").isNotNull())


def decimal_compare_rows(
    source: DataFrame,
    stored: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    column: str,
    tolerance: str = "0",
) -> DataFrame:
    """``outcome`` of each key's value in the source, the stored files and the target.

    match, mismatch, all_null, null_mismatch, missing (not on every side) or duplicate
    (a side has the key twice). Values must be decimals; equality is exact unless a
    ``tolerance`` is given.
    """
    frames = {"source": source, "stored": stored, "target": target}
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(*keys, F.lit(side).alias("_side"), F.col(column).alias("_value"))
            for side, df in frames.items()
        ],
    )

    def of(side: str) -> Column:
        return F.col("_side") == side

    sides = tagged.groupBy(*keys).agg(
        *[F.max(F.when(of(s), F.col("_value"))).alias(f"{s}_value") for s in frames],
        *[F.count_if(of(s)).alias(f"_{s}_rows") for s in frames],
    )
    rows = [F.col(f"_{s}_rows") for s in frames]
    values = [F.col(f"{s}_value") for s in frames]
    limit = F.lit(tolerance).cast("decimal(38,18)")
    read_diff = F.abs(F.col("source_value") - F.col("stored_value"))
    write_diff = F.abs(F.col("stored_value") - F.col("target_value"))
    outcome = (
        F.when(F.least(*rows) == 0, "missing")
        .when(F.greatest(*rows) > 1, "duplicate")
        .when(F.coalesce(*values).isNull(), "all_null")
        .when(values[0].isNull() | values[1].isNull() | values[2].isNull(), "null_mismatch")
        .when((read_diff <= limit) & (write_diff <= limit), "match")
        .otherwise("mismatch")
    )
    return sides.select(
        *keys,
        *[f"{s}_value" for s in frames],
        read_diff.alias("source_stored_diff"),
        write_diff.alias("stored_target_diff"),
        outcome.alias("outcome"),
    )


def decimal_mismatch_rows(compared: DataFrame) -> DataFrame:
    """The rows of ``decimal_compare_rows`` that need a look."""
    return compared.where(~F.col("outcome").isin("match", "all_null"))


def decimal_compare(compared: DataFrame) -> DataFrame:
    """One row: keys per outcome and the match rate; all-null keys count as matches."""
    outcomes = ("match", "mismatch", "all_null", "null_mismatch", "missing", "duplicate")
    counts = compared.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in outcomes],
    )
    good = (F.col("n_match") + F.col("n_all_null")).cast("double")
    rate = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(good / F.col("total"))
    return counts.withColumn("match_rate", rate)


def decimal_stats(df: DataFrame, column: str, samples: int = 5) -> DataFrame:
    """One row about a decimal column; the samples are its smallest values."""
    size = df.schema[column].dataType
    if not isinstance(size, T.DecimalType):
        raise ValueError(f"{column} is {size.simpleString()}, not a decimal")
    value = F.col(column)
    smallest = (
        df.where(value.isNotNull())
        .select(value.alias("_sample"))
        .orderBy("_sample")
        .limit(samples)
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list("_sample")), lambda v: v.cast("string")),
                ", ",
            )
        )
    )
    return df.agg(
        F.lit(column).alias("column_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(value.isNull()).alias("null_count"),
        F.count(value).alias("non_null_count"),
        F.min(value).cast("string").alias("min_value"),
        F.max(value).cast("string").alias("max_value"),
    ).select(
        "*",
        F.lit(size.precision).alias("precision"),
        F.lit(size.scale).alias("scale"),
        smallest.scalar().alias("sample_values"),
    )
