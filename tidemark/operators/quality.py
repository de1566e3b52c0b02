"""Keys, nulls and counts of a table, and one issue list over many tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations as combinations_of
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PartitionTable, Scd2Table, StaticTable, TableConfig
from tidemark.sources.tables import only


def row_count(df: DataFrame, where: str | None = None) -> DataFrame:
    """One row, ``n_rows``, optionally of the rows that meet a condition."""
    return only(df, where).agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_nulls`` for each column, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with ``n_rows``."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key combinations repeat, and the rows beyond the first of each."""
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("n_duplicated_keys"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n_surplus_rows"),
    )


# Columns of one pass: each row is expanded once for every set of columns.
_COLUMNS_A_PASS = 32


def _comparable(df: DataFrame) -> list[str]:
    kinds = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    return [f.name for f in df.schema if not isinstance(f.dataType, kinds)]


def _passes(sets: Sequence[Sequence[str]]) -> list[list[tuple[str, ...]]]:
    """Sets of columns, so many together that they have no more than _COLUMNS_A_PASS columns."""
    out: list[list[tuple[str, ...]]] = []
    for one in dict.fromkeys(tuple(s) for s in sets):
        if not out or len({*(c for s in out[-1] for c in s), *one}) > _COLUMNS_A_PASS:
            out.append([])
        out[-1].append(one)
    return out


def set_profile(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """``key_columns, n_rows, n_values, n_nulls, largest, is_key`` of each set of columns.

    n_values counts distinct combinations, n_nulls rows with a null in the set, largest the
    rows of the most frequent combination. The sets are counted exactly and together by
    grouping sets: one scan and one shuffle for up to 32 columns, in which frequent values
    are summed up before the shuffle. A set is a key if all its values are present and
    different.
    """
    found = []
    for some in _passes(sets):
        columns = list(dict.fromkeys(c for one in some for c in one))
        # a bit of grouping_id is set for each column that is not in the set, the first highest
        bits = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
        names = {sum(b for c, b in bits.items() if c not in one): one for one in some}
        any_null = F.lit(False)
        for number, one in names.items():
            null = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in one])
            any_null = F.when(F.col("_set") == number, null).otherwise(any_null)
        named = F.create_map(*[F.lit(x) for n, one in names.items() for x in (n, ",".join(one))])
        values = df.groupingSets([[F.col(f"`{c}`") for c in one] for one in names.values()], *[F.col(f"`{c}`") for c in columns]).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().cast("bigint").alias("_set")
        )
        found.append(
            values.groupBy("_set")
            .agg(
                F.sum("_n").alias("n_rows"),
                F.count(F.lit(1)).alias("n_values"),
                F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("n_nulls"),
                F.max("_n").alias("largest"),
            )
            .select(
                named.cast("map<bigint,string>")[F.col("_set")].alias("key_columns"),
                "n_rows",
                "n_values",
                "n_nulls",
                "largest",
                ((F.col("n_nulls") == 0) & (F.col("n_values") == F.col("n_rows"))).alias("is_key"),
            )
        )
    if not found:
        return df.sparkSession.createDataFrame(
            [], "key_columns string, n_rows bigint, n_values bigint, n_nulls bigint, largest bigint, is_key boolean"
        )
    return reduce(DataFrame.unionByName, found)


def column_profile(df: DataFrame, max_values: int | None = None) -> DataFrame:
    """``set_profile`` of every column that can be compared, with ``can_partition``.

    A column can partition a table if it has no nulls, at least two values and, where given,
    at most ``max_values``. Every column has its row; nothing is hidden.
    """
    few = F.lit(True) if max_values is None else F.col("n_values") <= max_values
    can = (F.col("n_nulls") == 0) & (F.col("n_values") >= 2) & few
    return set_profile(df, [[c] for c in _comparable(df)]).withColumn("can_partition", can)


def key_candidates(df: DataFrame, combinations: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Columns, and given combinations, whose values are all present and all different."""
    sets = [*[[c] for c in _comparable(df)], *combinations]
    return set_profile(df, sets).where("is_key").select("key_columns", "n_rows")


def unique_column_sets(df: DataFrame, max_columns: int = 2) -> DataFrame:
    """The smallest sets of up to ``max_columns`` columns that identify a row, with n_rows.

    Sets grow by one column a pass. A set that holds a smaller key is left out, and so is one
    whose columns have too few values between them to tell all rows apart.
    """
    profile = {r["key_columns"]: r for r in column_profile(df).collect()}
    usable = [c for c in df.columns if c in profile and not profile[c]["n_nulls"] and profile[c]["n_values"] > 1]
    keys = [(c,) for c in usable if profile[c]["is_key"]]
    n_rows = max((r["n_rows"] for r in profile.values()), default=0)
    for size in range(2, max_columns + 1):
        sets = [
            one
            for one in combinations_of([c for c in usable if (c,) not in keys], size)
            if not any(set(k) <= set(one) for k in keys)
            and prod(profile[c]["n_values"] for c in one) >= n_rows
        ]
        found = set_profile(df, sets).where("is_key").select("key_columns").collect()
        keys += [tuple(r["key_columns"].split(",")) for r in found]
    rows = [(",".join(k), n_rows) for k in keys]
    return df.sparkSession.createDataFrame(rows, "key_columns string, n_rows bigint")


def partition_candidates(df: DataFrame, max_values: int | None = None) -> DataFrame:
    """Whole-number and date columns that can partition a table, see ``column_profile``."""
    kinds = (T.IntegerType, T.LongType, T.DateType, T.TimestampNTZType, T.TimestampType)
    names = [f.name for f in df.schema if isinstance(f.dataType, kinds)]
    found = column_profile(df.select(*names), max_values).where("can_partition")
    return found.select(F.col("key_columns").alias("column_name"), "n_values", "largest")


def _found(counts: DataFrame, table: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per (rule, column) from a row that has their counts as ``_0``, ``_1``, ..."""
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"),
            F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("bigint").alias("n"),
        )
        for i, (rule, column) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


def table_issues(table: TableConfig, df: DataFrame) -> DataFrame:
    """``table_name, rule, column_name, n`` of every rule of the table's pattern.

    One aggregate by key serves all rules of a table.
    """
    name = table.table
    if isinstance(table, PartitionTable):
        keys, together = (table.partition_column,), ""
        measures: dict[str, Column] = {}
    elif isinstance(table, StaticTable):
        keys, together = table.primary_keys, ",".join(table.primary_keys)
        measures = {"duplicate_key": F.col("_rows") > 1} if keys else {}
    elif isinstance(table, Scd2Table):
        keys, together = table.keys, ",".join(table.keys)
        measures = {
            "multiple_latest": F.col("_current") > 1,
            "no_latest": F.col("_current") == 0,
        }
    else:
        raise TypeError(f"no rules for {table!r}")

    aggregates = [F.count(F.lit(1)).alias("_rows")]
    if isinstance(table, Scd2Table):
        flag = F.coalesce(F.col(table.is_latest), F.lit(False))
        aggregates.append(F.count_if(flag).alias("_current"))
    per_key = df.groupBy(*keys).agg(*aggregates)

    rules = [("empty_table", ""), *[(rule, together) for rule in measures]]
    totals = [F.when(F.coalesce(F.sum("_rows"), F.lit(0)) == 0, 1).otherwise(0)]
    totals += [F.count_if(condition) for condition in measures.values()]
    for key in keys:
        rules.append(("null_key", key))
        totals.append(F.sum(F.when(F.col(key).isNull(), F.col("_rows"))))
    counts = per_key.agg(*[total.alias(f"_{i}") for i, total in enumerate(totals)])
    return _found(counts, name, rules)


def validate_all(tables: Sequence[tuple[TableConfig, DataFrame]]) -> DataFrame:
    """The issue list of all tables; a sound table has no row."""
    every = [table_issues(table, df) for table, df in tables]
    return reduce(DataFrame.unionByName, every).where(F.col("n") > 0)


def validation_summary(tables: Sequence[tuple[TableConfig, DataFrame]]) -> DataFrame:
    """One row: tables checked, valid and invalid."""
    every = reduce(DataFrame.unionByName, [table_issues(table, df) for table, df in tables])
    per_table = every.groupBy("table_name").agg((F.max("n") == 0).alias("valid"))
    return per_table.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if("valid").alias("valid_tables"),
        F.count_if(~F.col("valid")).alias("invalid_tables"),
    )
