"""Typed reads, rows that do not convert, and checks of schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decimals import decimal_problem, exact_decimal
from tidemark.functions.once import with_once

Issue = tuple[str, str, str]


class TooManyErrors(ValueError):
    """More rows failed to convert than the load allows."""


def _converted(field: T.StructField, strict: bool) -> Column:
    value, target = F.col(field.name), field.dataType
    if isinstance(target, T.DecimalType):
        return exact_decimal(value, target.precision, target.scale, strict).alias(field.name)
    return (value.cast(target) if strict else value.try_cast(target)).alias(field.name)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; a value that does not convert is an error."""
    return df.select(*[_converted(f, strict=True) for f in schema])


def conversion_problems(schema: T.StructType) -> Column:
    """Comma list of the columns of a row that do not convert; null if all do.

    Decimals are tested on their text: a cast would round away excess scale.
    """
    found = []
    for field in schema:
        value = F.col(field.name)
        fails = value.isNotNull() & _converted(field, strict=False).isNull()
        if isinstance(field.dataType, T.DecimalType):
            text = F.nullif(F.trim(value.cast("string")), F.lit(""))
            size = field.dataType
            too_long = decimal_problem(text, size.precision, size.scale).isNotNull()
            fails = too_long | (text.isNotNull() & _converted(field, strict=False).isNull())
        if not field.nullable:
            fails = fails | value.isNull()
        found.append(F.when(fails, F.lit(field.name)))
    return F.nullif(F.concat_ws(",", *found), F.lit(""))


def quarantine(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that convert, typed; and the rows that do not, as they came, with ``problems``."""
    marked = with_once(df, "problems", conversion_problems(schema))
    good = marked.where(F.col("problems").isNull()).select(
        *[_converted(f, strict=False) for f in schema]
    )
    return good, marked.where(F.col("problems").isNotNull())


def error_rate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: rows, rows that do not convert, and their share."""
    counts = df.select(conversion_problems(schema).alias("problems")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("problems").alias("n_bad")
    )
    share = F.when(F.col("n_rows") == 0, F.lit(0.0)).otherwise(
        F.col("n_bad").cast("double") / F.col("n_rows")
    )
    return counts.withColumn("error_rate", share)


def require_error_rate(df: DataFrame, schema: T.StructType, threshold: float) -> None:
    """Stop a load whose share of bad rows is above ``threshold``."""
    found = error_rate(df, schema).first()
    if found["error_rate"] > threshold:
        raise TooManyErrors(
            f"{found['n_bad']} of {found['n_rows']} rows do not convert, "
            f"more than the allowed share of {threshold}"
        )


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, decimal size, rows and nulls, from one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"_nulls_{i}") for i, f in enumerate(df.schema)],
    )
    described = []
    for i, field in enumerate(df.schema):
        decimal = field.dataType if isinstance(field.dataType, T.DecimalType) else None
        described.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(i + 1).alias("ordinal"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(decimal.precision if decimal else None).cast("int").alias("precision"),
                F.lit(decimal.scale if decimal else None).cast("int").alias("scale"),
                F.col("_rows").alias("n_rows"),
                F.col(f"_nulls_{i}").alias("n_nulls"),
            )
        )
    return counts.select(F.inline(F.array(*described)))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[Issue]:
    """Required columns the table lacks, as (column, rule, detail)."""
    return [(c, "missing_column", "not in the table") for c in required if c not in df.columns]


def schema_issues(declared: T.StructType, actual: T.StructType) -> list[Issue]:
    """Where ``actual`` cannot hold what ``declared`` promises, as (column, rule, detail)."""
    have = {f.name: f.dataType for f in actual}
    issues: list[Issue] = []
    for field in declared:
        want, got = field.dataType, have.get(field.name)
        if got is None:
            issues.append((field.name, "missing_column", "not in the table"))
        elif isinstance(want, T.DecimalType) and isinstance(got, T.DecimalType):
            for rule in ("precision", "scale"):
                declared_size, stored_size = getattr(want, rule), getattr(got, rule)
                if declared_size != stored_size:
                    issues.append((field.name, rule, f"{declared_size} became {stored_size}"))
        elif want != got:
            rule = "not_decimal" if isinstance(want, T.DecimalType) else "type"
            issues.append(
                (field.name, rule, f"{want.simpleString()} became {got.simpleString()}")
            )
    return issues


def same_schema(left: DataFrame, right: DataFrame) -> bool:
    """Same columns in the same order with the same types."""
    return [(f.name, f.dataType) for f in left.schema] == [
        (f.name, f.dataType) for f in right.schema
    ]


# A file with the type on the left is read as the type on the right without loss.
WIDER = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
    ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"),
}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new type."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        whole = new.precision - new.scale >= old.precision - old.scale
        return whole and new.scale >= old.scale
    return (old.simpleString(), new.simpleString()) in WIDER


def type_conflicts(published: T.StructType, new: T.StructType) -> list[Issue]:
    """Columns whose new type is neither the published one nor wider, as (column, rule, detail)."""
    have = {f.name: f.dataType for f in published}
    return [
        (f.name, "type", f"{have[f.name].simpleString()} became {f.dataType.simpleString()}")
        for f in new
        if f.name in have and have[f.name] != f.dataType and not widens(have[f.name], f.dataType)
    ]


def merged_schema(published: T.StructType, new: T.StructType) -> T.StructType:
    """The published columns in their order, in the wider type, and the new ones after them.

    The last column stays last: partition columns stand there.
    """
    types = {f.name: f.dataType for f in new}
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in published]
    names = {f.name for f in published}
    added = [T.StructField(f.name, f.dataType) for f in new if f.name not in names]
    if published.names and new.names and published.names[-1] == new.names[-1]:
        return T.StructType([*fields[:-1], *added, fields[-1]])
    return T.StructType([*fields, *added])


def in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df in the columns and types of a schema; columns it lacks are null."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
