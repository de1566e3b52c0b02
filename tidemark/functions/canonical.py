"""One unambiguous text per row, the digest of that text, and table fingerprints.

The text does not depend on the session time zone, the row order or the engine's
way of printing a value: nulls have a mark of their own, and the separator and the
escape character are escaped inside text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marks of the canonical text.
SEPARATOR = "|"
NULL_MARK = "\\N"

# A digest contributes its first 15 hex digits (60 bits), summed in three lanes of
# 20 bits, so a lane overflows a 64-bit sum only beyond 2**43 rows.
_DIGITS = 15
_LANE_BITS = 20
_LANE_MASK = (1 << _LANE_BITS) - 1


def value_text(column: Column, data_type: T.DataType) -> Column:
    """Text of one value; null stays null."""
    if isinstance(data_type, T.StringType):
        doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
        return F.replace(doubled, F.lit(SEPARATOR), F.lit("\\" + SEPARATOR))
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # -0.0 and 0.0 are the same number and must have the same text
        return F.when(column == 0, F.lit("0.0")).otherwise(column.cast("string"))
    return column.cast("string")


def _types(df: DataFrame, columns: Sequence[str] | None) -> list[tuple[str, T.DataType]]:
    wanted = list(columns) if columns is not None else df.columns
    return [(c, df.schema[c].dataType) for c in wanted]


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Canonical text of the given columns (all of them by default)."""
    parts = [
        F.coalesce(value_text(F.col(c), t), F.lit(NULL_MARK)) for c, t in _types(df, columns)
    ]
    return F.concat_ws(SEPARATOR, *parts)


def row_digest(
    df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "hashbytes_sha256"
) -> Column:
    """Hex digest of the canonical text."""
    if algorithm == "hashbytes_md5":
        return F.md5(row_text(df, columns))
    if algorithm == "hashbytes_sha256":
        return F.sha2(row_text(df, columns), 256)
    raise ValueError(f"no row digest for {algorithm!r}")


def row_number60(
    df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "hashbytes_sha256"
) -> Column:
    """A number below 2**60 that stands for the row content."""
    if algorithm == "checksum":
        wanted = list(columns) if columns is not None else df.columns
        # presence of each value is hashed too: xxhash64 skips nulls
        nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in wanted])
        return F.shiftrightunsigned(F.xxhash64(nulls, *wanted), 4)
    digest = row_digest(df, columns, algorithm)
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")


def fingerprint(number: Column) -> Column:
    """Aggregate: order-free content fingerprint from per-row numbers.

    A sum, so equal rows do not cancel each other as they would under xor, and it is
    combined on the map side. Null numbers (rows left out by the caller) add nothing.
    """
    low = number.bitwiseAND(F.lit(_LANE_MASK))
    middle = F.shiftright(number, _LANE_BITS).bitwiseAND(F.lit(_LANE_MASK))
    high = F.shiftright(number, 2 * _LANE_BITS)

    def lane(part: Column, shift: int) -> Column:
        total = F.coalesce(F.sum(part), F.lit(0)).cast("decimal(19,0)")
        return total * F.lit(1 << shift).cast("decimal(13,0)")

    return (
        (lane(low, 0) + lane(middle, _LANE_BITS) + lane(high, 2 * _LANE_BITS))
        .cast("decimal(38,0)")
        .cast("string")
    )


def table_fingerprint(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "hashbytes_sha256",
    by: Sequence[str] = (),
) -> DataFrame:
    """``row_count`` and ``fingerprint`` of the table, or of each group of ``by``."""
    numbered = df.select(*by, row_number60(df, columns, algorithm).alias("_number"))
    return numbered.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), fingerprint(F.col("_number")).alias("fingerprint")
    )


def compare_fingerprints(
    df: DataFrame, variants: dict[str, tuple[str, Sequence[str] | None]]
) -> DataFrame:
    """Several fingerprints of one table from a single scan: name -> (algorithm, columns)."""
    numbered = df.select(
        *[row_number60(df, cols, algo).alias(name) for name, (algo, cols) in variants.items()]
    )
    return numbered.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[fingerprint(F.col(name)).alias(name) for name in variants],
    )
