"""Row order that lets row-group statistics prune on several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells of each column are numbered with so many bits.
BITS = 10


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise ValueError(f"rows are clustered by numbers, dates and times, not by {name} ({kind.simpleString()})")


def clustered(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows of df along a space-filling curve (Z order) over the columns.

    The range of each column is cut into 2**bits equal cells, and the bits of the cells are
    interleaved. Nulls and NaN are in cell 0. Rows of one cell are dealt on by the columns and by
    their content, so a crowded cell is spread over several tasks; only rows that are equal in
    every comparable column stay together. One row of least and greatest values comes to the driver.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("between 1 and 62 bits of cells are needed")
    numbers = [F.when(~F.isnan(n), n) for n in (_number(df, c) for c in columns)]
    bounds = [f(n).alias(f"{i}{f.__name__}") for i, n in enumerate(numbers) for f in (F.min, F.max)]
    ends = df.agg(*bounds).first()
    curve = F.lit(0).cast("bigint")
    for i, number in enumerate(numbers):
        low, high = ends[2 * i], ends[2 * i + 1]
        if low is None or not low < high or high - low == float("inf"):
            continue
        inside = F.width_bucket(number, F.lit(low), F.lit(high), F.lit(1 << bits)) - 1
        # a source that changed since the bounds were taken may have values beyond them
        known = F.greatest(F.least(inside, F.lit((1 << bits) - 1)), F.lit(0))
        cell = F.when(number.isNotNull(), known).otherwise(0).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("bigint"))
            curve = curve.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return (
        df.withColumn("_curve", curve)
        .repartitionByRange("_curve", *columns, F.xxhash64(*plain))
        .sortWithinPartitions("_curve", *columns)
        .drop("_curve")
    )
