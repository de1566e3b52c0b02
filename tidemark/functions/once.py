"""Columns that cost much and are filtered on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row.

    A filter on an ordinary computed column is moved below it and repeats the whole
    expression. A filter does not pass an explode of its own output.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
