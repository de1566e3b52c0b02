"""Reading the given tables, and the shape every registered query has."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Case(NamedTuple):
    """A query on Spark and, where plain SQL can say the same, that SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
