"""Order-dependent steps per key that hold when one key has most of the rows.

A plain window puts every row of a key into one task. ``latest_per_key`` avoids that
because Spark keeps only the best row per key before the shuffle. Steps that need
each row's neighbours or its position use ``OrderedRows``: it counts the rows per key
first, and only keys above the limit are cut into consecutive slices by a range
shuffle. What has to cross a cut is carried by the slice edges, one row per slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, max_group_rows, rows_per_slice

SLICE = "_slice"
# Counted rows up to which a table of keys or slice edges is broadcast.
BROADCAST_ROWS = 100_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys where null matches null; the left keys are kept."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def _small(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast a table whose number of rows was counted and is small."""
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``; Spark prunes to one row per key map-side."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


@dataclass(frozen=True)
class OrderedRows:
    """Rows with a total order per key, ready for neighbour and position steps."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    n_edges: int = 0

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        unique_on: Sequence[str] = (),
        max_rows: int | None = None,
        counts: DataFrame | None = None,
    ) -> OrderedRows:
        """Choose between whole keys and slices by an exact count per key.

        ``counts`` (the keys and ``_rows``) saves counting where the caller knows them.

        With ``unique_on``, only the last row of each (keys, unique_on) stays.
        Slice numbers are checkpointed: the cuts come from a sample and must not move
        when a task is run again or the rows are read twice.
        """
        spark = df.sparkSession
        limit = max_rows or max_group_rows(spark)
        if counts is None:
            counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        hot = counts.where(F.col("_rows") > limit)
        found = hot.agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("keys")).first()
        if not found["keys"]:
            return cls(df, tuple(keys), tuple(order))._last_of(unique_on)

        ensure_checkpoint_dir(spark)
        hot_rows, other_rows = df, None
        if keys:
            # few by construction: each stands for more than ``limit`` rows
            hot_keys = _small(hot.select(*keys).checkpoint(), found["keys"])
            hot_rows = join_null_safe(df, hot_keys, keys, "left_semi")
            other_rows = join_null_safe(df, hot_keys, keys, "left_anti")
        if unique_on:
            # before the range shuffle, which cannot part rows that are equal in the order
            hot_rows = latest_per_key(hot_rows, [*keys, *unique_on], order)
        slices = max(2, math.ceil(found["rows"] / min(limit, rows_per_slice(spark))))
        sliced = (
            hot_rows.repartitionByRange(slices, *keys, *order)
            .withColumn(SLICE, F.spark_partition_id())
            .checkpoint()
        )
        if other_rows is not None:
            sliced = sliced.unionByName(other_rows.withColumn(SLICE, F.lit(-1)))
        return cls(sliced, tuple(keys), tuple(order), slices + found["keys"])._last_of(unique_on)

    def _last_of(self, unique_on: Sequence[str]) -> OrderedRows:
        """Keep the last of the rows equal in ``unique_on``; they are in one group."""
        if not unique_on:
            return self
        window = Window.partitionBy(*self._groups).orderBy(*self.order)
        stamp = F.struct(*unique_on)
        following = self.df.withColumn("_after", F.lead(stamp).over(window))
        return replace(self, df=following.where(~stamp.eqNullSafe(F.col("_after"))).drop("_after"))

    @property
    def cut(self) -> bool:
        """Whether some key was cut into slices."""
        return self.n_edges > 0

    @property
    def _groups(self) -> tuple[str, ...]:
        return (*self.keys, SLICE) if self.cut else self.keys

    def apply(self, step: Callable[[DataFrame], DataFrame]) -> OrderedRows:
        """A step that neither reorders rows nor drops the key and order columns."""
        return replace(self, df=step(self.df))

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE) if self.cut else self.df

    def previous(self, columns: Sequence[str], out: str) -> OrderedRows:
        """Adds ``out``: struct of ``columns`` of the row before; null for the first."""
        return self._neighbour(columns, out, F.lag, F.max)

    def next(self, columns: Sequence[str], out: str) -> OrderedRows:
        """Adds ``out``: struct of ``columns`` of the row after; null for the last."""
        return self._neighbour(columns, out, F.lead, F.min)

    def _neighbour(
        self,
        columns: Sequence[str],
        out: str,
        step: Callable[[Column], Column],
        edge: Callable[[Column], Column],
    ) -> OrderedRows:
        payload = F.struct(*columns)
        window = Window.partitionBy(*self._groups).orderBy(*self.order)
        local = self.df.withColumn(out, step(payload).over(window))
        if not self.cut:
            return replace(self, df=local)
        # a slice shows its last row to the slice after it, or its first to the one before
        edges = (
            self.df.where(F.col(SLICE) >= 0)
            .groupBy(*self._groups)
            .agg(edge(F.struct(*self.order, payload.alias("_payload"))).alias("_edge"))
        )
        across = Window.partitionBy(*self.keys).orderBy(SLICE)
        carried = edges.select(
            *self._groups, step(F.col("_edge")["_payload"]).over(across).alias("_carried")
        ).where(F.col("_carried").isNotNull())
        joined = join_null_safe(local, _small(carried, self.n_edges), self._groups, "left")
        return replace(self, df=joined.withColumn(out, F.coalesce(out, "_carried")).drop("_carried"))

    def positions(self, out: str) -> OrderedRows:
        """Adds ``out``: 1-based position of the row within its key."""
        window = Window.partitionBy(*self._groups).orderBy(*self.order)
        local = self.df.withColumn(out, F.row_number().over(window).cast("bigint"))
        if not self.cut:
            return replace(self, df=local)
        sizes = (
            self.df.where(F.col(SLICE) >= 0)
            .groupBy(*self._groups)
            .agg(F.count(F.lit(1)).alias("_size"))
        )
        before = (
            Window.partitionBy(*self.keys)
            .orderBy(SLICE)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
        )
        offsets = sizes.select(*self._groups, F.sum("_size").over(before).alias("_offset"))
        joined = join_null_safe(local, _small(offsets, self.n_edges), self._groups, "left")
        shifted = F.col(out) + F.coalesce(F.col("_offset"), F.lit(0))
        return replace(self, df=joined.withColumn(out, shifted).drop("_offset"))
