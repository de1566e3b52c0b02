"""Reference tables: what changed, whether to load, and the table afterwards.

Two copies are compared by tagging their rows, adding up row digests per key and
aggregating once. That is one shuffle instead of the two of a full outer join, and
repeated keys neither multiply nor gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.canonical import fingerprint, row_digest, row_number60, table_fingerprint
from tidemark.operators.ordered import join_null_safe

INSERT, UPDATE, DELETE, SAME = "insert", "update", "delete", "unchanged"
LINEAGE = ("_load_id", "_table_hash")


def with_row_hash(
    df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "hashbytes_sha256"
) -> DataFrame:
    """Adds ``row_hash`` over the given columns, all by default."""
    return df.withColumn("row_hash", row_digest(df, columns, algorithm))


def with_lineage(df: DataFrame, load_id: str, content: str) -> DataFrame:
    """Adds the id of the load and the fingerprint of the whole table."""
    return df.withColumns(dict(zip(LINEAGE, (F.lit(load_id), F.lit(content)), strict=True)))


def _tagged(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    def side(df: DataFrame, in_source: bool) -> DataFrame:
        return df.select(
            *keys, F.lit(in_source).alias("_in_source"), row_number60(df, columns).alias("_number")
        )

    return side(source, True).unionByName(side(target, False))


def table_diff(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``action`` per key: insert, update, delete or unchanged.

    A key that repeats is compared by the content of all its rows.
    """
    tagged = _tagged(source, target, keys, list(columns or source.columns))
    in_source = F.col("_in_source")
    sums = tagged.groupBy(*keys).agg(
        F.count_if(in_source).alias("source_rows"),
        F.count_if(~in_source).alias("target_rows"),
        fingerprint(F.when(in_source, F.col("_number"))).alias("_source"),
        fingerprint(F.when(~in_source, F.col("_number"))).alias("_target"),
    )
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("_source") == F.col("_target"))
    action = (
        F.when(F.col("target_rows") == 0, INSERT)
        .when(F.col("source_rows") == 0, DELETE)
        .when(same, SAME)
        .otherwise(UPDATE)
    )
    return sums.select(*keys, "source_rows", "target_rows", action.alias("action"))


def table_diff_counts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys per action."""
    return table_diff(source, target, keys).groupBy("action").agg(F.count(F.lit(1)).alias("n_keys"))


def merge_changes(
    source: DataFrame, target: DataFrame, keys: Sequence[str], allow_deletes: bool = False
) -> DataFrame:
    """Only the rows a merge has to touch, with their ``action``.

    Inserted and updated rows as the source has them, deleted ones as the target had them.
    """
    actions = table_diff(source, target, keys).select(*keys, "action")
    names = list(keys)
    written = join_null_safe(source, actions.where(F.col("action").isin(INSERT, UPDATE)), names, "inner")
    out = written.select(*source.columns, "action")
    if not allow_deletes:
        return out
    gone = join_null_safe(target, actions.where(F.col("action") == DELETE), names, "inner")
    return out.unionByName(gone.select(*source.columns, "action"))


def upsert(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with every source row in place of its own; other rows stay."""
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def sync_with_deletes(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The upsert without the rows the source no longer has.

    A row that stays keeps what only the target knows of it.
    """
    own = [c for c in target.columns if c not in source.columns]
    if not own:
        return source.select(*target.columns)
    known = join_null_safe(source, target.select(*keys, *own), list(keys), "left")
    return known.select(*target.columns)


def load_decisions(
    prints: DataFrame,
    states: DataFrame,
    now: Column,
    force_after_days: int | None = None,
    force: bool = False,
) -> DataFrame:
    """Whether and why each table loads.

    ``prints`` has ``table_name, row_count, fingerprint`` of the source as it is;
    ``states`` has ``table_name, last_hash, last_loaded`` of what was published last.
    """
    joined = prints.join(states, "table_name", "left")
    age = F.date_diff(now, F.col("last_loaded"))
    reason = F.when(F.lit(force), "forced").when(F.col("last_hash").isNull(), "initial_load")
    reason = reason.when(F.col("last_hash") != F.col("fingerprint"), "hash_changed")
    if force_after_days is not None:
        reason = reason.when(age >= force_after_days, "forced_by_age")
    reason = reason.otherwise("unchanged")
    return joined.select(
        "table_name",
        "row_count",
        "fingerprint",
        reason.alias("reason"),
        (reason != "unchanged").alias("needs_load"),
    )


def cheap_change_check(marks: DataFrame, states: DataFrame) -> DataFrame:
    """A hint before hashing, from ``row_count`` and ``max_modified`` alone.

    ``marks`` and ``states`` have ``table_name, row_count, max_modified``.
    """
    last = states.select(
        "table_name",
        F.col("row_count").alias("last_row_count"),
        F.col("max_modified").alias("last_max_modified"),
    )
    hint = (
        F.when(F.col("last_row_count").isNull(), "initial_load")
        .when(F.col("row_count") != F.col("last_row_count"), "row_count_changed")
        .when(~F.col("max_modified").eqNullSafe(F.col("last_max_modified")), "modified_changed")
        .otherwise("maybe_unchanged")
    )
    return marks.join(last, "table_name", "left").withColumn("hint", hint)


def change_analysis(prints: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """How each table stands to its last load, and how often it seems to change."""
    joined = prints.join(states, "table_name", "left")
    days = F.date_diff(now, F.col("last_loaded")).cast("bigint")
    frequency = (
        F.when(days.isNull(), None).when(days < 1, "high").when(days < 7, "medium").otherwise("low")
    )
    return joined.select(
        "table_name",
        F.col("fingerprint").alias("current_hash"),
        F.col("row_count").alias("current_row_count"),
        F.col("last_hash").alias("last_known_hash"),
        (~F.col("fingerprint").eqNullSafe(F.col("last_hash"))).alias("hash_changed"),
        days.alias("days_since_last_change"),
        frequency.alias("change_frequency"),
    )


def source_target_match(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "hashbytes_sha256",
) -> DataFrame:
    """One row: row counts of both sides, and which of count and content differ."""
    wanted = list(columns or source.columns)

    def one(df: DataFrame, side: str) -> DataFrame:
        return table_fingerprint(df, wanted, algorithm).withColumn("_side", F.lit(side))

    both = one(source, "source").unionByName(one(target, "target"))

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(column)))

    return both.agg(
        of("source", "row_count").alias("source_rows"),
        of("target", "row_count").alias("target_rows"),
        (of("source", "row_count") != of("target", "row_count")).alias("row_count_mismatch"),
        (of("source", "fingerprint") != of("target", "fingerprint")).alias("hash_mismatch"),
    )
