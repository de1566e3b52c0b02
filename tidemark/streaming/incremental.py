"""Incremental append as a stream: only files not seen before, each exactly once.

Spark's checkpoint remembers the files and the id of the query. A load is named by this id
and the batch's number: a batch that is run again after a failure is the same load and
counts once, and a stream with another checkpoint never meets the loads of this one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import AppendTable
from tidemark.plans.jobs import DATA, utc_now
from tidemark.sinks.store import APPEND, Store


def append_new_files(
    spark: SparkSession,
    store: Store,
    table: AppendTable,
    source_folder: str,
    schema: T.StructType,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Append the rows of all unseen files and stop; returns how many rows came in.

    ``checkpoint`` must lie on storage that every executor and the next run can reach.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_folder)
    if table.where:
        stream = stream.where(F.expr(table.where))
    taken = []

    def write(batch: DataFrame, batch_id: int) -> None:
        # set by Spark in the thread of the stream; the same for one checkpoint
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the id of the streaming query is not known")
        load_id = f"stream-{query_id}-{batch_id:012d}"
        if store.published(table.table, load_id) is not None:
            return
        written = store.write(
            batch, table.table, DATA, load_id, APPEND, table.watermark_column, cluster=table.cluster
        )
        store.publish(table.table, table.kind, [written], utc_now(), "stream")
        taken.append(written.records)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(taken)
