"""What several operators share: written steps, rows of a sorted partition, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the ASCII controls from tab to carriage return.
#: bytes.split() without an argument splits at exactly these.
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    A local session without that setting gets a temporary folder; any other is refused.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, executors may go."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by written() that no later step reads."""
    spark = df.sparkSession
    root = shared_folder(spark)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(
            jvm.org.apache.hadoop.fs.Path(root).toUri().getPath() + "/"
        ):
            path.getFileSystem(conf).delete(path, True)


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most so many rows and bytes of one text column.

    A row above the size is alone. Texts take several times their bytes as Python objects.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        inside = np.cumsum(lengths[at : at + rows], dtype=np.int64) <= size
        n = max(1, int(inside.sum()))
        yield batch.slice(at, n)
        at += n


def tidy(step: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A step over Arrow batches that gives unused Arrow memory back when its task ends.

    Python workers serve many tasks of many stages; without this they keep the most that any
    of them needed.
    """

    @wraps(step)
    def run(*args, **settings):
        try:
            yield from step(*args, **settings)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups: consecutive rows that agree in the first `keys` columns.

    The input is sorted by those columns. Small groups come many to a table; a group is
    never cut, so a caller bounds the size of groups beforehand.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        starts = group_starts(table, keys)
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def group_starts(table: pa.Table, keys: int) -> np.ndarray:
    """First row of each run of equal keys; keys are not null."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[:1] = True
    for i in range(keys):
        values = table.column(i).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


@tidy
def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition, cut down to one edge from each node to its smallest relative."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(x, root(x)) for x in parent]
    stars = [(x, r) for x, r in stars if x != r]
    for i in range(0, len(stars), 100_000):
        part = stars[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())],
            ["child", "parent"],
        )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (two long columns): id, component_id.

    One row per node that has an edge to another; component_id is the smallest node that
    can be reached. Edges with a null end and loops count for nothing. Each task first
    cuts its own edges down to a forest; then alternating star steps (every node points
    its larger neighbours, then its smaller ones, to the smallest) run until nothing
    changes. Each round is a written table, and nothing but a count and a sum of hashes
    comes to the driver.
    """
    a, b = edges.columns
    edges = edges.select(
        F.greatest(a, b).cast("long").alias("child"), F.least(a, b).cast("long").alias("parent")
    ).where("child > parent")
    edges = edges.mapInArrow(_forest, "child long, parent long")
    current, before = written(edges, "edges"), None
    while True:
        row = current.agg(F.count("*"), F.sum(F.hash("child", "parent").cast("long"))).first()
        if before == tuple(row):
            return current.select(
                F.col("child").alias("id"), F.col("parent").alias("component_id")
            ).union(
                current.select(F.col("parent").alias("id"), F.col("parent").alias("component_id")).distinct()
            )
        before = tuple(row)
        smaller = _smaller(_larger(current))
        last, current = current, written(smaller, "edges")
        discard(last)


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("parent").alias("node"), F.col("child").alias("other")).union(
        edges.select(F.col("child").alias("node"), F.col("parent").alias("other"))
    )
    least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    return (
        edges.join(least, edges["parent"] == least["node"])
        .select("child", F.col("least").alias("parent"))
        .distinct()
    )


def _smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("least"))
    moved = edges.join(least, edges["child"] == least["node"]).where("parent > least")
    return (
        moved.select(F.col("parent").alias("child"), F.col("least").alias("parent"))
        .union(least.select(F.col("node").alias("child"), F.col("least").alias("parent")))
        .distinct()
    )
