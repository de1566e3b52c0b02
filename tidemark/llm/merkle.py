"""A Merkle manifest of documents as an append log of nodes in completion order.

Every source has a tree of arity three over its documents, and the roots of these trees are
the leaves of one more tree. Builders take aligned runs of 3**LEVELS leaves, so what they
write does not depend on how rows are dealt to tasks, and a source of any size is built by
many of them. A builder writes a node as soon as its children are complete: children stand
before parents, and the place of a node follows in closed form from the sizes of the
subtrees before it. A proof reads its siblings at these places. The roots of the runs are
the leaves of the next round; a source of n documents takes log(n) / log(3**LEVELS) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import group_starts, runs, tasks, written
from tidemark.llm.sqltext import crc32

ARITY = 3
#: Levels that one builder completes: 729 leaves and 1 093 nodes of 32 bytes.
LEVELS = 6
RUN = ARITY**LEVELS
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = (
    "key string, total long, run long, first_place long, nodes binary, "
    "ids array<long>, names array<string>, claimed array<binary>"
)


# ---- one run of leaves ---------------------------------------------------------


def digest(children: Iterable[bytes]) -> bytes:
    """The node over its children: digests are hashed as lower-case hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    up = 0
    while ARITY**up < leaves:
        up += 1
    return up


def place(level: int, index: int, leaves: int, top: int) -> int:
    """Where a node stands among the nodes of its run, in the order of completion.

    Before it come, on its own level and below, all nodes that end with it or earlier, and
    above it those that end before it begins.
    """
    end = min(leaves, (index + 1) * ARITY**level)
    before = sum(-(-end // ARITY**j) for j in range(level + 1))
    return before + sum(index // ARITY**j for j in range(1, top - level + 1)) - 1


def append_log(leaves: Iterable[bytes], top: int) -> list[bytes]:
    """Nodes of one run in the order of their completion; only open runs are remembered."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(top + 1)]

    def close(level: int) -> None:
        node = digest(waiting[level])
        waiting[level].clear()
        waiting[level + 1].append(node)
        log.append(node)

    for leaf in leaves:
        log.append(leaf)
        waiting[0].append(leaf)
        level = 0
        while level < top and len(waiting[level]) == ARITY:
            close(level)
            level += 1
    for level in range(top):
        if waiting[level]:
            close(level)
    return log


def siblings(nodes: bytes, index: int, leaves: int, top: int) -> Iterator[tuple[int, list[bytes]]]:
    """Level by level: how many of the others of its run stand left of the node, and all others."""
    for level in range(top):
        low = index - index % ARITY
        high = min(low + ARITY, -(-leaves // ARITY**level))
        others = [place(level, i, leaves, top) for i in range(low, high) if i != index]
        yield index - low, [nodes[DIGEST * p : DIGEST * (p + 1)] for p in others]
        index //= ARITY


def packed(steps: Iterable[tuple[int, list[bytes]]]) -> bytes:
    """A path as bytes: per level one byte for left and all others, then the others."""
    return b"".join(bytes([left * ARITY + len(others)]) + b"".join(others) for left, others in steps)


def unpacked(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        left, n = divmod(path[at], ARITY)
        at += 1
        yield left, [path[i : i + DIGEST] for i in range(at, at + n * DIGEST, DIGEST)]
        at += n * DIGEST


def fold(claimed: bytes, path: bytes) -> bytes:
    """The root that follows from a claimed leaf and the siblings of its path."""
    node = claimed
    for left, others in unpacked(path):
        node = digest([*others[:left], node, *others[left:]])
    return node


# ---- leaves and their ranks ----------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(columns[name]) for name in FIELDS]), 256))


def leaves(docs: DataFrame, copy_text: Column | None = None) -> DataFrame:
    """key (the source), id, name, digest, claimed: one leaf for each row of docs.

    claimed is the leaf of the copy under examination: its text is ``copy_text``, an
    expression over docs, by default the text itself. Nulls are told from empty values;
    other columns of docs are not read. Equal rows give equal leaves, each its own.
    """
    columns = {name: F.col(name) for name in FIELDS}
    digests = _leaf(columns)
    claimed = digests if copy_text is None else F.when(
        copy_text.eqNullSafe(F.col("text")), digests
    ).otherwise(_leaf(columns | {"text": copy_text}))
    return docs.select(
        F.col("source").cast("string").alias("key"),
        F.col("doc_id").cast("long").alias("id"),
        F.lit(None).cast("string").alias("name"),
        digests.alias("digest"),
        claimed.alias("claimed"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with rank (from 0) and total within each key, in the given order, nulls first.

    The rows are sorted once over all tasks, so one key may hold most of them. Each task
    numbers its own; only counts per task and key are summed up across tasks.
    """
    ordered = rows.repartitionByRange(tasks(rows), "key", *order).sortWithinPartitions("key", *order)
    marked = written(ordered.withColumn("mark", F.monotonically_increasing_id()), "ranked")
    marked = marked.withColumn("task", F.shiftright("mark", 33))
    per_task = marked.groupBy("key", "task").agg(F.min("mark").alias("first"), F.count("*").alias("n"))
    same = Window.partitionBy("key")
    before = same.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(
        F.col("key").alias("_key"),
        F.col("task").alias("_task"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(same).alias("total"),
    )
    joined = marked.join(
        offsets, F.col("key").eqNullSafe(F.col("_key")) & (F.col("task") == F.col("_task"))
    )
    return joined.select(*rows.columns, (F.col("mark") + F.col("_shift")).alias("rank"), "total")


# ---- the log -------------------------------------------------------------------


def _built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, 2):
        starts = group_starts(table, 2).tolist()
        rows = []
        for s, e in zip(starts, [*starts[1:], table.num_rows], strict=True):
            part = table.slice(s, e - s).to_pydict()
            key, run, total = part["key"][0], part["run"][0], part["total"][0]
            top = LEVELS if total > RUN else height(total)
            nodes = append_log(part["digest"], top)
            first = run * ((ARITY * RUN - 1) // (ARITY - 1))
            rows.append(
                (key, total, run, first, b"".join(nodes), part["id"], part["name"], part["claimed"])
            )
        types = [
            pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(),
            pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()),
        ]
        names = [f.split()[0] for f in LOG.split(", ")]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)


def _round(rows: DataFrame) -> DataFrame:
    """The log of one round: a row for each run of leaves."""
    runs_of = rows.withColumn("run", F.expr(f"rank div {RUN}"))
    built = (
        runs_of.select("key", "run", "rank", "total", "id", "name", "digest", "claimed")
        .repartition("key", "run")
        .sortWithinPartitions("key", "run", "rank")
        .mapInArrow(_built, LOG)
    )
    return written(built, "nodes")


def _last_node(log: DataFrame) -> Column:
    return F.substring("nodes", -DIGEST, DIGEST)


@dataclass(frozen=True)
class Tree:
    """Logs of the trees of all keys, one for each round from the leaves up."""

    logs: tuple[DataFrame, ...]

    @property
    def roots(self) -> DataFrame:
        """key, root of each tree."""
        tops = [log.where(F.col("total") <= RUN).select("key", _last_node(log).alias("root")) for log in self.logs]
        found = tops[0]
        for top in tops[1:]:
            found = found.union(top)
        return found


def build(rows: DataFrame) -> Tree:
    """The trees over ranked leaves (key, id, name, digest, claimed, rank, total)."""
    logs = [_round(rows)]
    while logs[-1].where(F.col("total") > RUN).limit(1).count():
        below = logs[-1].where(F.col("total") > RUN)
        upper = below.select(
            "key",
            F.lit(None).cast("long").alias("id"),
            F.lit(None).cast("string").alias("name"),
            _last_node(below).alias("digest"),
            F.lit(None).cast("binary").alias("claimed"),
            F.col("run").alias("rank"),
            F.expr(f"(total + {RUN - 1}) div {RUN}").alias("total"),
        )
        logs.append(_round(upper))
    return Tree(tuple(logs))


@dataclass(frozen=True)
class Manifest:
    """The trees of all sources and the tree over their roots."""

    sources: Tree
    top: Tree


def manifest(leaf_rows: DataFrame) -> Manifest:
    """The manifest of leaves as ``leaves`` gives them.

    Leaves of a source ascend by id, null ids first, equal ids by digest; sources ascend by
    the bytes of their names, the null source first. No leaves give empty logs.
    """
    sources = build(ranked(written(leaf_rows, "leaves"), ["id", "digest"]))
    none = F.lit(None)
    subroots = sources.roots.select(
        none.cast("string").alias("key"),
        none.cast("long").alias("id"),
        F.col("key").alias("name"),
        F.col("root").alias("digest"),
        none.cast("binary").alias("claimed"),
    )
    return Manifest(sources, build(ranked(written(subroots, "subroots"), ["name"])))


# ---- proofs --------------------------------------------------------------------


def _descended(batches: Iterable[pa.RecordBatch], documents: bool) -> Iterator[pa.RecordBatch]:
    """From the path above each run to the paths of its leaves."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            n, nodes, above = len(row["ids"]), row["nodes"], row["path"] or b""
            top = LEVELS if row["total"] > RUN else height(row["total"])
            paths = [packed(siblings(nodes, j, n, top)) + above for j in range(n)]
            if not documents:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["key"]] * n, pa.string()),
                        pa.array(range(row["run"] * RUN, row["run"] * RUN + n), pa.int64()),
                        pa.array(row["names"], pa.string()),
                        pa.array(paths, pa.binary()),
                    ],
                    ["key", "rank", "name", "path"],
                )
                continue
            own = [nodes[DIGEST * p : DIGEST * (p + 1)] for p in (place(0, j, n, top) for j in range(n))]
            folded = [fold(c, p) for c, p in zip(row["claimed"], paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array([row["key"]] * n, pa.string()),
                    pa.array(own, pa.binary()),
                    pa.array(paths, pa.binary()),
                    pa.array([_proof_digest(p) for p in paths], pa.string()),
                    pa.array(folded, pa.binary()),
                ],
                ["doc_id", "key", "leaf", "path", "proof_sha256", "folded"],
            )


def _proof_digest(path: bytes) -> str:
    return digest(sibling for _, others in unpacked(path) for sibling in others).hex()


PATHS = "key string, rank long, name string, path binary"
PROOFS = "doc_id long, key string, leaf binary, path binary, proof_sha256 string, folded binary"


def _paths(tree: Tree, above: DataFrame, documents: bool) -> DataFrame:
    """Paths of all leaves of the trees; ``above`` has the path over each tree (key, path).

    Rounds run from the top down. What is joined is one row a run, never one a leaf.
    """
    over = above.select(F.col("key").alias("_key"), F.col("path").alias("_path"))
    lower: DataFrame | None = None
    for level in range(len(tree.logs) - 1, -1, -1):
        log = tree.logs[level]
        tops = log.where(F.col("total") <= RUN).join(over, F.col("key").eqNullSafe(F.col("_key")), "left")
        rows = tops.select(*log.columns, F.col("_path").alias("path"))
        if lower is not None:
            paths = lower.select(F.col("key").alias("_key"), F.col("rank").alias("_run"), F.col("path").alias("_path"))
            same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("run") == F.col("_run"))
            inner = log.where(F.col("total") > RUN).join(paths, same)
            rows = rows.union(inner.select(*log.columns, F.col("_path").alias("path")))
        last = documents and level == 0
        lower = rows.mapInArrow(partial(_descended, documents=last), PROOFS if last else PATHS)
    return lower


def proofs(built: Manifest) -> DataFrame:
    """One row for each leaf: doc_id, source, leaf, subroot, root, path, proof_sha256,
    folded_root, verified.

    path holds the siblings level by level, see ``unpacked``; folded_root is what the
    claimed leaf and these siblings give, and verified says whether it is the root.
    """
    spark = built.sources.logs[0].sparkSession
    nothing = spark.createDataFrame([], "key string, path binary")
    over_sources = _paths(built.top, nothing, documents=False).select(F.col("name").alias("key"), "path")
    paths = _paths(built.sources, over_sources, documents=True)
    found = built.top.roots.first()
    root = F.lit(bytes(found["root"]) if found else None).cast("binary")
    subroots = built.sources.roots.select(F.col("key").alias("_key"), F.col("root").alias("_subroot"))
    joined = paths.join(subroots, F.col("key").eqNullSafe(F.col("_key")))

    def text(value: Column) -> Column:
        return F.lower(F.hex(value))

    return joined.select(
        "doc_id",
        F.col("key").alias("source"),
        text(F.col("leaf")).alias("leaf"),
        text(F.col("_subroot")).alias("subroot"),
        text(root).alias("root"),
        "path",
        "proof_sha256",
        text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def tampered_text() -> Column:
    """The text without its line ends where 2 divides the crc32 of the decimal doc_id."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


# ---- the same in SQL -----------------------------------------------------------


def _sql(levels: int, source_levels: int) -> str:
    """Every level written out: sources of up to 3**levels rows, up to 3**source_levels sources."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    parts = [
        f"""docs AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32("doc_id::VARCHAR")} % 2 = 0
              THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claimed
  FROM documents)""",
        """a0 AS (
  SELECT doc_id, tree, leaf, claimed AS folded, '' AS proof, leaf AS node,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM docs)""",
    ]

    def level(rows: str, carried: str, up: str, tree: str) -> str:
        """One level: runs are grouped, then every row of the run gets its siblings."""
        return f"""{up} AS (
  WITH nodes AS (SELECT {tree} AS tree, pos, any_value(node) AS node FROM {rows} GROUP BY ALL),
  sized AS (SELECT *, count(*) OVER (PARTITION BY tree) AS width FROM nodes),
  runs AS (SELECT tree, pos // 3 AS run, any_value(width) AS width, list(node ORDER BY pos) AS kids
           FROM sized GROUP BY ALL)
  SELECT {carried}, r.tree,
         CASE WHEN width = 1 THEN r.node ELSE sha256(array_to_string(kids, '')) END AS node,
         CASE WHEN width = 1 THEN proof
              ELSE proof || array_to_string(kids[:pos % 3] || kids[pos % 3 + 2:], '') END AS proof,
         CASE WHEN width = 1 THEN folded
              ELSE sha256(array_to_string(kids[:pos % 3], '') || folded || array_to_string(kids[pos % 3 + 2:], ''))
              END AS folded,
         pos // 3 AS pos
  FROM (SELECT * FROM {rows}) r JOIN runs ON runs.tree = r.tree AND runs.run = r.pos // 3)"""

    for j in range(levels):
        parts.append(level(f"a{j}", "doc_id, leaf", f"a{j + 1}", "tree"))
    parts.append(
        f"""b0 AS (
  SELECT doc_id, leaf, node AS subroot, node, folded, proof, tree AS pos, 0 AS tree FROM a{levels})"""
    )
    for j in range(source_levels):
        parts.append(level(f"b{j}", "doc_id, leaf, subroot", f"b{j + 1}", "tree"))
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = node AS verified
FROM b{source_levels}"""
    )


SQL = _sql(levels=11, source_levels=5)
