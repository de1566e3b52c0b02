"""Near-duplicate vectors: a forest of random-projection trees with spill.

Each tree halves the vectors of a label again and again at the median along a random
direction; vectors near the cut go to both sides. Vectors that share a leaf of any tree are
compared exactly. A pair that shares leaves of several trees counts in the first of them,
so links are added up without a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, group_starts, runs, written

COSINE = 0.93
TREES = 3
#: Vectors that a leaf may hold before it is split again.
LEAF = 512
#: Half the width of the overlap at a cut, as a difference of projections of unit vectors
#: on a unit direction times the root of the dimension. Linked vectors differ by a distance
#: of 0.374 at most, thus by 0.374 times a standard normal number here.
SPILL = 0.3
#: Levels of a tree. A leaf of the last level may be of any size; so may a dense group.
DEPTH = 32
#: Members of a leaf that one task compares with as many others.
CHUNK = 1024


def unit(vector: list[float | None] | None) -> np.ndarray | None:
    """The vector over its length in double precision; None if it links with nothing."""
    if vector is None or any(x is None for x in vector):
        return None
    values = np.array(vector, np.float64)
    if not values.size or not np.isfinite(values).all():
        return None
    top = np.abs(values).max()
    if top == 0:
        return None
    values = values / top
    return values / np.sqrt((values**2).sum())


def directions(seed: int, size: int) -> np.ndarray:
    """The direction of each level of each tree; all cuts of a level share it."""
    values = np.random.default_rng([seed, size]).standard_normal((TREES * DEPTH, size))
    return values * np.sqrt(size) / np.sqrt((values**2).sum(axis=1, keepdims=True))


def _units(batches: Iterable[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Usable vectors, of unit length, with their projections."""
    drawn: dict[int, np.ndarray] = {}
    for batch in batches:
        ids, labels, vectors = (c.to_pylist() for c in batch.columns)
        rows = [(i, x, u) for i, x, v in zip(ids, labels, vectors, strict=True) if (u := unit(v)) is not None]
        along = []
        for _, _, u in rows:
            if u.size not in drawn:
                drawn[u.size] = directions(seed, u.size)
            along.append((drawn[u.size] @ u).tolist())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _, _ in rows], pa.int64()),
                pa.array([x for _, x, _ in rows], pa.string()),
                pa.array([u.tobytes() for _, _, u in rows], pa.binary()),
                pa.array(along, pa.list_(pa.float32())),
            ],
            ["vec_id", "label", "unit", "along"],
        )


def grow(classes: DataFrame, leaf: int) -> DataFrame:
    """tree, label, node, vec: the leaves, a row for each leaf a vector is in.

    Every round cuts the nodes above `leaf` members at their median, found by one
    aggregation over all members; the medians stay in Spark. Nodes that a cut does not make
    smaller stay as they are.
    """
    trees = [F.struct(F.lit(t).alias("tree"), F.slice("along", t * DEPTH + 1, DEPTH).alias("along")) for t in range(TREES)]
    rows = classes.select("label", F.col("vec_id").alias("vec"), F.explode(F.array(*trees)).alias("of"))
    current = written(
        rows.select("of.tree", "label", F.lit(1).cast("long").alias("node"), "vec", "of.along"), "nodes"
    )
    keys, leaves = ["tree", "label", "node"], ["tree", "label", "node", "vec"]
    done = current.select(*leaves).limit(0)
    for level in range(DEPTH):
        sizes = current.groupBy(*keys).agg(F.count("*").alias("n"))
        large = written(sizes.where(F.col("n") > leaf), "sizes")
        done = done.union(current.join(large, keys, "left_anti").select(*leaves))
        if large.isEmpty():
            return done
        split = current.join(large, keys).withColumn("at", F.get("along", F.lit(level)))
        cuts = split.groupBy(*keys).agg(F.percentile_approx("at", 0.5, 1000).alias("cut"))
        low = F.when(F.col("at") <= F.col("cut") + SPILL, F.col("node") * 2)
        high = F.when(F.col("at") > F.col("cut") - SPILL, F.col("node") * 2 + 1)
        sides = split.join(written(cuts, "cuts"), keys).withColumn("child", F.explode(F.array_compact(F.array(low, high))))
        # a node whose larger side keeps nine tenths is one dense group: splitting ends
        grown = sides.groupBy(*keys, "child").agg(F.count("*").alias("m"), F.max("n").alias("n"))
        dense = written(grown.where(F.col("m") > 0.9 * F.col("n")).select(*keys).distinct(), "dense")
        done = done.union(current.join(dense, keys).select(*leaves))
        current = written(
            sides.join(dense, keys, "left_anti").select("tree", "label", F.col("child").alias("node"), "vec", "along"),
            "nodes",
        )
    return done.union(current.select(*leaves))


def joined(matrix: np.ndarray) -> np.ndarray:
    """For each row of a symmetric 0/1 matrix the first row it can reach."""
    names = np.arange(len(matrix))
    while True:
        new = np.minimum(names, np.where(matrix, names, len(names)).min(axis=1))
        new = new[new]
        if (new == names).all():
            return names
        names = new


def share_leaf(paths: list[list[dict]], leaf: tuple[int, int]) -> np.ndarray:
    """Which vectors share a leaf before this one, by tree and node."""
    found = [
        (i, (p["tree"], p["node"])) for i, path in enumerate(paths) for p in path if (p["tree"], p["node"]) < leaf
    ]
    places = {leaf: k for k, leaf in enumerate(dict.fromkeys(leaf for _, leaf in found))}
    member = np.zeros((len(paths), len(places)), np.float32)
    for i, leaf in found:
        member[i, places[leaf]] = 1
    return member @ member.T > 0


def _compared(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Per pair of chunks of a leaf: how many links each vector has, and whom it reaches."""
    for table in runs(batches, 5):
        starts = group_starts(table, 5)
        ends = np.append(starts[1:], table.num_rows)
        tree, node, low, high, own, vec, weight = (table.column(i).to_numpy() for i in (0, 2, 3, 4, 5, 6, 7))
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s < 2:
                continue
            units = np.array([np.frombuffer(x) for x in table.column(8).slice(s, e - s).to_pylist()])
            near = units @ units.T >= least
            np.fill_diagonal(near, False)
            if low[s] != high[s]:  # within a chunk pairs are compared where it meets itself
                near &= own[s:e, None] != own[None, s:e]
            rows = np.flatnonzero(near.any(axis=1))
            if not rows.size:
                continue
            near = near[np.ix_(rows, rows)]
            reached = joined(near)
            paths = table.column(9).slice(s, e - s).take(pa.array(rows)).to_pylist()
            near &= ~share_leaf(paths, (int(tree[s]), int(node[s])))
            ids = vec[s:e][rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(ids[reached], pa.int64()),
                    pa.array(near @ weight[s:e][rows].astype(np.int64), pa.int64()),
                ],
                ["vec", "reaches", "links"],
            )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, leaf: int = LEAF, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors (vec_id, embedding, label).

    Vectors of one label that is not null are linked if their cosine in double precision is
    `cosine` or more and they share a leaf. n_links counts the other rows linked directly,
    component_id is the smallest vec_id reachable, kept says that it is the row's own.
    Null and zero vectors, and those with null or non-finite components, link with
    nothing. Equal vectors are one class and linked to each other; vectors of different
    length do not meet. A row with a null vec_id links nothing: 0, null, false. Rows that
    repeat a vec_id count as one vector if they are equal.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>")
    )
    size = F.coalesce(F.size("embedding"), F.lit(0)).cast("string")
    usable = rows.where("vec_id is not null and label is not null").select(
        "vec_id", F.concat(size, F.lit(":"), "label").alias("label"), "embedding"
    )
    units = written(
        usable.distinct().mapInArrow(partial(_units, seed=seed), "vec_id long, label string, unit binary, along array<float>"),
        "units",
    )
    classes = units.groupBy("label", "unit").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("many"), F.first("along").alias("along")
    )
    classes = written(classes, "classes")
    leaves = written(grow(classes, leaf), "leaves")
    paths = leaves.groupBy(F.col("vec").alias("vec_id")).agg(F.collect_list(F.struct("tree", "node")).alias("paths"))
    known = classes.select("vec_id", "many", "unit").join(paths, "vec_id")
    keys = ["tree", "label", "node"]
    chunks = leaves.groupBy(*keys).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = (
        leaves.join(known, leaves["vec"] == known["vec_id"])
        .join(chunks, keys)
        .select("*", F.pmod(F.xxhash64("vec"), "chunks").cast("int").alias("own"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select(
            *keys,
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "vec",
            "many",
            "unit",
            "paths",
        )
    )
    place = [*keys, "low", "high"]
    found = written(
        dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(
            partial(_compared, least=cosine), "vec long, reaches long, links long"
        ),
        "links",
    )
    counts = found.groupBy("vec").agg(F.sum("links").alias("links"))
    # a vec_id with several different vectors holds their classes together
    first = units.select("vec_id", "label", "unit").join(
        classes.select("label", "unit", "many", F.col("vec_id").alias("first")), ["label", "unit"]
    ).select("vec_id", "first", "many")
    first = written(first, "members")
    links = found.select("vec", "reaches").union(first.where("vec_id <> first").select("vec_id", "first"))
    reached = components(links)
    summed = (
        first.join(counts, first["first"] == counts["vec"], "left")
        .groupBy("vec_id")
        .agg(F.sum(F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    )
    return (
        rows.select("vec_id")
        .join(summed, "vec_id", "left")
        .join(reached.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


#: near_duplicates() as DuckDB SQL over `embeddings`, comparing all pairs of a label.
SQL = """
with recursive usable as (
  select vec_id, label, cast(embedding as double[]) as v, len(embedding) as d from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.d = b.d and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach as (
  select vec_id as id, vec_id as other from embeddings
  union
  select r.id, l.b from reach r join links l on l.a = r.other
), least as (select id, min(other) as component_id from reach group by id)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links, m.component_id, e.vec_id = m.component_id as kept
from embeddings e join least m on m.id = e.vec_id
"""
