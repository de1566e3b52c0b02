"""Near-duplicate documents: SimHash fingerprints joined on pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, group_starts, runs, slices, texts, tidy, written

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Six blocks of 64 bits. Up to four differing bits leave two blocks equal, so two equal
#: blocks are the key: keys of 20 to 22 bits instead of 12 to 13.
WIDTHS = (11, 11, 11, 11, 10, 10)
#: Fingerprints compared at once in one group; larger buckets are cut into pairs of chunks.
CHUNK = 2048


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the XXH64 bits of all word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        part = np.array(hashes[i : i + 4096], dtype=">u8")
        total += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


@tidy
def _fingerprints(batches: Iterable[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1)):
        values = np.array([fingerprint(t, size, seed) for t in texts(batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(values.view(np.int64))], ["doc_id", "print"]
        )


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, print (64 bits as a long) of each row; null and empty texts give zero."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_fingerprints, size=size, seed=seed), "doc_id long, print long"
    )


def block_keys() -> list:
    """A key for each pair of blocks: which pair, and the bits of both."""
    starts = np.concatenate([[0], np.cumsum(WIDTHS)]).tolist()
    block = [
        F.shiftrightunsigned("print", starts[i]).bitwiseAND((1 << w) - 1)
        for i, w in enumerate(WIDTHS)
    ]
    pairs = [(i, j) for i in range(len(WIDTHS)) for j in range(i)]
    return [
        F.lit(n << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j])
        for n, (i, j) in enumerate(pairs)
    ]


@tidy
def _near(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within each group, as a forest: enough for components, never all pairs."""
    for table in runs(batches, 3):
        starts = group_starts(table, 3)
        ends = np.append(starts[1:], table.num_rows)
        prints, docs = table.column(3).to_numpy().view(np.uint64), table.column(4).to_numpy()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            left, ids = prints[s:e], docs[s:e]
            while left.size > 1:
                reached, left, names, ids = [(left[0], ids[0])], left[1:], ids[:1], ids[1:]
                while reached and left.size:
                    one, name = reached.pop()
                    near = np.bitwise_count(left ^ one) <= radius
                    if near.any():
                        out.append((np.full(int(near.sum()), name), ids[near]))
                        reached.extend(zip(left[near], ids[near], strict=True))
                        left, ids = left[~near], ids[~near]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x[k] for x in out]), pa.int64()) for k in (0, 1)], ["a", "b"]
            )


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links between the documents of distinct fingerprints (print, doc_id).

    Two fingerprints within the radius are joined by links, directly or through others
    within the radius of both ends. A bucket above CHUNK is dealt to all pairs of its
    chunks, so that no task holds more than two chunks of it and no pair is left out.
    """
    if radius > len(WIDTHS) - 2:
        raise ValueError(f"the blocks find every pair up to {len(WIDTHS) - 2} differing bits")
    keyed = prints.select("print", "doc_id", F.explode(F.array(*block_keys())).alias("key"))
    sizes = keyed.groupBy("key").count().where("count > 1")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("print"), chunks).cast("int")
    dealt = (
        keyed.join(sizes, "key")
        .select("key", "print", "doc_id", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "print",
            "doc_id",
        )
    )
    return (
        dealt.repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInArrow(partial(_near, radius=radius), "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, print, component_id of each row of docs (doc_id, text, any others).

    component_id is the smallest doc_id reachable through fingerprints that differ in
    RADIUS bits or fewer. Texts without words (null, empty, white space) have fingerprint
    zero and link like any other. Rows of one doc_id with different texts each have their
    own fingerprint. A row with a null doc_id links nothing and has a null component_id.
    An empty table gives an empty result.
    """
    prints = written(fingerprints(docs), "prints")
    known = prints.where("doc_id is not null")
    classes = written(known.groupBy("print").agg(F.min("doc_id").alias("first_id")), "classes")
    links = near_links(classes.select("print", F.col("first_id").alias("doc_id")))
    # an id whose rows have different texts holds their classes together
    shared = known.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high"))
    several = known.join(shared.where("low < high").select("doc_id"), "doc_id").join(classes, "print")
    links = links.union(several.select("doc_id", "first_id"))
    found = components(links)
    classes = classes.join(found, classes["first_id"] == found["id"], "left").select(
        F.col("print").alias("class"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    return prints.join(classes, prints["print"] == classes["class"], "left").select(
        "doc_id",
        "print",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """docs without those that have a smaller document in their component.

    All columns stay. Rows with a null doc_id stay; rows that share a doc_id stay or go
    together.
    """
    gone = near_duplicates(docs).where("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
