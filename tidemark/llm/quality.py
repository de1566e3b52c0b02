"""Quality scores: a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = (
    "log_bytes upper digits punctuation marks pipes spaces foreign word_length vocabulary lines "
    "repeated_lines"
).split()
#: How far each class covariance is drawn to the pooled one, and that to its diagonal.
TO_POOLED = 0.1
TO_DIAGONAL = 0.05
RIDGE = 1e-4
THRESHOLD = 0.3


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
    table[[ord(c) for c in "#$%&*!"]] = 5
    table[ord("|")] = 6
    table[65:91], table[97:123], table[48:58] = 1, 2, 3
    table[[32, *range(9, 14)]] = 7
    table[128:] = 8
    return table


_CLASSES = _class_table()


def statistics(text: bytes) -> list[float]:
    """Numbers of a whole text, put on scales on which classes are near to normal."""
    size = len(text)
    counts = np.zeros(9)
    for i in range(0, size, 1 << 20):
        counts += np.bincount(_CLASSES[np.frombuffer(text[i : i + (1 << 20)], np.uint8)], minlength=9)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, size)
    root = lambda x: float(np.sqrt(x / n))
    return [
        float(np.log1p(size)),
        root(counts[1]),
        root(counts[3]),
        root(counts[4] + counts[5] + counts[6]),
        root(counts[5]),
        root(counts[6]),
        root(counts[7]),
        root(counts[8]),
        float(np.log1p(size / max(1, len(words)))),
        # distinct words against what a text of this length usually has
        float(np.log1p(len(set(words))) - 0.9 * np.log1p(len(words))),
        root(len(lines)),
        float(np.sqrt(1 - len(set(lines)) / len(lines))) if lines else 0.0,
    ]


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics((t or "").encode("utf-8")) for t in batch.column(1).to_pylist()]
        values = np.array(rows, np.float64).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(values[:, i]) for i in range(len(STATISTICS)))],
            ["doc_id", *STATISTICS],
        )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS of each row of docs; a null text counts as an empty one."""
    schema = ", ".join(["doc_id long", *(f"{s} double" for s in STATISTICS)])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_measured, schema)


@dataclass(frozen=True)
class Model:
    """For each class: prior's logarithm, mean, Cholesky factor and its log determinant."""

    classes: tuple[tuple[float, np.ndarray, np.ndarray, float], ...]


def fit(measured: DataFrame, labels: DataFrame, labelled: Column) -> Model:
    """Class means and shrunk covariances from all labelled rows.

    labels has doc_id and quality (0 or 1; others and null are left out; a document with
    both labels counts once for each). Sums and cross products are added up in Spark; one
    row per class comes to the driver. A class without rows takes the pooled figures.
    """
    d = len(STATISTICS)
    known = labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("quality").cast("int").alias("class"))
    rows = measured.where(labelled).join(known.where("class in (0, 1)").distinct(), F.col("doc_id") == F.col("labelled_id"))
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(STATISTICS)]
    sums += [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]
    found = {r["class"]: r for r in rows.groupBy("class").agg(F.count("*").alias("n"), *sums).collect()}
    n, total, cross = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for c, row in found.items():
        n[c] = row["n"]
        total[c] = [row[f"s{i}"] for i in range(d)]
        for i, j in pairs:
            cross[c, i, j] = cross[c, j, i] = row[f"p{i}_{j}"]
    if not n.sum():
        return Model(())
    means = [total[c] / n[c] if n[c] else total.sum(axis=0) / n.sum() for c in (0, 1)]
    spread = [cross[c] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (spread[0] + spread[1]) / n.sum()
    pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + RIDGE * np.eye(d)
    classes = []
    for c in (0, 1):
        own = spread[c] / n[c] if n[c] else pooled
        factor = np.linalg.cholesky((1 - TO_POOLED) * own + TO_POOLED * pooled)
        prior = float(np.log((n[c] + 1) / (n.sum() + 2)))
        classes.append((prior, means[c], factor, float(2 * np.log(np.diag(factor)).sum())))
    return Model(tuple(classes))


def densities(values: np.ndarray, model: Model) -> np.ndarray:
    """Log prior plus log density of each row under each class."""
    out = []
    for prior, mean, factor, volume in model.classes:
        solved = np.linalg.solve(factor, (values - mean).T)
        out.append(prior - 0.5 * (volume + (solved**2).sum(axis=0)))
    return np.array(out).T


def _scored(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([batch.column(i + 1).to_numpy() for i in range(len(STATISTICS))]).T
        score = np.full(len(values), 0.5)
        if model.classes and len(values):
            logs = densities(values, model)
            score = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )


def score(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (probability of quality 1), predicted of each measured row.

    Without any labelled row every score is one half. Rows with a null doc_id and repeated
    rows are scored like any other.
    """
    return measured.mapInArrow(partial(_scored, model=model), "doc_id long, score double, predicted int")
