"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, tidy

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
WIDTH = 16
#: Labelled rows of each language that are fitted, at most in expectation; the documented
#: bound of the sample. Longer texts than SAMPLE_CHARS are not drawn.
SAMPLE_ROWS = 600
SAMPLE_CHARS = 20_000
EPOCHS = 6
#: Small samples are gone over more often, up to this many steps.
STEPS = 6000
RATE = 2.0
#: Share of the right answers on calibration rows that the rejection may cost, and the share
#: of texts of random letters that it has no need to go beyond.
REJECTED = 0.001
NOISE = 0.99
_MIX = np.uint32(2654435761)


@dataclass(frozen=True)
class Model:
    """Languages, the score of each bucket for each language, and the calibration."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    sharpness: float
    threshold: float


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points below 0x30000 are letters; those above count as letters."""
    return np.array([chr(c).isalpha() for c in range(0x30000)])


def grams(text: str) -> np.ndarray:
    """Bucket of every character n-gram of a text, words with a space on either side."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(points, 0x2FFFF)]
    points = np.where(letter, points, np.uint32(32))
    found = []
    for n in ORDERS:
        size = points.size - n + 1
        value = np.full(size, n, np.uint32)
        inside = np.ones(size, bool)
        for k in range(n):
            value = (value ^ points[k : k + size]) * _MIX
            value ^= value >> np.uint32(15)
            if n == 1 or 0 < k < n - 1:
                inside &= letter[k : k + size]
        if n == 2:
            inside = letter[:size] | letter[1:]
        found.append(value[inside] & np.uint32(BUCKETS - 1))
    return np.concatenate(found)


def probabilities(sums: np.ndarray, sharpness: float) -> np.ndarray:
    z = sums * sharpness
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def _alphabet(texts: list[str]) -> np.ndarray:
    return np.array(sorted({c for t in texts for c in t.lower() if c.isalpha()}))


def _noise(text: str, alphabet: np.ndarray, rng: np.random.Generator) -> str:
    """A text with every letter drawn at random; what is no letter stays."""
    drawn = rng.choice(alphabet, len(text))
    return "".join(d if c.isalpha() else c for c, d in zip(text, drawn, strict=True))


def fit(texts: list[str], languages: list[str], seed: int = 7) -> Model:
    """Train by stochastic gradient descent, then calibrate on a fifth of the rows.

    Calibration sets the sharpness of the softmax and the score below which a text is
    rejected: the REJECTED quantile of the scores of right answers, or the NOISE quantile of
    the scores of the same texts in random letters where that is lower (so that a sample
    whose answers are all certain does not reject the nearly certain). Fewer than five rows
    calibrate on the rows they were fitted to.
    """
    names = tuple(sorted(set(languages)))
    rows = [(np.unique(grams(t), return_counts=True), names.index(x)) for t, x in zip(texts, languages, strict=True)]
    rows = [((u, (c / c.sum()).astype(np.float32)), y) for (u, c), y in rows if u.size]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = max(1, len(rows) // 5) if len(rows) > 4 else 0
    train, calibrate = order[held:], order[:held] if held else order
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weights = np.zeros((WIDTH, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    epochs = max(EPOCHS, STEPS // max(1, len(train)))
    done, steps = 0, max(1, epochs * len(train))
    for _ in range(epochs):
        for i in rng.permutation(train):
            (units, share), y = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ vectors[units]
            error = probabilities(hidden @ weights + bias, 1.0)
            error[y] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= np.float32(0.1 * rate) * error
            vectors[units] -= rate * share[:, None] * back
    table = vectors @ weights
    sums = np.array([rows[i][0][1] @ table[rows[i][0][0]] + bias for i in calibrate]).reshape(-1, len(names))
    truth = np.array([rows[i][1] for i in calibrate], int)
    sharpness = min(
        (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0),
        key=lambda s: -np.log(probabilities(sums, s)[np.arange(truth.size), truth] + 1e-9).mean() if truth.size else 0,
    )
    scores = probabilities(sums, sharpness)
    right = scores.max(axis=1)[scores.argmax(axis=1) == truth] if truth.size else np.array([])
    usable = [t for t in texts if grams(t).size]
    alphabet = _alphabet(usable)
    noise = [_noise(usable[i], alphabet, rng) for i in calibrate] if right.size else []
    by_chance = [
        probabilities(share @ table[units] + bias, sharpness).max()
        for units, share in ((u, c / c.sum()) for u, c in (np.unique(grams(t), return_counts=True) for t in noise))
    ]
    threshold = min(float(np.quantile(right, REJECTED)), float(np.quantile(by_chance, NOISE))) if right.size else 0.0
    return Model(names, table, bias, sharpness, threshold)


def judge(text: str | None, model: Model) -> tuple[str, float]:
    """The likeliest language of a whole text and its probability."""
    if not model.languages or not text:
        return UNKNOWN, 0.0
    units = grams(text)
    if not units.size:
        return UNKNOWN, 0.0
    total = np.zeros(len(model.languages))
    for i in range(0, units.size, 1 << 16):
        total += model.table[units[i : i + (1 << 16)]].sum(axis=0)
    p = probabilities(total / units.size + model.bias, model.sharpness)
    return model.languages[int(p.argmax())], float(p.max())


@tidy
def _judged(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1)):
        found = [judge(t, model) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([x for x, _ in found], pa.string()),
                pa.array([s for _, s in found], pa.float64()),
                pa.array([x == UNKNOWN or s < model.threshold for x, s in found]),
            ],
            ["doc_id", "lang_pred", "score", "rejected"],
        )


def train(docs: DataFrame, labelled: Column) -> Model:
    """Fit on a bounded sample of the rows of docs (doc_id, text, lang) where labelled holds.

    Each language gives about SAMPLE_ROWS rows or all it has, chosen by a hash of the id.
    The counts that set the shares cover all rows; a model without any row knows no
    language and predicts "und".
    """
    usable = (
        labelled
        & F.col("lang").isNotNull()
        & F.col("text").rlike("\\p{L}")
        & (F.length("text") <= SAMPLE_CHARS)
    )
    rows = docs.where(usable)
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    share = F.lit(0.0)
    for lang, n in counts:
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE_ROWS / n)).otherwise(share)
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20)
    sample = rows.where(chosen).select("doc_id", "text", "lang").collect()
    sample.sort(key=lambda r: (str(r.doc_id), r.text, r.lang))
    return fit([r.text for r in sample], [r.lang for r in sample])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected of each row of docs (doc_id, text, any others).

    lang_pred is a language of the model, or "und" where the text is null or has no
    letter; its score is the calibrated probability (0 for "und"). rejected marks "und" and
    scores below the model's threshold. Every row gives one row, repeated ones and those
    with a null doc_id too.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_judged, model=model), "doc_id long, lang_pred string, score double, rejected boolean"
    )


@tidy
def _accepted(batches: Iterable[pa.RecordBatch], model: Model, text: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, text)):
        found = [judge(t, model) for t in batch.column(text).cast(pa.string()).to_pylist()]
        yield batch.filter(pa.array([x != UNKNOWN and s >= model.threshold for x, s in found], pa.bool_()))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, whose language the model does not reject."""
    return docs.mapInArrow(partial(_accepted, model=model, text=docs.columns.index("text")), docs.schema)
