"""Repeated passages: recompression names, then exact windows where names are shared.

A round of recompression names runs of equal symbols, then pairs whose left symbol is in
one half of the alphabet and whose right symbol is in the other. A name is a digest of what
it stands for, so equal parts get equal names in every document without a dictionary that
grows with the corpus. Two rounds leave symbols of up to eight words. Equal passages of
WINDOW words have the same symbols except near their ends: each round can disturb at most
the run at the end and its neighbour. Runs of three words and more, and runs of named
symbols, get a key of their own; without such a run the disturbed part is GUARD words at
most. Symbols are put together to stems of at least STEM words, and a window is known by
its smallest undisturbed stem. Windows whose stem or run occurs in two different texts are
then compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, tidy, written

WINDOW = 50
GUARD = 12
STEM = 6
#: Words of several documents that are worked on together.
TOGETHER = 1 << 16
_NONE = np.uint64(2**64 - 1)
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: What decides, in each round, the half of the alphabet a symbol is in.
_SIDES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: Odd bases of the two window digests, and their inverses modulo 2**64.
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Parsed:
    """Words of some documents, their symbols after two rounds, and the keys of windows."""

    def __init__(self, documents: list[list[bytes]]):
        self.sizes = np.array([len(d) for d in documents], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        n = int(self.first[-1])
        digest = xxhash.xxh3_64_intdigest
        self.words = np.fromiter((digest(w) for d in documents for w in d), np.uint64, n)
        self.doc = np.repeat(np.arange(len(documents)), self.sizes)
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        symbols, starts = self.words, np.arange(n)
        for level in (0, 1):
            symbols, starts = self._round(symbols, starts, level)
        self.symbols, self.starts = symbols, starts
        self.valid = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.uint64)
        if n >= WINDOW:
            at = np.arange(n - WINDOW + 1)
            self.valid = at[self.doc[at] == self.doc[at + WINDOW - 1]]
            if self.valid.size:
                self.keys = self._stems()

    def _round(self, symbols: np.ndarray, starts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        if not symbols.size:
            return symbols, starts
        doc = self.doc[starts]
        new = np.ones(symbols.size, bool)
        new[1:] = (symbols[1:] != symbols[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, symbols.size))
        name, starts, doc = symbols[head], starts[head], doc[head]
        ends = np.append(starts[1:], self.words.size)
        several = count > 1
        long = several & (ends - starts >= 3)
        self.runs.append((mix(name[long] ^ _SEEDS[level]), starts[long], ends[long]))
        name = name.copy()
        name[several] = mix(name[several] + count[several].astype(np.uint64) * _SEEDS[0])
        left = (mix(name + _SIDES[level]) >> np.uint64(17)) & np.uint64(1) == 1
        pair = np.flatnonzero(left[:-1] & ~left[1:] & (doc[:-1] == doc[1:]))
        name[pair] = mix(name[pair] * np.uint64(3) + mix(name[pair + 1] + _SEEDS[1]))
        stays = np.ones(name.size, bool)
        stays[pair + 1] = False
        return name[stays], starts[stays]

    def _stems(self) -> np.ndarray:
        """For each window the smallest stem between its guards."""
        n, count = self.words.size, self.starts.size
        ends = np.append(self.starts[1:], n)
        # symbols from i up to the first whose end is STEM words on make the stem of i
        last = np.searchsorted(ends, self.starts + STEM)
        inside = last < count
        last = np.minimum(last, count - 1)
        inside &= self.doc[self.starts] == self.doc[self.starts[last]]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.symbols) * self._powers(count, 0)[0])])
        stem = mix((sums[last + 1] - sums[np.arange(count)]) * self._powers(count, 0)[1])
        stem = np.where(inside, stem & ~np.uint64(1), _NONE)
        stem_ends = np.where(inside, ends[last], n + WINDOW)
        stem_ends = np.minimum.accumulate(stem_ends[::-1])[::-1]
        low = np.searchsorted(self.starts, self.valid + GUARD)
        high = np.searchsorted(stem_ends, self.valid + WINDOW - GUARD, side="right")
        span = np.maximum(high - low, 0)  # none where a long run fills the window
        tables, size = [stem], 1
        while 2 * size <= span.max(initial=0):
            tables.append(np.minimum(tables[-1][:-size], tables[-1][size:]))
            size *= 2
        keys = np.full(self.valid.size, _NONE)
        for k, table in enumerate(tables):
            here = (span >> k) == 1
            keys[here] = np.minimum(table[low[here]], table[high[here] - (1 << k)])
        return keys

    @staticmethod
    def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
        base = _BASES[which]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, np.uint64(b))
            steps[:1] = 1
            out.append(np.cumprod(steps))
        return out[0], out[1]

    def window_digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of the WINDOW words from each position: a long and an int."""
        out = []
        for which in (0, 1):
            powers, inverse = self._powers(self.words.size, which)
            terms = mix(self.words + _SEEDS[which]) * powers
            sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
            out.append(mix((sums[at + WINDOW] - sums[at]) * inverse[at]))
        return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def all_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Document (its place) and key, each pair once."""
        change = np.ones(self.keys.size, bool)
        doc = self.doc[self.valid] if self.valid.size else np.zeros(0, np.int64)
        change[1:] = (self.keys[1:] != self.keys[:-1]) | (doc[1:] != doc[:-1])
        docs = np.concatenate([doc[change], *(self.doc[s] for _, s, _ in self.runs)])
        keys = np.concatenate([self.keys[change], *(k for k, _, _ in self.runs)])
        enough = (self.sizes[docs] >= WINDOW) & (keys != _NONE)
        both = np.unique(np.rec.fromarrays([docs[enough], keys[enough]], names="doc,key"))
        return both["doc"], both["key"]

    def candidates(self, shared: list[list[int]]) -> np.ndarray:
        """Starts of the windows that have a key shared by their document."""
        wanted = np.array([k for ks in shared for k in ks], np.int64).view(np.uint64)
        owner = np.repeat(np.arange(len(shared), dtype=np.uint64), [len(ks) for ks in shared])
        tagged = lambda keys, docs: keys ^ mix(docs.astype(np.uint64) + _SEEDS[0])
        wanted = tagged(wanted, owner)
        if not self.valid.size:
            return self.valid
        chosen = np.isin(tagged(self.keys, self.doc[self.valid]), wanted)
        cover = np.zeros(self.words.size + WINDOW + 1, np.int64)
        for keys, starts, ends in self.runs:
            here = np.isin(tagged(keys, self.doc[starts]), wanted)
            np.add.at(cover, np.maximum(starts[here] - WINDOW + 2, 0), 1)
            np.add.at(cover, ends[here] - 1, -1)
        return self.valid[chosen | (np.cumsum(cover)[self.valid] > 0)]


def _groups(columns: list[list], place: int) -> Iterator[list[list]]:
    """Slices of columns whose texts (words in column `place`) have TOGETHER words or so."""
    start, size = 0, 0
    for i, words in enumerate(columns[place]):
        size += len(words)
        if size >= TOGETHER:
            yield [c[start : i + 1] for c in columns]
            start, size = i + 1, 0
    if start < len(columns[place]):
        yield [c[start:] for c in columns]


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[list[list]]:
    """Columns of rows, the second one split into words, a few rows at a time."""
    for batch in batches:
        for part in slices(batch, 1, size=1 << 20):
            columns = [c.to_pylist() for c in part.columns]
            columns[1] = [_words(t) for t in columns[1]]
            yield from _groups(columns, 1)


@tidy
def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, words, prints in _pieces(batches):
        docs, keys = Parsed(words).all_keys()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)),
                pa.array(np.array(ids, np.int64)[docs]),
                pa.array(np.array(prints, np.int64)[docs]),
            ],
            ["key", "doc_id", "print"],
        )


@tidy
def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, words, prints, shared in _pieces(batches):
        parsed = Parsed(words)
        at = parsed.candidates(shared)
        doc = parsed.doc[at] if at.size else at
        high, low = parsed.window_digests(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(high),
                pa.array(low),
                pa.array(np.array(ids, np.int64)[doc]),
                pa.array(np.array(prints, np.int64)[doc]),
                pa.array((at - parsed.first[doc]).astype(np.int32)),
            ],
            ["high", "low", "doc_id", "print", "start"],
        )


def kept_words(words: list[bytes], starts: list[int] | None, copy: bool) -> list[bytes]:
    """The words that no window from `starts` covers; none of a copy of WINDOW words or more."""
    if copy and len(words) >= WINDOW:
        return []
    if not starts:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.array(starts) + WINDOW, -1)
    keep = np.cumsum(cover)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


@tidy
def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, words, starts, copies in _pieces(batches):
        left = [kept_words(w, s, bool(c)) for w, s, c in zip(words, starts, copies, strict=True)]
        n = [len(w) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array([a - len(b) for a, b in zip(n, left, strict=True)], pa.int64()),
                pa.array([b" ".join(b).decode("utf-8") for b in left], pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, print, starts, copy: what to remove, for documents that lose something.

    print is xxhash64 of the text and tells rows of one doc_id apart. starts are the
    windows that also start in a document with a smaller doc_id. copy marks a text that a
    smaller doc_id has as a whole: all its windows repeat, so they are not listed.
    """
    base = docs.select("doc_id", "print", "text")
    whole = base.where("doc_id is not null and text is not null").select("doc_id", "print", F.md5("text").alias("whole"))
    firsts = whole.groupBy("whole").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    copies = written(
        whole.join(firsts.where("first_id < last_id"), "whole")
        .where("doc_id > first_id")
        .select("doc_id", "print")
        .distinct(),
        "copies",
    )
    keys = base.where("doc_id is not null and text is not null").select("doc_id", "text", "print").mapInArrow(
        _keys, "key long, doc_id long, print long"
    )
    shared = keys.groupBy("key").agg(F.min("print").alias("least"), F.max("print").alias("most"))
    marks = written(
        keys.join(shared.where("least < most").select("key"), "key")
        .groupBy("doc_id", "print")
        .agg(F.collect_list("key").alias("shared"))
        .join(copies, ["doc_id", "print"], "left_anti"),
        "marks",
    )
    windows = (
        base.join(marks, ["doc_id", "print"])
        .select("doc_id", "text", "print", "shared")
        .mapInArrow(_windows, "high long, low int, doc_id long, print long, start int")
    )
    least = windows.groupBy("high", "low").agg(F.min("doc_id").alias("least"))
    found = (
        windows.join(least, ["high", "low"])
        .where("doc_id > least")
        .groupBy("doc_id", "print")
        .agg(F.collect_set("start").alias("starts"))
    )
    return found.select("doc_id", "print", "starts", F.lit(False).alias("copy")).union(
        copies.select("doc_id", "print", F.lit(None).cast("array<int>"), F.lit(True))
    )


def _rows(docs: DataFrame) -> DataFrame:
    # columns that have their type already stay as they are: an alias would keep the plans of
    # equal joins apart, and with them their shuffles
    kinds = dict(docs.dtypes)
    doc_id = F.col("doc_id") if kinds["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    text = F.col("text") if kinds["text"] == "string" else F.col("text").cast("string").alias("text")
    return docs.select(doc_id, F.xxhash64(text).alias("print"), text)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) of each row of docs (doc_id, text, others).

    A word goes if a window of WINDOW words that covers it also starts in a document with
    a smaller doc_id, judged on the input. Null texts have no words. Documents under WINDOW
    words lose nothing. Rows of one doc_id do not remove each other; a row with a null
    doc_id loses nothing and removes nothing.
    """
    base = _rows(docs)
    # repeats() joins the same rows in the same way, so texts are shuffled once for both
    known = base.where("doc_id is not null")
    nameless = base.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("starts"), F.lit(None).cast("boolean").alias("copy")
    )
    return (
        known.join(repeats(known), ["doc_id", "print"], "left")
        .select("doc_id", "text", "starts", "copy")
        .union(nameless)
        .mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
    )


def cut_repeats(docs: DataFrame) -> DataFrame:
    """docs, all columns, with the kept words as text where remove_repeats() takes some.

    Texts that lose nothing stay as they are, white space included; documents that lose
    all words stay with an empty text. n_chars, if there, follows the new text.
    """
    base = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("print"),
    )
    found = repeats(_rows(docs))
    columns = [c for c in docs.columns if c not in ("text", "n_chars")]
    joined = base.join(found, ["doc_id", "print"], "left").select("row.text", "starts", "copy", "row")
    schema = "row " + docs.select(F.struct(*docs.columns).alias("row")).schema["row"].dataType.simpleString()
    cut = joined.mapInArrow(_cut, f"{schema}, kept string, changed boolean")
    changed = F.col("changed")
    new = {c: F.col(f"row.{c}") for c in columns}
    new["text"] = F.when(changed, F.col("kept")).otherwise(F.col("row.text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    return cut.select(*[new[c].alias(c) for c in docs.columns])


@tidy
def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 0, size=1 << 20):
            texts, starts, copies, rows = part.columns
            kept: list[str | None] = []
            for text, s, c in zip(texts.to_pylist(), starts.to_pylist(), copies.to_pylist(), strict=True):
                words = _words(text)
                left = kept_words(words, s, bool(c)) if s or c else words
                kept.append(b" ".join(left).decode("utf-8") if len(left) < len(words) else None)
            changed = pa.array([k is not None for k in kept])
            yield pa.RecordBatch.from_arrays([rows, pa.array(kept, pa.string()), changed], ["row", "kept", "changed"])


#: The same rows from every window as a text of its own, for tables whose doc_id is unique.
SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
    FROM (
        SELECT doc_id, list_filter(
            string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''
        ) AS w FROM documents
    )
), windows AS (
    SELECT doc_id, pos, word,
        string_agg(word, ' ') OVER fifty AS passage, count(*) OVER fifty AS n
    FROM words
    WINDOW fifty AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), firsts AS (
    SELECT passage, min(doc_id) AS first_id FROM windows WHERE n = 50 GROUP BY passage
), judged AS (
    SELECT a.doc_id, a.pos, a.word, coalesce(a.n = 50 AND f.first_id < a.doc_id, false) AS repeats
    FROM windows a LEFT JOIN firsts f ON a.passage = f.passage
), covered AS (
    SELECT doc_id, pos, word, bool_or(repeats) OVER (
        PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW
    ) AS gone
    FROM judged
), kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
    FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
    sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
