"""SentencePiece BPE encoding in vectorised merge rounds, and decoding.

A model file gives pieces with scores. A text is normalised and cut into words: runs of
characters whose neighbours stand side by side in some piece, so no merge can cross a cut.
All distinct words of a batch are merged together as flat numpy arrays. In each round
every word finds its least pair rank by a segmented minimum, merges its leftmost pair of
that rank, and the arrays are compacted. Where a merge cannot lead to a pair that goes
before it, all its places in the word, leftmost first and without overlap, are merged in the
same round: the order one by one would be the same. Words leave when no pair is left.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: The mark that stands for a space.
SPACE = "▁"
#: What an unknown id is decoded to.
UNKNOWN = " \u2047 "
#: Words that a task remembers with their ids; it forgets all when there are more.
REMEMBERED = 400_000
#: Longer words are not remembered.
LONG = 64
#: Symbols that are merged at once.
BATCH_SYMBOLS = 1 << 20
#: A word above so many symbols whose next merge has to go alone is merged by an agenda
#: instead: rounds of one merge each over a long word would take quadratic time.
AGENDA = 4096


class Pieces:
    """Vocabulary and merges of a BPE model file with byte fallback and plain normalisation."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = vocabulary.get_piece_size()
        names = [vocabulary.id_to_piece(i) for i in range(n)]
        self.byte = np.zeros(256, np.int64)
        special = {i for i in range(n) if vocabulary.is_control(i) or vocabulary.is_unknown(i)}
        self.control = {i for i in special if vocabulary.is_control(i)}
        self.shown = [UNKNOWN if vocabulary.is_unknown(i) else name for i, name in enumerate(names)]
        for i in range(n):
            if vocabulary.is_byte(i):
                self.byte[int(names[i][3:5], 16)] = i
                special.add(i)
            elif vocabulary.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
        plain = [i for i in range(n) if i not in special]
        self.check(vocabulary, bool(self.byte.all()))
        self.as_byte = {i: b for b, i in enumerate(self.byte.tolist())}
        # symbols are pieces, and characters of pieces that are no piece themselves
        self.symbol = {names[i]: i for i in plain}
        self.first_extra = n
        for c in sorted({c for i in plain for c in names[i]}):
            self.symbol.setdefault(c, n + len(self.symbol))
        scores = {i: vocabulary.get_score(i) for i in plain if len(names[i]) > 1}
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs, beside = {}, set()
        starts: dict[int, int] = {}  # the least rank of a merge that has a symbol in it
        for i in scores:
            name = names[i]
            beside.update(name[k : k + 2] for k in range(len(name) - 1))
            for k in range(1, len(name)):
                a, b = self.symbol.get(name[:k]), self.symbol.get(name[k:])
                if a is not None and b is not None:
                    pairs[a, b] = i
                    for part in (a, b):
                        starts[part] = min(starts.get(part, len(rank)), rank[scores[i]])
        self.none = len(rank)
        self.pairs = {pair: (rank[scores[i]], i) for pair, i in pairs.items()}
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        made = np.array(list(pairs.values()), np.int64)[order]
        self.keys, self.made = keys[order], made
        self.ranks = np.array([rank[scores[i]] for i in made.tolist()], np.int64)
        # a merge goes alone if its result is part of a merge that does not go after it
        self.alone = np.array([starts.get(i, self.none) <= rank[scores[i]] for i in made.tolist()])
        self.beside = np.array(sorted(ord(c) << 32 | ord(d) for c, d in beside), np.int64)
        self.of_char = np.full(0x110000, -1, np.int64)
        for name, i in self.symbol.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        self.extra = {i: ord(c) for c, i in self.symbol.items() if i >= n}
        self.known: dict[str, bytes] = {}
        inner = any(c != SPACE and d == SPACE for c, d in beside)
        self.words = re.compile(r"(?s).+" if inner else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    @staticmethod
    def check(vocabulary: sentencepiece.SentencePieceProcessor, bytes_known: bool) -> None:
        """Refuse models whose normalisation is not the plain one: spaces marked, one put first."""
        odd = " ﬁ Å\t　\n  x "
        wanted = (SPACE + odd).replace(" ", SPACE)
        if not bytes_known or vocabulary.normalize(odd) != wanted:
            raise ValueError("only models with byte fallback and plain normalisation are supported")

    # ---- words ----------------------------------------------------------------

    def normal(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        at = 0
        while at < len(words):
            size, end = 0, at
            while end < len(words) and (end == at or size + len(words[end]) <= BATCH_SYMBOLS):
                size += len(words[end])
                end += 1
            out += self.merge(words[at:end])
            at = end
        return out

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where in the list of merges each pair stands, -1 if it is none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), self.keys.size - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), at, -1)

    def merge(self, words: list[str]) -> list[bytes]:
        """All merges of all words at once, in rounds."""
        lengths = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(lengths.size), lengths)
        # characters that no piece has are kept as -2 - code point
        ids = self.of_char[chars]
        ids = np.where(ids < 0, -2 - chars, ids)
        # a word is cut wherever no piece has its neighbours side by side
        cut = np.ones(ids.size, bool)
        cut[1:] = (word[1:] != word[:-1]) | ~self.stand_together(chars[:-1], chars[1:])
        owner = np.cumsum(cut)
        at = np.arange(ids.size)
        done_ids, done_at = [], []
        pair = self.pair_ranks(ids, owner)
        while ids.size:
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, ids.size])
            rank = np.where(pair >= 0, self.ranks[pair], self.none)
            least = np.minimum.reduceat(rank, starts)
            out = least == self.none
            if out.any():
                over = np.repeat(out, sizes)
                done_ids.append(ids[over])
                done_at.append(at[over])
                ids, owner, at, pair = ids[~over], owner[~over], at[~over], pair[~over]
                continue
            chosen = self.leftmost(rank, np.repeat(least, sizes), pair, owner)
            slow = self.too_long(chosen, pair, starts, sizes)
            if slow.any():
                over = np.repeat(slow, sizes)
                for i in np.flatnonzero(slow).tolist():
                    part = slice(starts[i], starts[i] + sizes[i])
                    merged, kept = self.by_agenda(ids[part].tolist())
                    done_ids.append(np.array(merged, np.int64))
                    done_at.append(at[part][kept])
                ids, owner, at, pair = ids[~over], owner[~over], at[~over], pair[~over]
                continue
            ids[chosen] = self.made[pair[chosen]]
            keep = np.ones(ids.size, bool)
            keep[chosen + 1] = False
            ids, owner, at = ids[keep], owner[keep], at[keep]
            pair = self.pair_ranks(ids, owner)
        at = np.concatenate([np.zeros(0, np.int64), *done_at])
        order = np.argsort(at)
        ids = np.concatenate([np.zeros(0, np.int64), *done_ids])[order]
        ids, of = self.final(ids, word[at[order]])
        ends = 4 * np.cumsum(np.bincount(of, minlength=lengths.size))
        flat = ids.astype("<u4").tobytes()
        return [flat[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def stand_together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece has the two characters side by side."""
        wanted = left << 32 | right
        return self.beside[np.minimum(np.searchsorted(self.beside, wanted), self.beside.size - 1)] == wanted

    def pair_ranks(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """For each symbol the merge with the next one of its word, -1 for none."""
        pair = np.full(ids.size, -1, np.int64)
        if ids.size > 1:
            inside = owner[1:] == owner[:-1]
            pair[:-1][inside] = self.look_up(ids[:-1][inside], ids[1:][inside])
        return pair

    def leftmost(
        self,
        rank: np.ndarray,
        least: np.ndarray,
        pair: np.ndarray,
        owner: np.ndarray,
    ) -> np.ndarray:
        """Places to merge: the leftmost least pair of each word, and the others of the same
        merge where it need not go alone; of places that overlap every second one."""
        places = np.flatnonzero(rank == least)
        first = np.r_[True, owner[places[1:]] != owner[places[:-1]]]
        lead = np.repeat(pair[places[first]], np.diff(np.r_[np.flatnonzero(first), places.size]))
        places = places[first | ((pair[places] == lead) & ~self.alone[pair[places]])]
        near = np.r_[False, (places[1:] == places[:-1] + 1) & (owner[places[1:]] == owner[places[:-1]])]
        run = np.arange(places.size) - np.maximum.accumulate(np.where(near, 0, np.arange(places.size)))
        return places[run % 2 == 0]

    def too_long(
        self, chosen: np.ndarray, pair: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """Words above AGENDA symbols whose next merge goes alone."""
        slow = np.zeros(starts.size, bool)
        if sizes.max() > AGENDA:
            word = np.searchsorted(starts, chosen, "right") - 1
            slow[word[self.alone[pair[chosen]]]] = True
            slow &= sizes > AGENDA
        return slow

    def by_agenda(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """The same merges one by one, from a heap of pairs; the symbols left and their places."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and (found := self.pairs.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            push(i)
        gone = bytearray(n)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if gone[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i] = made
            gone[j] = 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        kept = [i for i in range(n) if not gone[i]]
        return [ids[i] for i in kept], kept

    def final(self, ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids, with their words: characters that are no piece become their bytes."""
        odd = np.flatnonzero((ids < 0) | (ids >= self.first_extra))
        if not odd.size:
            return ids, of
        codes = np.array([self.extra[i] if i >= 0 else -2 - i for i in ids[odd].tolist()], np.int64)
        width = np.ones(ids.size, np.int64)
        width[odd] = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        spread = np.repeat(ids, width)
        data = np.frombuffer("".join(map(chr, codes.tolist())).encode(), np.uint8)
        spread[np.repeat(np.isin(np.arange(ids.size), odd), width)] = self.byte[data]
        return spread, np.repeat(of, width)

    # ---- texts ----------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; words are merged once for all texts."""
        words = [self.words.findall(self.normal(t)) for t in texts]
        known = self.known
        new = list({w for ws in words for w in ws if w not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({w for ws in words for w in ws})
        known.update(zip(new, self.encode_words(new), strict=True))
        out = [b"".join(map(known.__getitem__, ws)) for ws in words]
        for word in new:
            if len(word) > LONG:
                del known[word]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that stand together are read as UTF-8, marks become spaces,
        the one put first goes. What is no UTF-8 becomes U+FFFD, unknown ids UNKNOWN, control ids nothing."""
        out: list[str] = []
        waiting = bytearray()
        first = True
        for i in ids.tolist():
            if i in self.control:
                continue
            if i in self.as_byte:
                waiting.append(self.as_byte[i])
                first = False
                continue
            if waiting:
                out.append(self.read(bytes(waiting)))
                waiting.clear()
            name = self.shown[i]
            out.append(name[1:] if first and name[:1] == SPACE else name)
            first = False
        out.append(self.read(bytes(waiting)))
        return "".join(out).replace(SPACE, " ")

    @staticmethod
    def read(data: bytes) -> str:
        """UTF-8 text; every byte that is part of no character gives a mark of its own."""
        try:
            return data.decode()
        except UnicodeDecodeError:
            kept = data.decode("utf-8", "surrogateescape")
            return "".join("�" if "\udc80" <= c <= "\udcff" else c for c in kept)


@lru_cache(2)
def _loaded(model: bytes) -> Pieces:
    return Pieces(model)


def _encoded(batches: Iterable[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    coder = _loaded(model)
    for batch in batches:
        for part in slices(batch, 1):
            ids = coder.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )


def _decoded(batches: Iterable[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    coder = _loaded(model)
    for batch in batches:
        for part in slices(batch, 2):
            ids = [np.frombuffer(x or b"", "<u4") for x in part.column(2).to_pylist()]
            decimal = [",".join(map(str, x.tolist())).encode() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3],
                    pa.array([coder.decode(x) for x in ids], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decimal], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256"],
            )


def read_model(path: str) -> bytes:
    """The model file, read once on the driver: half a MB that goes with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) of each row of docs.

    docs has doc_id and text; other columns are not read. A null text is empty and has no
    tokens; rows that repeat are encoded as often; a null doc_id stays null. No begin or
    end ids are added.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model = read_model(path)
    return rows.mapInArrow(partial(_encoded, model=model), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of encode(), their decoded text, and the digest of the ids as decimals
    joined by commas."""
    model = read_model(path)
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        partial(_decoded, model=model),
        "doc_id long, n_tokens long, ids binary, decoded string, ids_sha256 string",
    )
