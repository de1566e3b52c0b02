"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

The tokenizer file gives the vocabulary and the ordered merges. Text is normalised and cut
into pieces; the merges never cross a piece. Within a piece symbols stream in. After each
symbol the last token of the encoding so far is known: it is the suffix that forms a valid
pair with the last token of the encoding before it. A later symbol can only build on one of
the last `lookahead` positions (the longest token, in symbols, that the merge list makes),
so a token through which the encodings at all these positions pass is stable and leaves.
The state is the encodings at those positions, however long the piece is. A piece that fits
the lookahead ends before anything has to leave, so its merges run on it at once.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, tidy

#: Entries of each generation of a task's cache.
CACHE = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = [chr(b) if b in plain else "" for b in range(256)]
    spare = iter(range(256, 512))
    return [x or chr(next(spare)) for x in letters]


class Generations(dict):
    """A cache of two generations: filling the young one drops what the old one still holds."""

    def __init__(self, make, size: int = CACHE):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def empty(self) -> None:
        self.old = {}
        self.clear()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Transducer:
    """Encoder and decoder of a BPE tokenizer file whose merges work on byte letters."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.named = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)].__getitem__
        self.merges = {
            (self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(model["merges"])
        }
        self.made = [self.ids[a + b] for a, b in model["merges"]]
        self.letters = byte_letters()
        self.marks = np.array(sorted(self.special.values()), "<u4")
        self.spoken = self._bytes_of_tokens().__getitem__
        self.lookahead = max(self.symbols(t) for t in self.ids)
        steps = spec["normalizer"]["normalizers"] if spec.get("normalizer") else []
        self.composes = any(s["type"] == "NFC" for s in steps)
        self.lowers = any(s["type"] == "Lowercase" for s in steps)
        split = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        # white space is only ever left out of pieces, so it needs no normalising
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.valid = lru_cache(1 << 16)(self._valid)
        self.of_piece = Generations(lambda p: array("I", self.encode_piece(p)).tobytes())

    def _bytes_of_tokens(self) -> list[bytes]:
        """What each id adds to the running text; nothing for special tokens and gaps."""
        values = {x: b for b, x in enumerate(self.letters)}
        out = [b""] * (max(self.tokens) + 1)
        for token, i in self.ids.items():
            if token not in self.special:
                body = token.removesuffix(self.suffix) if self.suffix else token
                out[i] = bytes(values[x] for x in body) + b" " * (body != token)
        return out

    def symbols(self, token: str) -> int:
        return len(token.removesuffix(self.suffix)) if self.suffix else len(token)

    def normal(self, text: str) -> str:
        if self.composes and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lowers:  # letter by letter: a final sigma is lowered like any other
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return text

    def merged(self, ids: list[int]) -> list[int]:
        """Apply the merges to symbols, first in the list first, left to right."""
        rank, new, none = self.merges.get, self.made, len(self.made)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i : i + 2] = [new[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return ids

    def start(self, piece: str) -> list[str]:
        letters = [self.letters[b] for b in piece.encode("utf-8")]
        letters[-1] += self.suffix
        return letters

    def encode_piece(self, piece: str) -> list[int]:
        letters = self.start(piece)
        if len(letters) <= 2 * self.lookahead:
            return self.merged([self.ids[x] for x in letters])
        return list(self.stream(letters))

    def _valid(self, a: int, b: int) -> bool:
        """Whether the merges leave a|b as it is: then b may follow a in an encoding."""
        whole = self._split(self.tokens[a]) + self._split(self.tokens[b])
        return self.merged(whole) == [a, b]

    def _split(self, token: str) -> list[int]:
        body = token.removesuffix(self.suffix) if self.suffix else token
        letters = list(body)
        if body != token:
            letters[-1] += self.suffix
        return [self.ids[x] for x in letters]

    def stream(self, letters: Iterable[str]) -> Iterator[int]:
        """Token ids of a piece of any length, each as soon as it is stable."""
        # a node is [token, node before it]; the stem is the last token that has left
        stem: list = [None, None]
        live = [stem]  # the encodings that end at the last positions
        recent: list[str] = []
        for letter in letters:
            recent.append(letter)
            del recent[: -self.lookahead]
            text = ""
            for back in range(1, min(len(recent), len(live)) + 1):
                text = recent[-back] + text
                token, before = self.ids.get(text), live[-back]
                if token is not None and (before[0] is None or self.valid(before[0], token)):
                    live.append([token, before])
                    break
            if len(live) > self.lookahead:
                del live[0]
                yield from self._leave(self._common(live), stem)
                stem = self._common(live)
                stem[1] = None
        yield from self._leave(live[-1], stem)

    @staticmethod
    def _leave(node: list, stem: list) -> list[int]:
        """Tokens after the stem up to the node."""
        out = []
        while node is not stem:
            out.append(node[0])
            node = node[1]
        return out[::-1]

    @staticmethod
    def _common(live: list[list]) -> list:
        """The last node through which every live encoding passes."""
        passes: dict[int, int] = {}
        for node in live:
            while node is not None:
                passes[id(node)] = passes.get(id(node), 0) + 1
                node = node[1]
        node = live[-1]
        while passes[id(node)] < len(live):
            node = node[1]
        return node

    def _plain(self, text: str) -> bytes:
        of = self.of_piece
        return b"".join([of[p] for p in self.pieces.findall(self.normal(text))])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit."""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out.append(self._plain(text[at : found.start()]))
            out.append(np.array([self.special[found[0]]], "<u4").tobytes())
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def joined(self, ids: np.ndarray) -> str:
        """The tokens with a space between, as a tokenizer file without a decoder gives them."""
        return " ".join(map(self.named, ids.tolist()))

    def readable(self, ids: np.ndarray, block: int = 1 << 14) -> Iterator[str]:
        """Running text of a token stream, a block of tokens at a time.

        Tokens give bytes, a word end gives a space, and an incremental decoder turns the
        bytes into text: those that end inside a character wait for the next block. Bytes
        that are no UTF-8 become U+FFFD. A special token ends a character that is open.
        """
        state = codecs.getincrementaldecoder("utf-8")("replace")
        marks = np.flatnonzero(np.isin(ids, self.marks)).tolist()
        start = 0
        for mark in [*marks, ids.size]:
            for at in range(start, mark, block):
                yield state.decode(b"".join(map(self.spoken, ids[at : min(at + block, mark)].tolist())))
            yield state.decode(b"", final=True)
            state.reset()
            if mark < ids.size:
                yield self.named(int(ids[mark]))
            start = mark + 1


@lru_cache(2)
def _loaded(spec: str) -> Transducer:
    return Transducer(spec)


@tidy
def _encoded(batches: Iterable[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    coder = _loaded(spec)
    try:
        for batch in batches:
            for part in slices(batch, 1):
                ids = [coder.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )
    finally:  # the worker goes on to other stages, which do not need the pieces
        coder.of_piece.empty()


@tidy
def _decoded(batches: Iterable[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    coder = _loaded(spec)
    for batch in batches:
        for part in slices(batch, 2, size=1 << 20):
            ids = [np.frombuffer(x or b"", "<u4") for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3],
                    pa.array([coder.joined(x) for x in ids], pa.string()),
                    pa.array(["".join(coder.readable(x)) for x in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded", "readable"],
            )


def read_spec(path: str) -> str:
    """The tokenizer file, read once on the driver; a few MB that go with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) of each row of docs.

    docs has doc_id and text; other columns are not read. A null text is empty and has no
    tokens; rows that repeat are encoded as often; a null doc_id stays null. Strings of
    special tokens in a text become their ids.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        partial(_encoded, spec=read_spec(path)), "doc_id long, n_tokens long, ids binary"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of encode() with two texts of their ids.

    decoded is what the tokenizer file's own decoder gives (here it has none: tokens with a
    space between); readable is running text from the bytes of the tokens. Null ids give
    empty texts.
    """
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        partial(_decoded, spec=read_spec(path)),
        "doc_id long, n_tokens long, ids binary, decoded string, readable string",
    )
