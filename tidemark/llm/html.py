"""Main text of web pages: blocks of the page, less furniture and lines that repeat.

A page is cut into blocks. Every page is compared with the page whose URL is nearest (same
host, path that agrees longest) by a longest common subsequence of their blocks. What both
have is furniture: outside articles each common line, inside an article each kind of box
(an element with a class) of which both pages have the same lines and no others. Lines
that stand in an article by themselves are never deleted, because texts that copy each
other share them; they count when most of a page is in its neighbour, which then is a copy
and tells nothing.

What differencing leaves is checked by the markup: blocks of menus, headers, footers, forms
and the like go by their element or class, unless they hold the article, and where a page
has an article only its blocks are text.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape
from os.path import commonprefix
from pickle import dumps, loads
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, tasks, tidy, written
from tidemark.llm.urls import host_of, path_of

# fixed values: elements by their role
_RAW = frozenset("script style noscript template iframe object svg math select textarea title".split())
_EMPTY = frozenset("svg math".split())  # of these, <svg .../> is closed in itself
_FURNITURE = frozenset("nav footer aside form button menu dialog header".split())
_CONTENT = frozenset("article main".split())
_HOLDERS = _FURNITURE | _CONTENT | frozenset("div section ul ol table figure fieldset details center".split())
_BLOCKS = _HOLDERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li tr td th dl dt dd blockquote pre hr body html address caption figcaption summary".split()
)
# words of a class or id that mark furniture
_MARKS = frozenset(
    "ad ads adv advert advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent notice "
    "gdpr newsletter subscribe subscription signup sidebar comment comments disqus share sharing social related "
    "recommended breadcrumb breadcrumbs menu nav navbar navigation footer header masthead popup modal overlay widget "
    "pagination pager toolbar login".split()
)
# words by which a class tells what a frame has or how it looks, not what it is
_STATES = frozenset("no not with without has have is layout page open opened closed visible hidden fixed enabled disabled".split())
#: Share of a page's undecided characters beyond which a neighbour that has them is a copy.
COPY = 0.9
#: The same for the characters of an article.
ARTICLE_COPY = 0.5
#: Cells of a table of two pages' lines that is held whole.
TABLE = 1 << 22
_OPEN = re.compile(r"<(?:(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)|(?P<comment>!--)|[!?])", re.IGNORECASE)
#: The rest of a tag; tried on NEAR characters first, which nearly all tags end in.
_REST = re.compile(r"(?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+>")
NEAR = 512
_CLASS = re.compile(r"\bclass\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class Line:
    """One block: its text, whether it is furniture, whether an article holds it, and the
    kind of box (element and class) that holds it there, empty for the article itself."""

    text: str
    furniture: bool
    inside: bool
    box: str = ""


@dataclass
class Holder:
    """An open element: its name, whether it or one above is furniture by element, whether
    an article or main element holds it, whether an article does; its own mark (by class, id
    or role, or a form) and the holder around it."""

    name: str
    furniture: bool
    inside: bool
    article: bool
    marked: bool
    above: Holder | None
    box: str = ""  # element and class; empty without a class and for what holds a headline
    framed: bool = False  # holds a main element or the outermost article
    covered: bool = False  # known when the page has been read


class _Places:
    """Where marks are in a page: each kind is searched once, then looked up."""

    def __init__(self, page: str):
        self.page = page
        self.found: dict[str, array] = {}
        #: Opening quotes from which no > outside quotes can be reached.
        self.dead: set[int] = set()

    def next(self, mark: str, at: int) -> int:
        """First place of a mark from `at` on, -1 if there is none."""
        if mark not in self.found:
            self.found[mark] = array("q", (m.start() for m in re.finditer(re.escape(mark), self.page)))
        places = self.found[mark]
        i = bisect_left(places, at)
        return places[i] if i < len(places) else -1

    def close(self, at: int) -> int:
        """Place of the > that closes a tag from `at` on, past quoted values; -1 if none does."""
        if near := _REST.match(self.page, at, at + NEAR):
            return near.end() - 1
        passed = []
        while True:
            stop = self.next(">", at)
            quotes = [(q, c) for c in "\"'" if 0 <= (q := self.next(c, at)) < stop]
            if stop < 0 or not quotes:
                break
            quote, kind = min(quotes)
            passed.append(quote)
            ends = -1 if quote in self.dead else self.next(kind, quote + 1)
            if ends < 0:
                stop = -1
                break
            at = ends + 1
        if stop < 0:
            self.dead.update(passed)
        return stop


class _Ends:
    """The end tags of raw elements in order of their place, found when first asked for."""

    def __init__(self, page: str):
        self.page = page
        self.places: dict[str, Iterator[re.Match]] = {}
        self.held: dict[str, re.Match | None] = {}

    def after(self, name: str, at: int) -> int:
        """Where the first </name> that starts at or after `at` ends; the page's end if none."""
        if name not in self.places:
            self.places[name] = re.finditer(rf"</{name}\s*>", self.page, re.IGNORECASE)
            self.held[name] = next(self.places[name], None)
        while (found := self.held[name]) is not None and found.start() < at:
            self.held[name] = next(self.places[name], None)
        return len(self.page) if found is None else found.end()


class Tag(NamedTuple):
    """A tag that the reader acts upon: its place, name (empty for what is only skipped)."""

    start: int
    stop: int
    name: str = ""
    end: bool = False
    rest: str = ""


def tags(page: str) -> Iterator[Tag]:
    """The tags of a page in order; comments and raw elements are one tag without a name.

    A tag ends at the first > outside quotes; where a quote stays open, or nothing closes the
    tag, its < is text. The scan goes forward only.
    """
    places, ends = _Places(page), _Ends(page)
    at = 0
    while (found := _OPEN.search(page, at)) is not None:
        start, at = found.start(), found.end()
        name = (found["name"] or "").lower()
        if found["comment"]:
            stop = places.next("-->", at)
            at = len(page) if stop < 0 else stop + 3
            yield Tag(start, at)
        elif not name:
            stop = places.next(">", at)
            if stop >= 0:
                at = stop + 1
                yield Tag(start, at)
        else:
            stop = places.close(at)
            raw = name in _RAW and not found["end"]
            if raw and not (name in _EMPTY and stop > 0 and page[stop - 1] == "/"):
                # whatever its quotes, a raw element ends with its end tag
                first = places.next(">", at)
                if first >= 0:
                    at = ends.after(name, first + 1)
                    yield Tag(start, at)
            elif stop >= 0:
                yield Tag(start, stop + 1, "" if raw else name, bool(found["end"]), page[at:stop])
                at = stop + 1


def _marked(rest: str, inside: bool) -> bool:
    """Whether a class, id or role names furniture, as site-ad does and has-header does not.
    Inside an article a header is part of it."""
    for found in _MARKED.findall(rest):
        for token in found.lower().strip("\"'").split():
            words = set(_WORD.findall(token))
            if words.isdisjoint(_STATES) and (words & _MARKS) - ({"header"} if inside else set()):
                return True
    return False


def _box(name: str, rest: str) -> str:
    """The kind of an element: its name and classes, empty without a class."""
    found = _CLASS.search(rest)
    kind = " ".join(found[1].strip("\"'").split()) if found else ""
    return f"{name} {kind}" if kind else ""


def lines(page: str) -> list[Line]:
    """The blocks of a page in order, white space made single, references decoded.

    A mark or a form that turns out to hold the outermost article or a main element is the
    frame of the page and counts for nothing; inside an article marks cover its parts. Marks
    that leave nothing of a page count for nothing either.
    """
    out: list[tuple[str, Holder | None]] = []
    parts: list[str] = []
    stack: list[Holder] = []
    holders: list[Holder] = []
    opened: dict[str, int] = {}

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, stack[-1] if stack else None))

    at = 0
    for tag in tags(page):
        if tag.start > at:
            parts.append(page[at : tag.start])
        at = tag.stop
        name = tag.name
        if name == "br":
            parts.append(" ")
        elif name in _BLOCKS:
            flush()
            if name in _HOLDERS:
                if tag.end:
                    if opened.get(name):
                        while stack:
                            last = stack.pop()
                            opened[last.name] -= 1
                            if last.name == name:
                                break
                else:
                    above = stack[-1] if stack else None
                    furniture, inside, article = (above.furniture, above.inside, above.article) if above else (False, False, False)
                    own = name in _FURNITURE - {"form"} and not (name == "header" and inside)
                    marked = name == "form" or _marked(tag.rest, inside)
                    if name in _CONTENT and not article:
                        marked = False
                        # those below the last one cleared were cleared with it
                        for holder in reversed(stack):
                            if holder.framed:
                                break
                            holder.marked, holder.framed = False, True
                    box = _box(name, tag.rest) if inside and name not in _CONTENT else ""
                    holders.append(
                        Holder(name, furniture or own, inside or name in _CONTENT, article or name == "article", marked, above, box)
                    )
                    stack.append(holders[-1])
                    opened[name] = opened.get(name, 0) + 1
            elif name == "h1" and stack:
                stack[-1].box = ""
    parts.append(page[at:])
    flush()
    for x in holders:
        x.covered = x.furniture or x.marked or (x.above is not None and x.above.covered)
    by_mark = any(x is None or not x.covered for _, x in out)
    return [
        Line(text, x.covered if by_mark else x.furniture, x.inside, x.box) if x else Line(text, False, False) for text, x in out
    ]


def candidates(page: list[Line]) -> list[int]:
    """Places of the lines that the markup does not take for furniture: the article's;
    without an article those that only a neighbour can tell to be furniture."""
    left = [i for i, x in enumerate(page) if not x.furniture]
    return [i for i in left if page[i].inside] or left


def main_text(page: list[Line], deleted: Iterable[int] = ()) -> str:
    """The candidates less those that were deleted, by their number among the candidates."""
    gone = set(deleted)
    return "\n".join(page[i].text for k, i in enumerate(candidates(page)) if k not in gone)


def _growth(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each value of x: the longest lengths with all starts of y, and where they grew."""
    best = np.zeros(y.size + 1, np.int32)
    for value in x:
        new = best.copy()
        hit = np.flatnonzero(y == value) + 1
        new[hit] = best[hit - 1] + 1
        new = np.maximum.accumulate(np.maximum(new, best))
        yield new, new > best
        best = new


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    best = np.zeros(y.size + 1, np.int32)
    for best, _ in _growth(x, y):
        pass
    return best


def _subsequence(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Places of one longest common subsequence. Above TABLE cells x is halved where lengths
    from both ends add up to the most, so memory grows with the lines, not their square."""
    if not x.size or not y.size:
        return []
    if x.size > 1 and x.size * y.size > TABLE:
        half = x.size // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return _subsequence(x[:half], y[:cut]) + [(half + i, cut + j) for i, j in _subsequence(x[half:], y[cut:])]
    steps = np.array([grew for _, grew in _growth(x, y)])
    out = []
    i, j = x.size, y.size
    while i and j:
        if not steps[i - 1, j]:
            i -= 1
        else:
            while y[j - 1] != x[i - 1]:
                j -= 1
            out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return out[::-1]


def common_lines(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Places in a and in b of one longest common subsequence.

    Equal ends are taken off first, then lines that the other page has nowhere.
    """
    start = 0
    while start < min(a.size, b.size) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(a.size, b.size) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start : a.size - end], b[start : b.size - end]
    at_x, at_y = np.flatnonzero(np.isin(x, y)), np.flatnonzero(np.isin(y, x))
    pairs = [(k, k) for k in range(start)]
    pairs += [(start + int(at_x[i]), start + int(at_y[j])) for i, j in _subsequence(x[at_x], y[at_y])]
    pairs += [(a.size - end + k, b.size - end + k) for k in range(end)]
    return [i for i, _ in pairs], [j for _, j in pairs]


_OUTLINE = "page_id long, print long, host string, path string, digests array<bigint>, sizes array<int>, boxes array<bigint>"
#: Boxes of lines outside articles and of lines that stand in an article by themselves.
_OUTSIDE, _PLAIN = 0, 1


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


def _compared(page: list[Line]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What differencing looks at, of each line of a page: a digest of its text, its size if
    it is a candidate (else 0) and a digest of its box."""
    digests = [_digest(x.text) for x in page]
    sizes = np.zeros(len(page), np.int32)
    for i in candidates(page):
        sizes[i] = len(page[i].text)
    boxes = [(_digest(x.box) if x.box else _PLAIN) if x.inside else _OUTSIDE for x in page]
    return np.array(digests, np.uint64).view(np.int64), sizes, np.array(boxes, np.uint64).view(np.int64)


@tidy
def _outlined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each page as differencing looks at them."""
    for batch in batches:
        for part in slices(batch, 4):
            found = [_compared(lines(page or "")) for page in part.column(4).to_pylist()]
            kinds = (pa.int64(), pa.int32(), pa.int64())
            arrays = [pa.array([x[k] for x in found], pa.list_(kind)) for k, kind in enumerate(kinds)]
            names = ["page_id", "print", "host", "path", "digests", "sizes", "boxes"]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], *arrays], names)


Row = dict


def _copied(page: Row, other: Row) -> int:
    """Characters of candidates that the other page has too, in any order."""
    left, copied = Counter(other["digests"].tolist()), 0
    for digest, size in zip(page["digests"].tolist(), page["sizes"].tolist(), strict=True):
        if size and left[digest] > 0:
            left[digest] -= 1
            copied += size
    return copied


def _deleted(page: Row, other: Row, shared: np.ndarray) -> list[int] | None:
    """The candidates of a page (by number) that its neighbour shows to be furniture; None
    if the neighbour is a copy, which tells nothing."""
    sizes, boxes = page["sizes"].astype(np.int64), page["boxes"]
    if ((sizes > 0) & (boxes != _OUTSIDE)).any():
        copy = _copied(page, other) > ARTICLE_COPY * sizes.sum()
    else:
        copy = sizes[shared].sum() > COPY * sizes.sum()
    if copy:
        return None
    if not sizes[shared].any():
        return []
    held, both = Counter(boxes.tolist()), Counter(boxes[shared].tolist())
    gone = [box for box, n in both.items() if box == _OUTSIDE or n == held[box]]
    shared = shared[(sizes[shared] > 0) & np.isin(boxes[shared], gone)]
    return (np.cumsum(sizes > 0) - 1)[shared].tolist()


def _by_box(page: Row) -> dict[int, list[int]]:
    """The digests of the lines in boxes."""
    found = defaultdict(list)
    boxed = np.flatnonzero((page["boxes"] != _OUTSIDE) & (page["boxes"] != _PLAIN))
    for box, digest in zip(page["boxes"][boxed].tolist(), page["digests"][boxed].tolist(), strict=True):
        found[box].append(digest)
    return found


def _common(a: Row, b: Row) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the lines that both have in one order and that may be furniture:
    those outside articles, and those of boxes that have the same lines on both pages."""
    here, there = _by_box(a), _by_box(b)
    same = [_OUTSIDE] + [box for box, x in here.items() if there.get(box) == x]
    at_a, at_b = (np.flatnonzero(np.isin(x["boxes"], same) if here else x["boxes"] == _OUTSIDE) for x in (a, b))
    i, j = common_lines((a["digests"] ^ a["boxes"])[at_a], (b["digests"] ^ b["boxes"])[at_b])
    return at_a[i], at_b[j]


def _pairs(rows: Iterable[Row]) -> Iterator[tuple[int | None, int, int, list[int]]]:
    """For each neighbour on the same host that is no copy: page, print, agreeing characters
    of the paths, deleted candidates."""
    last: Row | None = None
    for row in rows:
        if last is not None and last["host"] == row["host"]:
            agree = len(commonprefix([last["path"], row["path"]]))
            i, j = _common(last, row)
            for page, other, shared in ((last, row, i), (row, last, j)):
                if (gone := _deleted(page, other, shared)) is not None:
                    yield page["page_id"], page["print"], agree, gone
        last = row


_PAIRED = "page_id long, print long, agree int, deleted array<int>, edge binary"


@tidy
def _paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs inside a sorted slice; its first and last row come out as they are, as edges."""
    state: dict[str, Row] = {}

    def rows() -> Iterator[Row]:
        for batch in batches:
            for k in range(batch.num_rows):
                values = {name: column[k] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                row = {n: v.values.to_numpy() if isinstance(v, pa.ListScalar) else v.as_py() for n, v in values.items()}
                state.setdefault("first", row)
                state["last"] = row
                yield row

    done: list[tuple] = []
    for pair in _pairs(rows()):
        done.append((*pair, None))
        if len(done) == 1000:
            yield _pair_batch(done)
            done = []
    if state:
        done.append((None, 0, -1, [], dumps((state["first"], state["last"]))))
    yield _pair_batch(done)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    names = ["page_id", "print", "agree", "deleted", "edge"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across the cuts between slices, from the edges of all slices in order."""
    edges = [loads(x) for batch in batches for x in batch.column(0).to_pylist()]
    order = lambda r: (r["host"], r["path"], r["page_id"] is not None, r["page_id"] or 0, r["print"])
    edges.sort(key=lambda e: order(e[0]))
    done = []
    for (_, last), (first, _) in zip(edges, edges[1:], strict=False):
        done += [(*p, None) for p in _pairs([last, first])]
    yield _pair_batch(done)


def repeated_lines(outline: DataFrame) -> DataFrame:
    """page_id, print, deleted: of each outlined page that has a neighbour, the candidates
    that differencing deletes.

    Slices of the order by host and path are cut by a range shuffle, so a host of any size
    is many slices; their edges (two rows a slice) are paired in one small task.
    """
    order = ["host", "path", "page_id", "print"]
    pairs = written(
        outline.repartitionByRange(tasks(outline), *order).sortWithinPartitions(*order).mapInArrow(_paired, _PAIRED), "pairs"
    )
    across = pairs.where("edge is not null").select("edge").coalesce(1).mapInArrow(_across, _PAIRED)
    found = pairs.where("edge is null").union(across)
    # the neighbour whose path agrees longest; of two, the one that deletes more
    return found.groupBy("page_id", "print").agg(
        F.max_by("deleted", F.struct("agree", F.size("deleted"), "deleted")).alias("deleted")
    )


@tidy
def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of each page, one a line."""
    for batch in batches:
        for part in slices(batch, 3):
            found = pa.array([main_text(lines(page or "")) for page in part.column(3).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], found], ["page_id", "url", "print", "lines"])


@tidy
def _left(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates that differencing did not delete."""
    for batch in batches:
        for part in slices(batch, 2):
            texts = []
            for text, deleted in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                gone = set(deleted or ())
                texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _print(url: Column, html: Column) -> Column:
    return F.xxhash64(url, html)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html, any others).

    text is the main text, empty if there is none (null and empty html too). n_chars counts
    its code points. A page without a neighbour on its host but copies, or with a null url,
    keeps all lines that are not furniture by themselves. Rows that repeat a page_id are told apart
    by their content; equal rows give equal results.
    """
    page_id, url, html = F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    named = F.coalesce(url, F.lit(""))
    rows = pages.select(
        page_id.alias("page_id"),
        url.alias("url"),
        _print(url, html).alias("print"),
        host_of(named).alias("host"),
        path_of(named).alias("path"),
        html.alias("html"),
    )
    # pages are read twice, so that their text is moved once: where it meets what to delete
    outline = written(
        rows.where("host <> ''").select("page_id", "print", "host", "path", "html").mapInArrow(_outlined, _OUTLINE), "outline"
    )
    chosen = rows.select("page_id", "url", "print", "html").mapInArrow(
        _chosen, "page_id long, url string, print long, lines string"
    )
    deleted = repeated_lines(outline.where("size(digests) > 0"))
    both = chosen["page_id"].eqNullSafe(deleted["page_id"]) & (chosen["print"] == deleted["print"])
    return (
        chosen.join(deleted, both, "left")
        .select(chosen["page_id"], "url", "lines", "deleted")
        .mapInArrow(_left, "page_id long, url string, text string")
        .select("*", F.length("text").cast("long").alias("n_chars"))
    )
