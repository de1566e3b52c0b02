"""Repair of the turn structure of conversations by the cheapest edits, with an audit.

The edits are found by a dynamic program over the rows in order; its states say what the
repaired conversation ends with so far. An audit is a node that points to the audit it
extends, so all prefixes are shared; nodes have ancestors at powers of two and a rolling
hash of what they spell. Audits of equal cost are compared by a binary search for their
longest common prefix on these hashes, and the prefix found is verified letter by letter
unless both sides are one node. Rows are sorted once over all tasks, so a conversation may
hold any share of them: one that a task does not hold whole, or that is longer than a
segment, becomes segments. A segment gives, for each state before it and after it, its
cheapest edits; these are joined in order by the same program, with whole segments as steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tasks, written
from tidemark.llm.sqltext import crc32

#: Rows and bytes of text that one segment holds at most (a single longer row is alone).
SEGMENT_ROWS = 1024
SEGMENT_BYTES = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: What the repaired conversation ends with so far; it may end in EMPTY and ANSWER.
EMPTY, SYSTEM, USER, ANSWER = range(4)
STEPS = {
    (EMPTY, "s"): SYSTEM,
    (EMPTY, "u"): USER,
    (SYSTEM, "u"): USER,
    (ANSWER, "u"): USER,
    (USER, "a"): ANSWER,
}
#: The only role that an edit can give in each state.
GIVEN = {EMPTY: "user", SYSTEM: "user", ANSWER: "user", USER: "assistant"}
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
PRIME, BASE = (1 << 61) - 1, 911_382_323

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
SEGMENT = "task int, segment long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"


class Audits:
    """Strings that share their prefixes; node 0 is the empty one."""

    def __init__(self, base: int = BASE):
        self.base = base
        self.piece, self.length, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]
        self.states = [EMPTY]
        self.made: dict[tuple, int] = {}

    def rolled(self, value: int, piece: str) -> int:
        for c in piece:
            value = (value * self.base + ord(c)) % PRIME
        return value

    def add(self, parent: int, piece: str, state: int) -> int:
        """The node that extends its parent by a piece; the same node for the same call."""
        key = (parent, piece, state)
        node = self.made.get(key)
        if node is None:
            node = self.made[key] = len(self.piece)
            self.piece.append(piece)
            self.length.append(self.length[parent] + len(piece))
            self.hash.append(self.rolled(self.hash[parent], piece))
            self.states.append(state)
            up = [parent]
            while up[-1]:
                higher = self.up[up[-1]]
                up.append(higher[min(len(up) - 1, len(higher) - 1)])
            self.up.append(up)
        return node

    def holding(self, node: int, length: int) -> int:
        """The first node on the way to this one that spells at least so many letters."""
        for j in range(len(self.up[node]) - 1, -1, -1):
            while j < len(self.up[node]) and self.length[self.up[node][j]] >= length:
                node = self.up[node][j]
                if not node:
                    return 0
        return node

    def prefix(self, node: int, length: int) -> int:
        """Hash of the first letters of a node."""
        if not length:
            return 0
        node = self.holding(node, length)
        parent = self.up[node][0]
        left = length - self.length[parent]
        if left == len(self.piece[node]):
            return self.hash[node]
        return self.rolled(self.hash[parent], self.piece[node][:left])

    def letter(self, node: int, index: int) -> str:
        node = self.holding(node, index + 1)
        return self.piece[node][index - self.length[self.up[node][0]]]

    def pieces(self, node: int) -> list[int]:
        """Nodes from the first piece to this one."""
        way = []
        while node:
            way.append(node)
            node = self.up[node][0]
        return way[::-1]

    def spelled(self, node: int) -> str:
        return "".join(self.piece[n] for n in self.pieces(node))

    def agree(self, a: int, b: int, length: int) -> bool:
        """Whether the first letters are the same, by the letters themselves."""
        a, b = self.holding(a, length), self.holding(b, length)
        if a == b or not length:
            return True
        left, right = self.spelled(a)[:length], self.spelled(b)[:length]
        return left == right

    def before(self, a: int, b: int) -> bool:
        """Whether a spells less than b."""
        if a == b:
            return False
        low, high = 0, min(self.length[a], self.length[b])
        while low < high:
            middle = (low + high + 1) // 2
            if self.prefix(a, middle) == self.prefix(b, middle):
                low = middle
            else:
                high = middle - 1
        if not self.agree(a, b, low):  # two texts with one hash
            return self.spelled(a) < self.spelled(b)
        if low == min(self.length[a], self.length[b]):
            return self.length[a] < self.length[b]
        return self.letter(a, low) < self.letter(b, low)


class Best:
    """The cheapest audit of each state, of equal ones the least."""

    def __init__(self, audits: Audits, found: dict[int, tuple[int, int]] | None = None):
        self.audits, self.found = audits, found or {}

    def offer(self, state: int, cost: int, parent: int, piece: str) -> bool:
        have = self.found.get(state)
        if have is not None and have[0] < cost:
            return False
        node = self.audits.add(parent, piece, state)
        if have is not None and have[0] == cost and not self.audits.before(node, have[1]):
            return False
        self.found[state] = (cost, node)
        return True

    def insert(self) -> None:
        """Take inserted turns into account: at most two in a row are ever cheapest."""
        for state in (EMPTY, SYSTEM, ANSWER, USER, EMPTY, SYSTEM, ANSWER):
            if state in self.found:
                cost, node = self.found[state]
                self.offer(STEPS[state, GIVEN[state][0]], cost + INSERT, node, "I")


def step(best: Best, initial: str, gone: bool, cut: bool) -> Best:
    """One row: inserted turns before it, then keep, new role or delete."""
    best.insert()
    after = Best(best.audits)
    for state, (cost, node) in best.found.items():
        after.offer(state, cost + DELETE, node, "D")
        if not gone:
            kept = STEPS.get((state, initial))
            if kept is not None:
                after.offer(kept, cost + cut * CUT_SHORT, node, "K")
            after.offer(STEPS[state, GIVEN[state][0]], cost + REROLE + cut * CUT_SHORT, node, "R")
    return after


def accepted(best: Best) -> tuple[int, int]:
    """Cost and node of the cheapest edits that end a conversation."""
    best.insert()
    cost, node = best.found.get(ANSWER, (None, 0))
    if EMPTY in best.found:
        other, empty = best.found[EMPTY]
        if cost is None or other < cost or (other == cost and best.audits.before(empty, node)):
            return other, empty
    return cost, node


def faults(roles: list[str], texts: list[str], seen: list[bool]) -> list[str]:
    """The first fault of each row: b(lank), d(uplicate), t(runcated) or none."""
    out = []
    for text, again in zip(texts, seen, strict=True):
        body = text.rstrip(BLANKS)
        out.append("b" if not body else "d" if again else "" if body.endswith(ENDS) else "t")
    return out


def repeated(digests: list[bytes], earlier: Iterable[bytes] = ()) -> list[bool]:
    """Whether role and text of a row were seen before."""
    known = set(earlier)
    out = []
    for d in digests:
        out.append(d in known)
        known.add(d)
    return out


def lines(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired turns that the edits of some rows give."""
    row = 0
    for edit in audit:
        if edit == "I":
            yield GIVEN[state] + ":"
            state = STEPS[state, GIVEN[state][0]]
            continue
        if edit != "D":
            role = roles[row] if edit == "K" else GIVEN[state]
            yield f"{role}:{texts[row]}"
            state = STEPS[state, role[0]]
        row += 1


def counted(roles: list[str], found: list[str]) -> tuple[int, int, int, int]:
    """blank, duplicate, truncated, illegal of rows in order."""
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return found.count("b"), found.count("d"), found.count("t"), illegal


def distinct(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """Least, greatest and number of distinct turns, nulls left out."""
    known = {t for t in turns if t is not None}
    return (min(known), max(known), len(known)) if known else (None, None, 0)


def whole(turns: list, roles: list[str], texts: list[str], digests: list[bytes]) -> tuple:
    """The result of a conversation from all its rows in order."""
    low, high, n = distinct(turns)
    found = faults(roles, texts, repeated(digests))
    audits = Audits()
    best = Best(audits, {EMPTY: (0, 0)})
    for role, fault in zip(roles, found, strict=True):
        best = step(best, role[:1], fault in ("b", "d"), fault == "t")
    cost, node = accepted(best)
    audit = audits.spelled(node)
    text = "\n".join(lines(audit, EMPTY, roles, texts))
    gaps = high - low + 1 - n if n else 0
    return (gaps, *counted(roles, found), cost, audit, hashlib.sha256(text.encode()).hexdigest())


# ---- damage --------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows after damage by crc32 of `conv_id:turn`.

    Modulo 20, 0 drops a row (it stays as a mark without text, so that its conversation is
    known), 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it a
    user's. Null roles, texts and parts of the key are one space. Other columns are not read.
    """
    space = F.lit(" ")
    key = F.concat_ws(
        ":",
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def as_is(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped of undamaged rows; null roles and texts are one space."""
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(False).alias("dropped"),
    )


# ---- segments ------------------------------------------------------------------


def _segments(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that the sorted rows of a task hold whole, and segments
    of the first and the last one, which other tasks may share, and of long ones."""
    task = TaskContext.get().partitionId()
    schema = [f.split()[0] for f in (RESULT + ", " + SEGMENT).split(", ")]
    types = [
        pa.int64(), *[pa.int64()] * 6, pa.string(), pa.string(),
        pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.string())] * 2, pa.list_(pa.binary()),
    ]
    none = (None,) * 8
    out: list[tuple] = []
    size = number = 0
    conv: object = none  # no conversation yet
    first = cut = True
    held: tuple[list, ...] = ([], [], [], [])

    def flush(shared: bool) -> None:
        nonlocal number, held
        if shared:
            out.append((conv, *none, task, number, *held))
        else:
            out.append((conv, *whole(*held), task, None, None, None, None, None))
        number += 1
        held = ([], [], [], [])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema)

    for batch in batches:
        columns = batch.to_pydict()
        for c, turn, role, text, dropped, d in zip(
            *(columns[n] for n in ("conv_id", "turn", "role", "text", "dropped", "digest")), strict=True
        ):
            if c != conv:
                if conv is not none:
                    flush(first or cut)
                    first = False
                conv, cut, size = c, False, 0
            if dropped:
                continue
            if len(held[0]) >= limit or (held[0] and size + len(text) > SEGMENT_BYTES):
                flush(True)
                cut, size = True, 0
            for column, value in zip(held, (turn, role, text, d), strict=True):
                column.append(value)
            size += len(text)
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
    if conv is not none:
        flush(True)
    if out:
        yield batch_of(out)


MATRIX = (
    "conv_id long, task int, segment long, low long, high long, n_turns long, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, "
    "edits array<struct<start int, end int, cost long, audit string>>"
)


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each segment its counts and its cheapest edits from every state to every state."""
    names = [f.split()[0] for f in MATRIX.split(", ")[:12]] + ["edits"]
    types = [
        pa.int64(), pa.int32(), *[pa.int64()] * 8, pa.string(), pa.string(),
        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
    ]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            found = faults(row["roles"], row["texts"], repeated(row["digests"], row["earlier"] or ()))
            edits = []
            for start in range(4):
                audits = Audits()
                best = Best(audits, {start: (0, 0)})
                for role, fault in zip(row["roles"], found, strict=True):
                    best = step(best, role[:1], fault in ("b", "d"), fault == "t")
                for end, (cost, node) in best.found.items():
                    edits.append({"start": start, "end": end, "cost": cost, "audit": audits.spelled(node)})
            initials = [r[:1] for r in row["roles"]]
            values = (
                row["conv_id"], row["task"], row["segment"], *distinct(row["turns"]),
                *counted(row["roles"], found),
                initials[0] if initials else None, initials[-1] if initials else None, edits,
            )
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


JOINED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "parts array<struct<task int, segment long, state int, audit string>>"
)


class _Joined:
    """A conversation that is put together from its segments in order."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.audits = Audits()
        self.best = Best(self.audits, {EMPTY: (0, 0)})
        self.order: list[tuple[int, int]] = []
        self.low = self.high = self.last = None
        self.turns = 0
        self.counts = [0, 0, 0, 0]

    def take(self, row: dict) -> None:
        if row["low"] is not None:
            self.turns += row["n_turns"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += row[name]
        if row["first"] is None:  # rows of this segment were all dropped
            return
        self.counts[3] += self.last is not None and self.last + row["first"] not in LEGAL
        self.last = row["last"]
        after = Best(self.audits)
        for edit in row["edits"]:
            have = self.best.found.get(edit["start"])
            if have is not None:
                after.offer(edit["end"], have[0] + edit["cost"], have[1], edit["audit"])
        self.best = after
        self.order.append((row["task"], row["segment"]))

    def result(self) -> tuple:
        cost, node = accepted(self.best)
        nodes = self.audits.pieces(node)
        states = [EMPTY, *[self.audits.states[n] for n in nodes]]
        audits = [self.audits.piece[n] for n in nodes]
        n = len(self.order)
        parts = [
            {"task": t, "segment": s, "state": state, "audit": audit}
            for (t, s), state, audit in zip(self.order, states, audits, strict=False)
        ]
        if parts:  # turns inserted at the end go with the last segment
            parts[-1]["audit"] += "".join(audits[n:])
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.counts, cost, "".join(audits), parts)


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and place, one row a conversation."""
    names = [f.split()[0] for f in JOINED.split(", ")[:8]] + ["parts"]
    types = [
        *[pa.int64()] * 7, pa.string(),
        pa.list_(pa.struct([("task", pa.int32()), ("segment", pa.int64()), ("state", pa.int32()), ("audit", pa.string())])),
    ]
    now: _Joined | None = None

    def batch_of(joined: _Joined) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(joined.result(), types, strict=True)], names
        )

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if now is None or now.conv != row["conv_id"]:
                if now is not None:
                    yield batch_of(now)
                now = _Joined(row["conv_id"])
            now.take(row)
    if now is not None:
        yield batch_of(now)


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns of each segment as one text."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            turns = list(lines(row["audit"], row["state"], row["roles"], row["texts"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), batch.column(2).slice(i, 1),
                    pa.array(["\n".join(turns) if turns else None], pa.string()),
                ],
                ["conv_id", "task", "segment", "text"],
            )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of a conversation in order, in constant memory."""
    none = object()
    conv: object = none
    state, begun = hashlib.sha256(), False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"]
        )

    for batch in batches:
        for c, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if c != conv:
                if conv is not none:
                    yield row()
                conv, state, begun = c, hashlib.sha256(), False
            if text is not None:
                state.update(("\n" if begun else "").encode() + text.encode())
                begun = True
    if conv is not none:
        yield row()


def _streamed(rows: DataFrame, over: Callable, schema: str) -> DataFrame:
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "task", "segment")
    return ordered.mapInArrow(over, schema)


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text, dropped).

    gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 as the query
    op11 states them. Rows go by turn, null turns first; rows of one turn by a digest of role
    and text, so equal ones are neighbours. Two rows are the same if these digests (128
    bits of SHA-256) are. A null conv_id is a conversation of its own. A conversation whose
    rows are all dropped has zeros, an empty audit and the digest of an empty text. An
    empty table gives an empty result. ``segment_rows`` says how long a segment may be; the
    result does not depend on it.

    The digest of a conversation runs over its repaired segments in order in one task, a
    segment at a time: SHA-256 cannot be taken in parts.
    """
    # lengths keep role and text apart, whatever they hold
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.unhex(F.substring(F.sha2(both, 256), 1, 32))
    order = ["conv_id", "turn", "digest"]
    ordered = (
        rows.select("conv_id", "turn", "role", "text", "dropped", digest.alias("digest"))
        .repartitionByRange(tasks(rows), *order)
        .sortWithinPartitions(*order)
    )
    found = written(
        ordered.mapInArrow(partial(_segments, limit=segment_rows), RESULT + ", " + SEGMENT), "conversations"
    )
    columns = [f.split()[0] for f in RESULT.split(", ")]
    complete = found.where("segment is null").select(*columns)
    segments = found.where("segment is not null").select(
        "conv_id", "task", "segment", "turns", "roles", "texts", "digests"
    )

    def same(*names: str):
        terms = [F.col(f"s.{n}").eqNullSafe(F.col(f"o.{n}")) for n in names]
        whole_term = terms[0]
        for term in terms[1:]:
            whole_term = whole_term & term
        return whole_term

    # rows that an earlier segment of the conversation has: one row a segment and text
    place = F.struct("task", "segment")
    held = segments.select(
        "conv_id", "task", "segment", F.explode(F.array_distinct("digests")).alias("digest")
    ).withColumn("place", place)
    least = held.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.max("place").alias("final"))
    several = least.where("first < final").select("conv_id", "digest", "first")
    again = (
        held.alias("s")
        .join(several.alias("o"), same("conv_id", "digest"))
        .where("s.place > o.first")
        .groupBy("s.conv_id", "s.task", "s.segment")
        .agg(F.collect_list("s.digest").alias("earlier"))
    )
    judged = (
        segments.alias("s")
        .join(again.alias("o"), same("conv_id", "task", "segment"), "left")
        .select("s.*", "o.earlier")
        .mapInArrow(_matrices, MATRIX)
    )
    joined = written(_streamed(written(judged, "segments"), _joined, JOINED), "joined")
    parts = joined.select("conv_id", F.explode("parts").alias("part")).select("conv_id", "part.*")
    texts = (
        segments.alias("s")
        .join(parts.alias("o"), same("conv_id", "task", "segment"))
        .select("s.conv_id", "s.task", "s.segment", "s.roles", "s.texts", "o.state", "o.audit")
        .mapInArrow(_repaired, "conv_id long, task int, segment long, text string")
    )
    digests = _streamed(texts, _digests, "conv_id long, repaired_sha256 string")
    rest = (
        joined.alias("s")
        .join(digests.alias("o"), same("conv_id"), "left")
        .select(
            *[F.col(f"s.{c}") for c in columns[:-1]],
            F.coalesce("o.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
    return complete.union(rest)


# ---- the same in SQL -----------------------------------------------------------

_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_WORD = "[^\\x20\\x09-\\x0D]"

SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce("text", ' ') AS body, {crc32(_KEY)} % 20 AS kind
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(body, '.!?', '') ELSE body END AS body,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE kind <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || body), copy) AS i
  FROM hurt),
judged AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(body, '{_WORD}') THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv, role, body ORDER BY i) > 1 THEN 'd'
              WHEN right(rtrim(body, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
              THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv, any_value(conv_id) AS conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         max(i) AS n
  FROM judged GROUP BY conv),
inserts(state, taken, price, letters, words) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']),
         (2, 3, 2, 'I', ['assistant:']),
         (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
steps(state, initial, taken, given) AS (
  VALUES (0, 's', 1, ''), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (3, 'u', 2, 'user'), (2, 'a', 3, 'assistant')),
best AS (
  SELECT conv, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'words': []::VARCHAR[]}} AS edits
  FROM counts
  UNION ALL
  SELECT b.conv, b.i + 1, o.taken,
         min({{'cost': b.edits.cost + x.price + o.price + CASE WHEN o.letter <> 'D' AND j.fault = 't' THEN 1 ELSE 0 END,
               'audit': b.edits.audit || x.letters || o.letter,
               'words': b.edits.words || x.words || CASE o.letter
                        WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.body]
                        ELSE [o.given || ':' || j.body] END}})
  FROM best b
  JOIN judged j ON j.conv = b.conv AND j.i = b.i + 1
  JOIN inserts x ON x.state = b.state
  JOIN (SELECT state, '' AS initial, state AS taken, '' AS given, 'D' AS letter, 3 AS price FROM (VALUES (0), (1), (2), (3)) v(state)
        UNION ALL SELECT *, 'K', 0 FROM steps
        UNION ALL SELECT *, 'R', 2 FROM steps WHERE given <> '') o
    ON o.state = x.taken AND (o.letter <> 'K' OR o.initial = j.initial) AND (o.letter = 'D' OR j.fault NOT IN ('b', 'd'))
  GROUP BY b.conv, b.i, o.taken),
ended AS (
  SELECT b.conv, min({{'cost': b.edits.cost + x.price, 'audit': b.edits.audit || x.letters, 'words': b.edits.words || x.words}}) AS edits
  FROM best b JOIN counts c ON c.conv = b.conv AND c.n = b.i JOIN inserts x ON x.state = b.state
  WHERE x.taken IN (0, 3) GROUP BY b.conv),
known AS (
  SELECT c.*, e.edits FROM counts c JOIN ended e ON e.conv = c.conv)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(k.edits.cost, 0)::BIGINT AS cost,
       coalesce(k.edits.audit, '') AS audit,
       sha256(coalesce(array_to_string(k.edits.words, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN known k ON k.conv_id IS NOT DISTINCT FROM a.conv_id
"""
