"""Conversation repair, the Merkle manifest and SentencePiece beside brute force and the library."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tests.oracle import connect, difference
from tidemark.llm import conversations, merkle, pieces, queries

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- conversations -------------------------------------------------------------


def cheapest(rows):
    """Cost, audit and repaired lines by a search over all edits, cheapest and least first."""
    heap, done = [(0, "", 0, "e", ())], set()
    step = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        if i == len(rows) and state in "ea":
            return cost, audit, "\n".join(lines)
        done.add((i, state))
        role = "assistant" if state == "u" else "user"
        after = step[state, role[0]]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after, (*lines, role + ":")))
        if i < len(rows):
            own, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if fault not in ("b", "d"):
                cut = fault == "t"
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, after, (*lines, f"{role}:{text}")))
                if (state, own[:1]) in step:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, step[state, own[:1]], (*lines, f"{own}:{text}")))


def repaired(rows):
    """What op11 states, from its text, for (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1])):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        seen, judged = set(), []
        for _, role, text in after:
            body = text.strip(" \t\n\x0b\x0c\r")
            judged.append((role, text, "b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t"))
            seen.add((role, text))
        turns = {t for t, *_ in after if t is not None}
        faults = [f for *_, f in judged]
        legal = [a[:1] + b[:1] in ("su", "ua", "au") for (a, *_), (b, *_) in zip(judged, judged[1:], strict=False)]
        cost, audit, text = cheapest(judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("b"), faults.count("d"), faults.count("t"), legal.count(False),
            cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def test_repairs_beside_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        for turn in rng.sample(range(60), rng.choice([1, 3, 12, 40])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Say"])
            text = rng.choice(["Yes.", "No!", "So?", "cut", "", " \n", "a. ", "x\x0b", "é.", *(f"w{rng.randrange(99)}." for _ in range(20))])
            rows.append((conv, turn, role, text))
    rows += [(70, None, None, None), (70, None, None, None), (71, 5, "user", None), (72, -3, "user", "a."), (72, 9, "assistant", "b.")]
    rows += [(80, t, "user" if t % 3 else "assistant", f"{t % 50} ok" + "." * (t % 4 > 0)) for t in range(400)]  # longer than a segment
    dropped = next(t for t in range(10**4) if zlib.crc32(f"90:{t}".encode()) % 20 == 0)
    rows.append((90, dropped, "user", "Gone."))
    want = repaired(rows)
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' as digest", "1 as task", "true as dropped")
    for limit in (1024, 7):
        found = conversations.repair(conversations.damaged(table.repartition(5)), limit).collect()
        assert {r[0]: tuple(r)[1:] for r in found} == want and len(found) == len(want)
    empty = hashlib.sha256(b"").hexdigest()
    assert want[90] == (0, 0, 0, 0, 0, 0, "", empty)
    assert conversations.repair(conversations.damaged(table.limit(0))).count() == 0
    kept = conversations.repair(conversations.as_is(spark.createDataFrame([(1, 1, "user", "A."), (1, 2, "assistant", "B.")], TURNS))).first()
    assert (kept.cost, kept.audit) == (0, "KK")


def test_audits_that_share_a_hash():
    for base in (conversations.BASE, 0, 1):  # with base 0 a hash is the last letter, with 1 a sum
        audits, rng, nodes = conversations.Audits(base), random.Random(base), [0]
        for _ in range(400):
            nodes.append(audits.add(rng.choice(nodes), "".join(rng.choices("DIKR", k=rng.choice([1, 1, 3]))), 0))
        spelled = {n: audits.spelled(n) for n in nodes}
        for _ in range(3000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert audits.before(a, b) == (spelled[a] < spelled[b])


# ---- manifest ------------------------------------------------------------------


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduced(nodes):
    """Levels of one tree, from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded root and verdict of each row, sorted."""
    leaf = lambda r, text: h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: reduced([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = reduced([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (*_, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node, proof = leaf(r, text), []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    low = at - at % 3
                    run = level[low : low + 3]
                    others = run[: at - low] + run[at - low + 1 :]
                    proof += others
                    node = h(*others[: at - low], node, *others[at - low :])
                    at //= 3
            out.append((r[0], own, trees[s][-1][0], top[-1][0], h(*proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [6, 2])
def test_manifest_beside_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "RUN", 3**levels)
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "", "a\nb", "é " * 50]), "en", rng.choice(["s", "s", "é", "Z", None]), i) for i in range(150)]
    rows += [(200, "alone\n", None, "one", None), (7, "a\nb", "en", "s", 1), (7, "a\nb", "en", "s", 1), (None, "n\n", None, "s", None), (-5, "\n\n", "", "", 0)]
    table = spark.createDataFrame(rows, DOCS).selectExpr("*", "'k' as key", "1 as rank", "2 as total")
    leaves = merkle.leaves(table.repartition(3), merkle.tampered_text())
    # as on executors: the workers are told the sizes with the functions they run
    monkeypatch.setattr(merkle, "_built", local(merkle._built, levels))
    monkeypatch.setattr(merkle, "_descended", local(merkle._descended, levels))
    found = merkle.proofs(merkle.manifest(leaves)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == manifest(rows)
    assert merkle.proofs(merkle.manifest(leaves.limit(0))).count() == 0


def local(function, levels):
    def run(batches, **named):
        merkle.LEVELS, merkle.RUN = levels, 3**levels
        try:
            yield from function(batches, **named)
        finally:
            merkle.LEVELS, merkle.RUN = 6, 3**6

    return run


def test_places_in_the_log():
    for n in (1, 2, 3, 4, 9, 10, 28, 100, 729):
        leaves = [bytes([i % 251]) * 32 for i in range(n)]
        for top in {merkle.height(n), 6}:
            log, level = merkle.append_log(leaves, top), leaves
            for j in range(top + 1):
                assert [log[merkle.place(j, i, n, top)] for i in range(len(level))] == level
                level = [merkle.digest(level[i : i + 3]) for i in range(0, len(level), 3)]


def test_tampering_shows():
    leaves = [bytes([i]) * 32 for i in range(11)]
    nodes = b"".join(merkle.append_log(leaves, 3))
    path = merkle.packed(merkle.siblings(nodes, 10, 11, 3))
    assert merkle.fold(leaves[10], path) == nodes[-32:] != merkle.fold(leaves[9], path)


# ---- SentencePiece -------------------------------------------------------------


def test_pieces_agree_with_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(pieces.read_model(path))
    rng = random.Random(2)
    texts = ["", " ", " " * 40, " " * 9000, "a" * 700, "ha" * 3000, "-=" * 3000, "▁ x▁▁y", "\x00a<0x41><s></s><unk>", "日本語 😀é", "\t\n\r x", "=+" * 90, "　"]
    texts += ["".join(rng.choice(["the", "in", "er", " ", " a", "ing", "==", "--", "é", "语", "\n", "7"]) for _ in range(rng.randrange(80))) for _ in range(200)]
    rows = spark.createDataFrame([*enumerate(texts), (900, None), (None, "a b"), (3, texts[3])], "doc_id long, text string").selectExpr("*", "7 as ids")
    found = pieces.decode(pieces.encode(rows, path), path).collect()
    assert len(found) == len(texts) + 3
    for r in found:
        text = "a b" if r.doc_id is None else "" if r.doc_id == 900 else texts[r.doc_id]
        ids = library.encode(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids), text[:40]
        assert r.decoded == library.decode(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    for _ in range(300):  # ids that no encoder gives
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260)]) for _ in range(rng.randrange(9))]
        assert own.decode(np.array(ids, "<u4")) == library.decode(ids)
    assert pieces.encode(rows.limit(0), path).count() == 0


def test_agenda_gives_what_rounds_give(monkeypatch):
    own = pieces.Pieces(pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    rng = random.Random(6)
    words = ["".join(rng.choices("aeinrst▁", k=rng.randrange(1, 60))) for _ in range(400)]
    by_rounds = own.merge(words)
    monkeypatch.setattr(pieces, "AGENDA", 2)
    assert own.merge(words) == by_rounds


def test_op13_over_its_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.op13_sentencepiece(spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_sql_of_the_manifest_at_a_larger_size(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(queries.op12_merkle_manifest(spark, sf), connect(sf), queries.SQL["op12_merkle_manifest"]) is None
