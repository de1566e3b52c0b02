"""The text operators beside brute force, library results and round trips."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tests.oracle import connect, difference
from tidemark.llm import bpe, common, decontaminate, embeddings, html, language, quality, queries, simhash, substrings, urls, warc

SF = "/root/testdata/sf0.001"
TEXTS = "doc_id long, text string"


def got(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_beside_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (3, 2), (7, 5), (20, 1)]
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 1, 20: 1, 4: 4, 5: 4, 7: 4}
    chain = spark.range(60).selectExpr("id as a", "id + 1 as b").repartition(7)
    assert {r.component_id for r in common.components(chain).collect()} == {0}


# ---- archives ----------------------------------------------------------------


def test_archive_round_trip(spark):
    big = "<p>" + "é" * 100
    rows = [(3, "http://a/1\r\n", big), (1, None, big), (2, "u", None), (4, "u", "x"), (5, "v", "x"), (1, None, big), (None, "w", big), (6, "u", "z" * 600_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as digest", "1 as key")
    bundles = warc.archive(pages)
    found = warc.read_archive(bundles).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found) == [
        (0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "response", None), (5, "response", None), (6, "response", None),
    ]
    by = {r.page_id: r for r in found}
    assert by[3].payload_bytes == len(big.encode()) and by[3].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert by[2].payload_bytes == 0 and by[6].payload == b"z" * 600_000 and by[3].url == "http://a/1%0D%0A"
    for row in bundles.collect():  # one record by its index entry alone
        for entry in row["index"]:
            (data,) = warc.records(row["content"], [entry.asDict()])
            assert warc.parse(data)[0] == entry["page_id"]
    assert warc.read_archive(warc.archive(pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        warc.read_seek_table(b"no table here")


# ---- decontamination ---------------------------------------------------------


def test_benchmark_passages(spark):
    item = " ".join(f"w{i}" for i in range(30))
    near = " ".join(["x0", *item.split()[1:]])
    docs = [(1, f"a b {item.upper()} c"), (2, near), (3, "unrelated words only here now"), (4, None), (5, ""), (6, "tiny Item!"), (None, item), (7, " ".join(item.split()[:20])), (1, f"{item} z")]
    items = [(10, item), (11, "tiny item!"), (12, None), (13, "")]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, TEXTS).selectExpr("*", "1 as item_id", "2 as part"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 10), (2, 10), (6, 11)}
    assert {r.doc_id: r.similarity for r in found}[2] == pytest.approx(25 / 27)
    clean = decontaminate.clean(spark.createDataFrame(docs, TEXTS), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 3, 4, 5, 7]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, TEXTS), none).count() == 0


# ---- language and quality ----------------------------------------------------


def test_passages_with_ruled_lines(spark):
    """A run of one word weighs much in a fingerprint; the similarity is 179 of 221 shingles."""
    rng = random.Random(8)
    bodies = ["".join(f"{rng.randrange(10**9):x} " for _ in range(183)) for _ in range(12)]
    items = spark.createDataFrame([(i, b + "___ " * 21) for i, b in enumerate(bodies)], "item_id long, text string")
    docs = spark.createDataFrame([(i, "a b c " + b + "... " * 21) for i, b in enumerate(bodies)], TEXTS)
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(i, i): 179 / 221 for i in range(12)}


def test_windows_of_repeated_words_by_brute_force(spark):
    rng = random.Random(11)
    some = lambda n: " ".join(rng.choice("aab") for _ in range(n))
    items = [(i, some(rng.randint(3, 14))) for i in range(25)]
    docs = [(i, some(rng.randint(0, 40))) for i in range(40)]
    cut = lambda text, n: [tuple(w[i : i + n]) for w in [text.split()] for i in range(len(w) - n + 1)]
    want = {}
    for item_id, item in items:
        n = min(5, len(item.split()))
        bag = Counter(cut(item, n))
        m = sum(bag.values())
        for doc_id, doc in docs:
            all_ = cut(doc, n)
            scores = [((c := sum((Counter(all_[t : t + m]) & bag).values())) / (2 * m - c), -t) for t in range(len(all_) - m + 1)]
            if scores and max(scores)[0] >= 0.8:
                want[doc_id, item_id] = (max(scores)[0], -max(scores)[1])
    found = decontaminate.contaminated(spark.createDataFrame(docs, TEXTS), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()} == want and len(want) > 50


def test_long_repetitive_texts_are_judged(spark):
    # the windows of this document hold hundreds of millions of shingles
    pattern = lambda n: "tick tock " * (n // 2)
    docs = [(1, pattern(60_000)), (2, "start " + pattern(30_000)), (3, "other words " * 20_000)]
    items = [(1, pattern(12_000)), (2, pattern(50_000))]
    found = decontaminate.contaminated(spark.createDataFrame(docs, TEXTS), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in found.collect()} == {(1, 1, 1.0, 0), (2, 1, 1.0, 1), (1, 2, 1.0, 0)}


def test_language_held_out(spark):
    docs = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").collect()}
    found = queries.op3_language_id(spark, SF).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(docs) and np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.95
    model = language.fit(["der die das und ist", "the and of is with"] * 20, ["de", "en"] * 20)
    edge = spark.createDataFrame([(1, None), (2, "123 !"), (3, "the and"), (None, "the and"), (3, "the and")], TEXTS).selectExpr("*", "1.0 as score")
    rows = language.identify(edge, model).collect()
    assert [r.lang_pred for r in rows] == ["und", "und", "en", "en", "en"] and rows[0].score == 0
    assert language.accepted(edge, model).count() == 3 and language.accepted(edge, model).columns == edge.columns
    nothing = language.train(edge.selectExpr("*", "cast(null as string) as lang"), common.F.lit(True))
    assert {r.lang_pred for r in language.identify(edge, nothing).collect()} == {"und"}


def test_rejection_is_calibrated(spark):
    docs = queries.table(spark, SF, "documents")
    model = language.train(docs, common.F.lit(True))
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = [r for r in found if r.lang_pred == r.lang]
    assert 0 < model.threshold < 1 and np.mean([r.rejected for r in right]) < 0.02
    assert all(r.rejected == (r.lang_pred == language.UNKNOWN or r.score < model.threshold) for r in found)
    # random letters lose far more rows than documents do
    rng, letters = np.random.default_rng(5), np.array(list("abcdefghijklmnopqrstuvwxyz"))
    junk = [" ".join("".join(rng.choice(letters, 6)) for _ in range(12)) for _ in range(100)]
    assert np.mean([language.judge(t, model)[1] < model.threshold for t in junk]) > 0.1
    # a sample that is told apart with certainty does not reject what is nearly certain
    sure = language.fit(["der die das und ist", "the and of is with"] * 20, ["de", "en"] * 20)
    assert language.judge("the and", sure)[1] >= sure.threshold


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    found = got(queries.op7_quality(spark, SF))
    held = [d for d in labels if d in found and found[d].held_out]
    assert np.mean([found[d].predicted == labels[d] for d in held]) > 0.9
    empty = quality.measure(spark.createDataFrame([(1, None), (2, ""), (None, " a ")], TEXTS))
    assert [r.score for r in quality.score(empty, quality.Model(())).collect()] == [0.5] * 3


# ---- tokens ------------------------------------------------------------------


def test_tokens_agree_with_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.Transducer(bpe.read_spec(path))
    rng = random.Random(1)
    texts = ["", "  ", "a\x1cb", "İ ΣΑΣ ß", "<|startoftext|>a<|endoftext|>", "é é", "a" * 5000, "ab!?" * 300, "中文" * 200, "don't 12"]
    texts += ["".join(rng.choices("the aésΣ1!'\n", k=rng.choice([5, 300]))) for _ in range(60)]
    rows = spark.createDataFrame([*enumerate(texts), (900, None)], TEXTS).selectExpr("*", "7 as ids")
    for r in bpe.decode(bpe.encode(rows, path), path).collect():
        ids = library.encode(texts[r.doc_id] if r.doc_id < 900 else "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    for text in texts:
        for piece in own.pieces.findall(own.normal(text)):
            letters = own.start(piece)
            assert list(own.stream(letters)) == own.merged([own.ids[x] for x in letters])
    ids = np.frombuffer(own.encode("the naïve <|endoftext|> 中文"), "<u4")
    for block in (1, 2, 1 << 14):  # blocks may end inside a character
        assert "".join(own.readable(ids, block)) == "the naïve <|endoftext|>中文 "
    first = np.frombuffer(own.encode("中"), "<u4")[:1]
    assert first.size and "".join(own.readable(first)) in ("\ufffd", "中 ")


def test_readable_text_round_trip(spark):
    coder = bpe.Transducer(bpe.read_spec(queries.TOKENIZER))
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    found = bpe.decode(bpe.encode(queries.table(spark, SF, "documents"), queries.TOKENIZER), queries.TOKENIZER).collect()
    assert len(found) == len(docs)
    for r in found:
        assert "".join(r.readable.split()) == "".join(coder.normal(docs[r.doc_id] or "").split())


# ---- repeats -----------------------------------------------------------------


def removed(docs):
    """n_removed and kept words of every document, by comparing all windows."""
    first: dict = {}
    for d, w in docs:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(d, first.get(key, d))
    out = {}
    for d, w in docs:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone |= set(range(i, i + 50))
        out[d] = " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


def test_repeats_beside_brute_force(spark):
    rng = random.Random(5)
    docs = []
    for d in range(60):
        letters = "abcd"[: rng.choice([1, 2, 4])]
        pieces = [[rng.choice(letters)] * rng.randint(1, 70), (rng.choices(letters, k=3) * 40)[: rng.randint(5, 120)], rng.choices(letters, k=60)]
        docs.append((d, sum((rng.choice(pieces) if rng.random() < 0.7 or d < 3 else list(docs[rng.randrange(d)][1]) for _ in range(3)), [])))
    want = removed(docs)
    rows = [(d, " ".join(w)) for d, w in docs]
    table = spark.createDataFrame([*rows, (100, None), (101, ""), (None, rows[-1][1])], TEXTS).selectExpr("*", "'s' as kept", "1 as start", "length(text) as n_chars")
    found = got(substrings.remove_repeats(table.repartition(5)))
    assert {d: found[d].kept for d in want} == want
    assert found[None].n_removed == 0 and found[100].n_words == 0
    cut = got(substrings.cut_repeats(table))
    assert all(cut[d].text == (want[d] if want[d] != t else t) for d, t in rows) and cut[100].text is None
    assert cut[0].asDict().keys() == dict.fromkeys(table.columns).keys()
    assert substrings.remove_repeats(table.limit(0)).count() == 0


# ---- near copies -------------------------------------------------------------


def groups(names, linked):
    top = {n: n for n in names}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    order = sorted(names)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if linked(a, b) and root(a) != root(b):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return {n: root(n) for n in names}


def prints_of(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_beside_brute_force(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    rows += [(5000, None), (5001, " \t"), (5002, "ONE two"), (5003, "one\ntwo"), (None, "one two")]
    table = spark.createDataFrame(rows, TEXTS).selectExpr("*", "1 as print", "2 as key")
    prints = {d: prints_of(t) for d, t in rows if d is not None}
    want = groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    for chunk in (simhash.CHUNK, 2):  # also with every bucket cut into chunks
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        found = got(simhash.near_duplicates(table))
        assert {d: (found[d].print % 2**64, found[d].component_id) for d in want} == {d: (prints[d], want[d]) for d in want}
        assert found[None].component_id is None
    kept = {r.doc_id for r in simhash.first_of_each(table).collect()}
    assert kept == {d for d in want if want[d] == d} | {None}


def test_vectors_beside_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + 0.09 * rng.standard_normal(16)).tolist(), i % 2) for i in range(400)]
    rows += [(400, rows[0][1], 0), (401, None, 0), (402, [0.0] * 16, 0), (403, [None] * 16, 1), (404, [float("nan")] * 16, 1), (405, rows[0][1], None), (None, rows[0][1], 0)]
    units = {i: u for i, v, x in rows if i is not None and x is not None and (u := embeddings.unit(v)) is not None}
    labels = {i: x for i, _, x in rows}
    linked = lambda a, b: a in units and b in units and labels[a] == labels[b] and units[a] @ units[b] >= 0.93
    want = groups([r[0] for r in rows if r[0] is not None], linked)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as unit", "2 as node")
    pairs = sum(linked(a, b) for a in units for b in units if a != b)
    for leaf, recall in ((1000, 1.0), (60, 0.9)):
        found = got(embeddings.near_duplicates(table, leaf=leaf), "vec_id")
        assert sum(r.n_links for r in found.values()) >= recall * pairs
        assert sum(r.n_links for r in found.values()) <= pairs
        if recall == 1:
            assert {i: found[i].component_id for i in want} == want
    assert found[None].n_links == 0 and not found[None].kept and found[402].kept
    # a dense group above the leaf's size ends the splitting
    dense = spark.createDataFrame([(i, (np.ones(8) + 1e-3 * rng.standard_normal(8)).tolist(), 1) for i in range(80)], "vec_id long, embedding array<double>, label int")
    assert {(r.n_links, r.component_id) for r in embeddings.near_duplicates(dense, leaf=20).collect()} == {(79, 0)}


# ---- pages -------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><li>Home</li></nav>
<div class="site-ad">Buy</div><header>Top</header>%s<form>Mail</form><aside>Side</aside><div id="comments"><p>Me too</p></div><footer>&copy; x</footer>"""


def test_main_text(spark):
    article = "<article><h1>A&amp;B</h1><p><b>One <i>two</i>\n three.<br><p>Four&nbsp;five<div class='promo'>No</div></article>"
    bare = "<p>Shared line</p><p>Own %s</p><p>Last shared</p>"
    rows = [(1, "http://h/a/1", PAGE % article), (2, "http://h/a/2", PAGE % article), (3, "http://k/x/1", PAGE % (bare % "a")), (4, "http://k/x/2", PAGE % (bare % "b"))]
    rows += [(5, "http://lone/", PAGE % (bare % "c")), (6, None, None), (7, "http://k/x/3", ""), (4, None, "<p>else"), (None, "nourl", "<p>x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as shared", "2 as host")
    found = html.extract(table.repartition(4)).collect()
    by = {(r.page_id, r.url): r for r in found}
    assert len(found) == len(rows) and by[1, "http://h/a/1"].text == by[2, "http://h/a/2"].text == "A&B\nOne two three.\nFour five"
    assert by[3, "http://k/x/1"].text == "Own a" and by[4, "http://k/x/2"].text == "Own b"
    assert by[5, "http://lone/"].text == "Shared line\nOwn c\nLast shared" and by[6, None].text == by[7, "http://k/x/3"].text == ""
    assert by[4, None].text == "else" and by[None, "nourl"].n_chars == 1


def test_articles_are_whole(spark):
    text = lambda page: html.main_text(html.lines(page))
    body = "<article><div class='article-header'><h1>Head</h1></div><div class='header'>Sub</div><p>One</p></article>"
    for frame in ("div class='layout-no-sidebar'", "main class='with-sidebar'", "div id='page' class='has-header'", "div class=widget", "main class='modal'", "form"):
        name = frame.split()[0]
        page = f"<div class='cookie-banner'>No</div><{frame}><nav>No</nav>{body}<div class=sidebar>No</div></{name}>"
        found = text(page).split("\n")
        assert found == ["Head", "Sub", "One"], frame
    assert text("<div id='page' class='has-header'><p>One</p></div><div class='site-ad'>No</div>") == text("<div class='menu'><p>One</div>") == "One"
    assert text("<article class='post'>One<div class='comments'><article class='comment'>No</article></div></article>") == "One"
    assert text("<article>One<svg a='>'/> two<math/> three</article><svg><path/>no</svg>") == "One two three"
    rows = [(1, "http://h/a/1", "<p>Menu</p><p>A long text of its own, once</p>"), (2, "http://h/a/2", "<p>Menu</p><p>A copied text, of some length</p>")]
    rows += [(3, "http://h/a/3", "<p>Menu</p><p>A copied text, of some length</p>"), (4, "http://h/a/4", "<p>Menu</p><p>A copied text, of some length</p>")]
    found = got(html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert found[1].text == "A long text of its own, once" and found[2].text == "A copied text, of some length"
    assert all("A copied text, of some length" in found[i].text for i in (3, 4))


def test_every_page_is_differenced(spark):
    """Articles lose boxes that the nearest URL has too, whatever their class; what a page copies stays."""
    own = "<p>Text of page %s, which no other page has, on this site or elsewhere</p><p>A paragraph that was copied</p>"
    box = "<div class='x7 y'><p>Get our letters</p><ul class=z9><li>Daily</ul></div>"
    page = f"<div>Start</div><article><div class=top><h1>Same headline</h1></div>{own}{box}<section class=part>Part %s</section><section class=part>Copied part</section></article><div>End</div>"
    rows = [(i, f"http://h/a/{i}", page % (i, i)) for i in (1, 2)]
    # of two pages with much the same article, none loses a box; equal rows are copies too
    same = f"<article><p>One long text that both pages have in full</p>{box}<p>Odd %s</p></article>"
    rows += [(i, f"http://k/a/{i}", same % i) for i in (3, 4)] + [(5, "http://l/a", page % (5, 5))] * 2
    # a box with a line of its own stays, and so does one that comes in another order
    moved = "<article><p>A long text of page %s, that has no like here</p>%s</article>"
    mixed = ["<ul class=a><li>One<li>%s</ul><ul class=b><li>Two</ul><ul class=c><li>Three</ul>", "<ul class=a><li>One<li>%s</ul><ul class=c><li>Three</ul><ul class=b><li>Two</ul>"]
    rows += [(9 + i, f"http://n/{i}", moved % (9 + i, x % i)) for i, x in enumerate(mixed)]
    # the nearest URL of a page without an article may have one, and may name what the page does not
    rows += [(6, "http://m/a/1", "<div class=q>Start</div><article>Of its own</article><div class=menu>Shop</div>")]
    rows += [(7, "http://m/a/2", "<p>Start</p><p>Of its own</p><p>Another text, longer than what the pages share</p><p>Shop</p>"), (8, "http://m/b", "<p>Else</p>")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    text = {r.page_id: r.text for r in found}
    whole = "Same headline\nText of page {0}, which no other page has, on this site or elsewhere\nA paragraph that was copied\n{1}Part {0}\nCopied part"
    assert len(found) == len(rows) and [text[i] for i in (1, 2)] == [whole.format(i, "") for i in (1, 2)]
    assert text[3].split("\n") == ["One long text that both pages have in full", "Get our letters", "Daily", "Odd 3"]
    assert text[4].endswith("Odd 4") and text[5] == whole.format(5, "Get our letters\nDaily\n")
    assert [sorted(text[i].split("\n")[1:3]) for i in (9, 10)] == [["0", "One"], ["1", "One"]]
    assert [len(text[i].split("\n")) for i in (9, 10)] == [4, 4]  # of Two and Three one is in order on both pages
    assert text[6] == "Of its own" and text[7] == "Of its own\nAnother text, longer than what the pages share" and text[8] == "Else"


def test_common_lines():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        i, j = html.common_lines(np.array(a), np.array(b))
        best = defaultdict(int)
        for x in range(len(a)):
            for y in range(len(b)):
                best[x, y] = max(best[x - 1, y], best[x, y - 1], (best[x - 1, y - 1] + 1) if a[x] == b[y] else 0)
        assert [a[k] for k in i] == [b[k] for k in j] and sorted(i) == i and sorted(j) == j
        assert len(i) == (best[len(a) - 1, len(b) - 1] if a and b else 0)


def test_common_lines_in_halves(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(100):
        a, b = (rng.integers(0, 5, rng.integers(0, 40)) for _ in range(2))
        whole = html.common_lines(a, b)
        with monkeypatch.context() as m:
            m.setattr(html, "TABLE", 6)
            i, j = html.common_lines(a, b)
        assert len(i) == len(whole[0]) and (a[i] == b[j]).all() and i == sorted(set(i)) and j == sorted(set(j))


def test_hostile_pages_are_read_in_one_pass():
    # a reader that starts over at each tag would need hours for these
    n = 200_000
    text = lambda page: [x.text for x in html.lines(page)]
    assert text('<a title="' + "<b x>" * n)[0].startswith('<a title="')
    assert text("<div>" * n + "x" + "</div>" * n) == ["x"]
    assert text("<div>" * n + "y" + "</nav>" * n) == ["y"]
    assert text('<a "' * n + ">") == [] and text('<a "' * (n + 1) + ">") == ['<a "'] and len(text("<a '\"<b \"' " * n)) == 1
    assert text("<script>" * n) == text("<!-- " * n) == text("<div><main>" * n) == []
    assert text("<p>one" + "<svg " * n) == ["one" + ("<svg " * n).rstrip()]


def test_long_articles_are_compared_in_linear_time():
    # the common subsequence of all cells would take minutes
    cells = lambda n, k: "".join(f"<td>{i * k % 997}" for i in range(n))
    rows = []
    n = 100_000
    for k in (7, 11):
        page = f"<article><p>{k} own{'.' * 20 * n}</p>{cells(n, k)}<table class=own>{cells(n, k)}</table><div class=ours>Ours</div></article>"
        rows.append(dict(zip(("digests", "sizes", "boxes"), html._compared(html.lines(page)), strict=True)))
        rows[-1] |= {"page_id": k, "print": k, "host": "h", "path": "/"}
    assert [(x[0], x[3]) for x in html._pairs(rows)] == [(7, [2 * n + 1]), (11, [2 * n + 1])]


def test_tags_that_do_not_end():
    text = lambda page: [x.text for x in html.lines(page)]
    assert text("a < b <c") == ["a < b <c"]
    assert text("<p>1 <i a='>2</i> 3") == ["1 <i a='>2 3"]  # the quote stays open: the tag is text
    assert text("<p>1 <i a='>'>2</i> <!x <?y>3") == ["1 2 3"]
    assert text("<p>1<script a='>'>2</p></SCRIPT >3<title/>4") == ["13"]
    assert text("<p>1<svg a='/>'>2</svg>3<math b/>4<!-- 5") == ["134"]


def test_url_verdicts(spark):
    cases = [
        ("http://a.net/x", "a.net", "/x", "net/", "block"), ("HTTP://www.Example.net/en/1?q", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/x#y", "example.com", "/de/x", "example.com/de/", "block"), ("http://q.org/fr/", "q.org", "/fr/", "org/fr/", "allow"),
        ("http://net", "net", "", None, None), ("http://anet/x", "anet", "/x", None, None), (None, "", "", None, None), ("a.net/x", "", "", None, None),
        ("x://cheappills.example.com/p", "cheappills.example.com", "/p", None, "block"), ("x://garden.example.com/p", "garden.example.com", "/p", None, "allow"),
    ]
    more = [("http://cheap-pills.example.com/p",)] * 5 + [("http://garden.example.com/p",)] * 9
    table = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)] + [(100 + i, u) for i, (u,) in enumerate(more)], "page_id long, url string").selectExpr("*", "1 as host")
    found = got(urls.judge(table), "page_id")
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ((verdict,) if verdict else ("block", "allow"))
    assert urls.segment("cheappills", urls.Words({"cheap": -2.0, "pills": -3.0}, 9.0)) == ("cheap", "pills")
    assert urls.judge(table.limit(0)).count() == 0


def test_url_words_beyond_any_size(spark):
    """Words seen as often as 21,000 others count as evidence, whatever their place among them."""
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in f"{n:05d}")
    words = [f"q{letters(n)}" for n in range(21_000)]
    rows = [f"http://garden/{'/'.join(words[i : i + 12])}" for i in range(0, len(words), 12)] * 6
    rows += ["http://poker/x"] * 2_000
    table = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    assert all(r.verdict == ("block" if r.host == "poker" else "allow") for r in urls.judge(table).collect())


def test_url_words_of_any_length():
    long = "donaudampfschifffahrtsgesellschaft"
    known = urls.Words({long: -9.0, "news": -3.0}, 12.0)
    assert urls.segment(f"news{long}", known) == ("news", long)


# ---- all together ------------------------------------------------------------


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.written(stage(spark, kept, SF), "stage")
        assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    prints = {r.doc_id: prints_of(r.text) for r in docs.collect()}
    firsts = groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert ids <= {d for d in firsts if firsts[d] == d} and len(ids) > 0.8 * len(set(firsts.values()))
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids
