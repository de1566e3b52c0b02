"""URL verdicts: rules on host and path, else naive Bayes over segmented words.

Host names are cut at dots, hyphens and digits, and each part into words by the
likeliest sequence under unigram counts (Viterbi). A multinomial naive Bayes over the words
of host and path gives the verdict where no rule fits. Its examples are the urls of the
table: a host that has one of SEEDS among its words is an example of block, any other of
allow, so words that go with the seeds count as evidence too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, written

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# words of hosts that are not wanted
SEEDS = (
    "adult ads bet bets casino cheap escort gambling lottery pills poker porn sex spam track viagra xxx"
).split()
#: Letters of a piece that is no known word; known words have their own length.
LONGEST = 20
_PARTS = re.compile(r"[^\W\d_]+")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.when(url.contains("://"), lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.when(url.contains("://"), F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def ruled(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits (host and path as one text) and its verdict, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of_host, of_path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(of_path)
        name, verdict = F.when(fits, of_host + of_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Words:
    """Logarithms of word shares, and that of the total for words never seen."""

    shares: dict[str, float]
    unseen: float

    def cost(self, word: str) -> float:
        known = self.shares.get(word)
        return -known if known is not None else self.unseen + 2.5 * len(word)


def segment(name: str, words: Words) -> tuple[str, ...]:
    """The likeliest split of a name into words; an unseen word costs by its length."""
    longer = {len(w) for w in words.shares if len(w) > LONGEST}
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        starts = [end - n for n in longer if n <= end and name[end - n : end] in words.shares]
        starts += range(max(0, end - LONGEST), end)
        best.append(min((best[start][0] + words.cost(name[start:end]), start) for start in starts))
    out, end = [], len(name)
    while end:
        out.append(name[best[end][1] : end])
        end = best[end][1]
    return tuple(reversed(out))


def split_urls(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(F.col("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))


def fit_words(urls: DataFrame) -> tuple[DataFrame, int]:
    """Unigram counts (word, count) and their total, of what is known to be words: parts of
    paths, and of host labels that hyphens or digits cut. A label in one piece may be several
    words and is not counted. The seeds are words too."""
    cut = F.filter(F.split("host", "\\."), lambda label: label.rlike("[-0-9]"))
    named = F.lower(F.concat_ws("/", F.array_join(cut, "/"), "path"))
    parts = F.regexp_extract_all(named, F.lit("\\p{L}+"), F.lit(0))
    counts = written(urls.select(F.explode(parts).alias("word")).groupBy("word").count(), "words")
    total = (counts.agg(F.sum("count")).first()[0] or 0) + len(SEEDS)
    # a seed is at least as likely as a word of one in ten thousand
    seeds = urls.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, SEEDS))).alias("word"), F.lit(1 + total // 10_000).cast("long").alias("count")
    )
    return counts.union(seeds).groupBy("word").agg(F.max("count").alias("count")), total


def _parts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (i, kind, name)
            for i, host, path in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for kind, text in (("host", host), ("path", path.lower()))
            for name in _PARTS.findall(text)
        ]
        kinds = {"id": pa.int64(), "kind": pa.string(), "name": pa.string()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds.values())], list(kinds)
        )


def _segmented(batches: Iterable[pa.RecordBatch], total: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for name, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shares = {k["word"]: math.log(k["count"] / total) for k in known or ()}
            found.append(segment(name, Words(shares, math.log(total))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["name", "words"])


def segmented(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """name, words of each of the names (name), which are distinct.

    A name meets the known words among its pieces by digests in Spark, so the vocabulary is
    nowhere held whole. Words that only share a digest do not occur in the name and are
    without effect.
    """
    lengths = sorted(r[0] for r in words.select(F.length("word")).distinct().collect())
    names = names.select("name", F.xxhash64("name").alias("key"))
    room = F.length("name") - F.col("at")
    pieces = (
        names.select("name", "key", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("at"))
        .select("name", "key", "at", F.explode(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= room)).alias("n"))
        .select("key", F.xxhash64(F.substring("name", F.col("at") + 1, F.col("n"))).alias("digest"))
    )
    known = (
        pieces.join(words.select("word", "count", F.xxhash64("word").alias("digest")), "digest")
        .groupBy("key")
        .agg(F.collect_set(F.struct("word", "count")).alias("known"))
    )
    return (
        names.join(known, "key", "left")
        .select("name", "known")
        .mapInArrow(partial(_segmented, total=total), "name string, words array<string>")
    )


def fit_bayes(parts: DataFrame, names: DataFrame, urls: int) -> tuple[float, DataFrame]:
    """Logarithms of allow over block: the prior, and the weight of each kind and name.

    The weight of a name is the sum over its words. Decimals add up to the same whatever
    the order, so equal urls get equal verdicts.
    """
    seeded = names.where(F.arrays_overlap("words", F.array(*map(F.lit, SEEDS)))).select("name")
    blocks = written(parts.where("kind = 'host'").join(seeded, "name", "left_semi").select("id").distinct(), "blocks")
    blocked = blocks.count()
    block = F.coalesce("block", F.lit(0))
    used = (
        parts.join(blocks.withColumn("block", F.lit(1)), "id", "left")
        .groupBy("kind", "name")
        .agg(F.sum(block).alias("block"), F.sum(1 - block).alias("allow"))
    )
    tokens = written(used.join(names, "name").withColumn("word", F.explode("words")).drop("words"), "tokens")
    counts = written(tokens.groupBy("kind", "word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "counts")
    many, of_block, of_allow = counts.agg(F.count("*"), F.sum("block"), F.sum("allow")).first()
    of_block, of_allow = (of_block or 0) + many + 1, (of_allow or 0) + many + 1
    ratio = F.log((F.col("allow") + 1) / of_allow) - F.log((F.col("block") + 1) / of_block)
    weights = (
        tokens.select("kind", "name", "word")
        .join(counts.select("kind", "word", ratio.cast("decimal(20,15)").alias("weight")), ["kind", "word"])
        .groupBy("kind", "name")
        .agg(F.sum("weight").alias("weight"))
    )
    return math.log((urls - blocked + 1) / (blocked + 1)), weights


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of pages (page_id, url, any others).

    A null url, or one without "://", has an empty host and path, fits no rule and has no
    words, so the larger class decides. rule is null where none fits. Rows that repeat and
    rows with a null page_id are judged like any other. A path that is empty fits no rule,
    because every rule's path starts with a slash.
    """
    urls = written(split_urls(pages).withColumn("id", F.monotonically_increasing_id()), "urls")
    parts = urls.select("id", "host", "path").mapInArrow(_parts_of, "id long, kind string, name string")
    parts = written(parts, "parts")
    words, total = fit_words(urls)
    names = written(segmented(parts.select("name").distinct(), words, total), "names")
    prior, weights = fit_bayes(parts, names, urls.count())
    scores = parts.join(weights, ["kind", "name"]).groupBy("id").agg(F.sum("weight").alias("score"))
    score = F.lit(prior).cast("decimal(20,15)") + F.coalesce("score", F.lit(0))
    judged = F.when(score < 0, "block").otherwise("allow")
    rule, verdict = ruled(F.col("host"), F.col("path"))
    return urls.join(scores, "id", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict")
    )
