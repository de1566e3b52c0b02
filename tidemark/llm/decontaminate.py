"""Benchmark passages in documents: exact weighted overlap of every item-sized window.

A SimHash radius cannot give whole results here. Windows are bags of shingles, and a run of one
repeated shingle turns a fingerprint whatever else agrees, so pairs of similarity 0.8 lie beyond
any radius that still selects. The overlap of all windows is computed instead, without cutting
one: an occurrence of a shingle counts for a range of window starts, so the overlap is a running
sum over the ends of these ranges.

Only DataFrame functions: the shingles of a document are one array of 64-bit digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES

SHINGLE = 5
SIMILARITY = 0.8
#: Items' shingles are broadcast up to this many rows (about 32 MB); more are shuffled.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII white space; none for null."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SPACES)
    return F.filter(parts, lambda w: w != "")


def bound(value: Column, use) -> Column:
    """use(value), with value computed once: a lambda would compute it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles_of(words: Column, size: int) -> Column:
    """Digests of all runs of `size` words, in order; none if there are fewer words.

    Below SHINGLE words a run stands for a whole item and has a digest of its own kind.
    """

    def digest(w: Column, i: Column) -> Column:
        kind = [] if size == SHINGLE else [F.lit("short")]
        return F.xxhash64(*kind, *[F.get(w, i + k) for k in range(size)])

    return bound(
        words,
        lambda w: F.when(
            F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: digest(w, i))
        ).otherwise(F.array().cast("array<bigint>")),
    )


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, size (words of a shingle), item (its shingle digests) of items with words."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    size = F.least(F.size("words"), F.lit(SHINGLE))
    item = shingles_of(F.col("words"), SHINGLE)
    for n in range(1, SHINGLE):
        item = F.when(size == n, shingles_of(F.col("words"), n)).otherwise(item)
    return words.select("item_id", size.alias("size"), item.alias("item"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast only if it was counted to have at most that many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def overlaps(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """doc_id, item_id, start, common, length: the weight that an item has in common with the
    windows of a document, at each start where it changes.

    Of the occurrences of a shingle inside a window, as many count as the item has, the last
    ones. So an occurrence at p counts for starts up to p, unless as many later ones are inside
    too; rows grow with the shingles that a document shares with an item, not with its windows.
    """
    known = (
        items.where(F.col("size") == size)
        .select("item_id", F.size("item").alias("length"), F.explode("item").alias("digest"))
        .groupBy("item_id", "length", "digest")
        .agg(F.count(F.lit(1)).cast("int").alias("wanted"))
    )
    # shared shingles are put together per document before they meet the items
    places = (
        docs.select("doc_id", "part", shingles_of(words_of(F.col("text")), size).alias("all"))
        .select("doc_id", "part", F.size("all").alias("n"), F.posexplode("all").alias("at", "digest"))
        .join(small(known.select("digest").distinct(), BROADCAST_ROWS), "digest", "left_semi")
        .groupBy("doc_id", "part", "n", "digest")
        .agg(F.array_sort(F.collect_set("at")).alias("places"))
    )
    length, wanted, n = F.col("length"), F.col("wanted"), F.col("n")
    met = (
        places.join(small(known, BROADCAST_ROWS), "digest")
        .where(n >= length)
        .groupBy("doc_id", "part", "item_id", "length", "n")
        .agg(
            F.sum(F.least(F.size("places"), wanted)).alias("most"),
            F.collect_list(F.struct("wanted", "places")).alias("shared"),
        )
        .where(_reaches(F.col("most"), length))
        .select("doc_id", "part", "item_id", "length", "n", F.inline("shared"))
    )
    last = n - length

    def counted(p: Column, i: Column) -> Column:
        later = F.get("places", i + wanted)
        return F.struct(
            F.greatest(p - length + 1, F.lit(0)).alias("low"),
            F.least(p, last, F.coalesce(later - length, last)).alias("high"),
        )

    ranges = F.filter(F.transform("places", counted), lambda r: r.low <= r.high)
    steps = met.select("doc_id", "part", "item_id", "length", F.inline(ranges)).select(
        "doc_id",
        "part",
        "item_id",
        "length",
        F.inline(
            F.array(
                F.struct(F.col("low").alias("start"), F.lit(1).alias("step")),
                F.struct((F.col("high") + 1).alias("start"), F.lit(-1).alias("step")),
            )
        ),
    )
    along = Window.partitionBy("doc_id", "part", "item_id", "length").orderBy("start")
    return (
        steps.groupBy("doc_id", "part", "item_id", "length", "start")
        .agg(F.sum("step").alias("step"))
        .select("doc_id", "item_id", "start", F.sum("step").over(along).alias("common"), "length")
    )


def similarity(common: Column, length: Column) -> Column:
    """Common weight of two bags of one length over their joint weight."""
    return common / (length * 2 - common)


def _reaches(common: Column, length: Column) -> Column:
    return similarity(common, length) >= SIMILARITY


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start of documents that hold a benchmark passage.

    docs has doc_id and text, benchmark item_id and text. A document holds an item if a
    window of as many words has a shingle similarity of SIMILARITY or more (bags of five
    words; an item of fewer words is one shingle of its own length and must occur as it
    is). similarity is the best window's and start its first word, counted from zero, the
    first if several are as good. Null and empty texts and items hold nothing. Rows of one
    doc_id count together; rows with a null id are left out.
    """
    items = items_of(benchmark.select(F.col("item_id"), F.col("text").cast("string"))).where("item_id is not null")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("part"))
    if not sizes:
        return docs.select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("start")).limit(0)
    found = overlaps(docs, items, sizes[0])
    for size in sizes[1:]:
        found = found.union(overlaps(docs, items, size))
    scored = found.where(_reaches(F.col("common"), F.col("length"))).select(
        "doc_id", "item_id", "start", similarity(F.col("common"), F.col("length")).alias("similarity")
    )
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start"))).alias("best")
    return (
        scored.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.similarity", "best.start")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose document holds no benchmark passage."""
    found = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


#: contaminated() as DuckDB SQL over `documents` and `benchmark`.
SQL = r"""
with words as (
  select 'd' as kind, doc_id as id, regexp_extract_all(
    lower(text), '[^\x20\x09-\x0D]+') as w
  from documents where text is not null
  union all
  select 'b', item_id, regexp_extract_all(
    lower(text), '[^\x20\x09-\x0D]+')
  from benchmark where text is not null
), shingles as (
  select kind, id, len(w) - 4 as m, unnest(range(0, len(w) - 4)) as at,
    unnest([array_to_string(w[i + 1:i + 5], ' ') for i in range(0, len(w) - 4)]) as s
  from words where len(w) >= 5
), items as (
  select id as item_id, m, s, count(*) as n from shingles where kind = 'b' group by all
), starts as (
  select distinct d.id as doc_id, i.item_id, i.m, unnest(range(greatest(0, d.at - i.m + 1), least(d.at, d.m - i.m) + 1)) as start
  from shingles d join items i on d.s = i.s where d.kind = 'd'
), bags as (
  select t.doc_id, t.item_id, t.m, t.start, d.s, count(*) as n
  from starts t join shingles d on d.kind = 'd' and d.id = t.doc_id and d.at >= t.start and d.at < t.start + t.m
  group by all
), judged as (
  select b.doc_id, b.item_id, b.start, sum(least(b.n, i.n)) as common, any_value(b.m) as m
  from bags b join items i on i.item_id = b.item_id and i.s = b.s group by all
), scored as (
  select doc_id, item_id, start, common / (2 * m - common) as similarity from judged
)
select doc_id, item_id, max(similarity) as similarity,
  cast(arg_max(start, struct_pack(a := similarity, b := -start)) as integer) as start
from scored where similarity >= 0.8 group by doc_id, item_id
"""
