"""Benchmark decontamination by spaced-seed hashing (native).

Texts become tokens (lower case, marks between words dropped).  Every window of a text
is hashed under fixed masks that ignore some of its positions, so that a
window still hits when a word at an ignored position was substituted.  The masks
leave no gap: wherever the substitutions lie that ``SAME_PCT`` allows in a stretch,
one mask fits between them somewhere (tests enumerate all placements).  Hits
with the benchmark's hashes give (item, diagonal): the item laid over the text
where the windows meet.  Along that diagonal all words are compared, and the
text overlaps the item if some stretch of ``STRETCH`` item words (or the whole
item, if shorter) has at least ``SAME_PCT`` percent equal words.

The benchmark's hashes are a written table of (item, place, seed).  A bit set of at
most ``MOST_BITS`` passes over nearly all windows where they are made; the others
are looked up in the seeds, which are broadcast up to ``MAX_SEEDS`` rows of fixed
length; beyond, the windows' hashes (without their texts) are shuffled to them and
the texts with a hit are read again.  The words of the items are joined to the hits
afterwards: broadcast while all items together have at most ``MAX_WORDS`` words,
shuffled beyond.  The texts are read once, or twice, whatever the benchmark's size.

Defined results: null, empty and wordless texts and items overlap nothing;
items of fewer than ``SEEDED`` words are looked up as they stand, if they
have at least ``MIN_ITEM`` words (shorter ones say too little and match
nothing); repeated rows are each reported; further columns are carried through.
"""

from __future__ import annotations

import json
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import fresh, let, small_side, text_key, written

#: Fixed masks of weight 5: positions marked 1 are hashed, the others ignored.  Together
#: they miss no placement of the substitutions in stretches of SEEDED to STRETCH words.
MASKS = ("111011", "11001011", "11111")
#: Items of so many words are hashed under the masks, shorter ones whole.
SEEDED = 9
#: A mask of positions that all masks hash: tested first, as it is cheaper to hash.
CORE = "11001"
STRETCH = 20
SAME_PCT = 80
MIN_ITEM = 5
MAX_SEEDS, MAX_WORDS = 500_000, 4_000_000
BETWEEN = r"""[\x20\x09-\x0D.,;:!?"'()\[\]{}<>|*#$%&_-]+"""
#: Bits of the filter for each seed, and the least and most of them all (8 MB).
BITS_A_SEED, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 26


def tokens(text: Column) -> Column:
    """Hashes of the words of a text."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN)
    return F.transform(F.filter(found, lambda w: w != ""), lambda w: F.xxhash64(w))


def _window(h: Column, i: Column, mask: str) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(h, i + k) for k, m in enumerate(mask) if m == "1"])


def seeds(h: Column, masks: list[str]) -> Column:
    """array<struct<p, seed>> of all windows under all masks."""
    spans = sorted({len(m) for m in masks})
    parts = []
    for span in spans:
        own = [m for m in masks if len(m) == span]
        at = F.sequence(F.lit(0), F.size(h) - span)
        rows = F.flatten(F.transform(at, lambda i: F.array(
            *[F.struct(i.alias("p"), _window(h, i, m).alias("seed")) for m in own])))
        parts.append(F.when(F.size(h) >= span, rows).otherwise(F.array().cast("array<struct<p:int,seed:bigint>>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _bits(seeds_of: DataFrame) -> tuple[int, DataFrame]:
    """A bit set of the seeds' hashes modulo n: (n, one row with the n bits as an array of longs)."""
    n, count = LEAST_BITS, seeds_of.count()
    while n < min(BITS_A_SEED * count, MOST_BITS):
        n *= 2
    at = F.pmod("seed", F.lit(n))
    words = seeds_of.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy(
        "word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    every = seeds_of.sparkSession.range(n // 64).join(words, F.col("id") == F.col("word"), "left")
    return n, every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("b")))),
                                    lambda x: x["b"]).alias("bits"))  # MOST_BITS at most


def _may_hit(table: DataFrame, short: list[str]):
    """Columns that hold the bit sets, and a test (h, i) whether a window that
    begins at ``i`` can be among the seeds (at the text's end it also holds for
    some that can't)."""
    n, bits = _bits(table)
    core_n, core_bits = _bits(table.filter("core is not null").select(F.col("core").alias("seed")))

    def among(h: Column, i: Column, mask: str, n: int, bits: str) -> Column:
        return let(F.pmod(_window(h, i, mask), F.lit(n)), lambda at: F.getbit(
            F.get(F.col(bits), F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)

    def test(h: Column, i: Column) -> Column:
        whole = [among(h, i, m, n, "_bits") for m in MASKS]
        out = among(h, i, CORE, core_n, "_core") & reduce(lambda a, b: a | b, whole)
        for m in short:
            out = out | among(h, i, m, n, "_bits")
        return out

    return {"_bits": bits.scalar(), "_core": core_bits.scalar()}, test


def _best(same: Column) -> Column:
    """Most equal words in a stretch of STRETCH words, as struct(equal, of)."""
    n = F.size(same)
    w = F.least(n, F.lit(STRETCH))
    counts = F.transform(F.sequence(F.lit(0), n - w),
                         lambda s: F.aggregate(F.slice(same, s + 1, w), F.lit(0), lambda a, x: a + x))
    return F.struct(F.array_max(counts).alias("equal"), w.alias("of"))


def overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text: str = "text",
             item_id: str = "item_id", max_seeds: int = MAX_SEEDS,
             max_words: int = MAX_WORDS) -> DataFrame:
    """Rows (doc: the document's columns but its text as a struct, doc_key, item,
    at, equal, of): one for each diagonal along which a document overlaps an item;
    ``at`` is the text's word that the item's first word lies on."""
    items = benchmark.select(F.col(item_id).alias("item"), tokens(F.col(item_text)).alias("words"))
    short = sorted({r[0] for r in items.select(F.size("words").alias("n")).filter(
        F.col("n").between(MIN_ITEM, SEEDED - 1)).distinct().collect()})  # at most SEEDED numbers
    masks = [*MASKS, *("1" * n for n in short)]
    own = F.when(F.size("words") >= SEEDED, let(F.col("words"), partial(seeds, masks=list(MASKS))))
    for n in short:
        own = own.when(F.size("words") == n, let(F.col("words"), partial(seeds, masks=["1" * n])))
    items = written(items.filter(F.size("words") >= MIN_ITEM).withColumn("item_no", F.xxhash64("words")), "benchmark-items")
    table = written(items.dropDuplicates(["words"]).select("item_no", "words", F.explode(own).alias("x")).select(
        "item_no", F.col("x.p").alias("ip"), F.col("x.seed").alias("seed"),
        F.when(F.size("words") >= SEEDED, _window(F.col("words"), F.col("x.p"), CORE)).alias("core")), "benchmark-seeds")
    sets, may_hit = _may_hit(table, masks[len(MASKS):])
    text = docs.select(F.struct(*[c for c in docs.columns if c != text_col]).alias("doc") if len(docs.columns) > 1
                       else F.struct(F.lit(None).cast("string").alias("_")).alias("doc"),
                       text_key(F.col(text_col)).alias("doc_key"), tokens(F.col(text_col)).alias("h"))
    near = text.withColumns(sets).withColumn("p", let(F.col("h"), lambda h: F.filter(
        F.sequence(F.lit(0), F.size(h) - 1), lambda i: may_hit(h, i))))
    near = near.drop(*sets).filter(F.size("p") > 0).withColumn("p", F.explode("p"))
    windows = near.select("doc", "doc_key", "h", "p", F.explode(let(F.struct("h", "p"), lambda x: F.array(
        *[F.when(F.size(x["h"]) - x["p"] >= len(m), _window(x["h"], x["p"], m)) for m in masks]))).alias("w"))
    own_seeds, at = table.drop("core"), (F.col("p") - F.col("ip")).alias("at")
    if table.count() <= max_seeds:
        hit = windows.join(F.broadcast(own_seeds), F.col("w") == F.col("seed")).select("doc", "doc_key", "h", "item_no", at)
    else:
        found = windows.select("doc_key", "p", "w").join(own_seeds, F.col("w") == F.col("seed"))
        hit = text.join(found.select("doc_key", "item_no", at).distinct(), "doc_key")
    total = items.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    hit = hit.join(F.broadcast(items) if total <= max_words else items, "item_no")
    same = let(F.col("h"), lambda h: let(F.col("words"), lambda ws: F.transform(ws, lambda x, j: F.when(
        (j + F.col("at") >= 0) & (F.get(h, F.greatest(j + F.col("at"), F.lit(0))) == x), 1).otherwise(0))))
    hit = hit.withColumn("best", let(same, _best)).filter(
        100 * F.col("best.equal") >= SAME_PCT * F.col("best.of"))
    out = hit.select("doc", "doc_key", "item", "at", "best.equal", "best.of")
    return out.groupBy("doc", "doc_key", "item", "at").agg(F.max("equal").alias("equal"), F.max("of").alias("of"))


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The keys of the texts that overlap an item."""
    return overlaps(docs.select(text_col), benchmark, text_col, **options).select("doc_key").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that overlap no item, with their own columns."""
    (key,) = fresh(docs.columns, "_doc_key")
    bad = written(contaminated(docs, benchmark, text_col, **options), "contaminated").withColumnRenamed("doc_key", key)
    return docs.join(small_side(bad), text_key(docs[text_col]) == F.col(key), "left_anti")
