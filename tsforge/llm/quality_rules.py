"""Quality rules: cross-document line frequency (native).

Lines are normalised (lower case, digits to ``0``, white space collapsed) and
hashed.  Per host (``host_col``) the distinct documents of each line are
counted, a line above the limits is removed, and a document that is depleted
by the removals, or fails the word rules, is rejected.

A line is removed when more than ``max_docs`` distinct documents of a host hold
it.  Copies are one document.  Near copies are one document too: what is left
of a document without the frequent lines, and without lines that were changed
in a place where most documents have a frequent line, names the document
(:func:`_marked`).  So a group of near copies isn't taken for boilerplate, and a
block of boilerplate is found however many lines it has.

Texts are split into line hashes once; everything after reads these lists.
Counts are partial aggregations over (host, line) keys and copies are combined
before the first shuffle, so a host, line or text that holds a third of all
rows leaves one row per task.

Defined results: null, empty or wordless texts have no words and are rejected;
repeated rows count as copies; a null host is a host of its own; an empty table
gives an empty result; further columns are carried through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import WORD, discard, fresh, let, small_side, text_key, words, written

MAX_DOCS = 20
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document is depleted when the removals leave fewer words, or a smaller share of them.
MIN_WORDS_LEFT = 30
MIN_SHARE_LEFT_PCT = 30


#: Up to so many repeated windows are looked up one by one, more of them by sorting.
_FEW = 64


def _windows_repeated(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text."""
    none = F.lit(0).cast("long")

    def covered(positions: Column) -> Column:
        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
            return F.aggregate(steps, none, lambda a, x: a + x)

        return let(F.sort_array(positions), total)

    def by_sorting(h: Column) -> Column:
        order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(order, lambda s: covered(F.transform(
            F.filter(s, lambda x, k: F.coalesce((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"]), F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))

    def by_lookup(h: Column, twice: Column) -> Column:
        return covered(F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)),
                                lambda i: i.isNotNull()))

    def repeated(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1) == x, F.lit(False)))))
        return let(twice, lambda d: F.when(F.size(d) == 0, none).when(F.size(d) <= _FEW, by_lookup(h, d)).otherwise(
            by_sorting(h)))

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                         lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, none).otherwise(let(hashes, repeated))


def text_stats(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), all long."""
    t = F.coalesce(text, F.lit(""))
    worded = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    by_words = let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
        _windows_repeated(w).alias("r")))
    return let(by_words, lambda b: F.struct(
        b["n"].alias("n_words"), b["chars"].alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        b["r"].alias("n_repeat_words")))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PCT * s["n_words"])


def normal_text(text: Column) -> Column:
    """Lower case, digits as 0, all white space but the line ends as blanks."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.when(t.rlike("[1-9]"), F.regexp_replace(t, "[1-9]", "0")).otherwise(t)
    return F.when(t.rlike(r"[\t\x0b\x0c\r]"), F.regexp_replace(t, r"[\t\x0b\x0c\r]", " ")).otherwise(t)


def _collapsed(line: Column) -> Column:
    one = F.trim(line)
    return F.when(F.instr(one, "  ") > 0, F.regexp_replace(one, " +", " ")).otherwise(one)


def _line_lists(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """The distinct texts of each host: host, doc (key of the text), a (its lines
    with a word: hash h, words n).  Copies are combined before the shuffle."""
    lines = F.transform(F.split(normal_text(F.col(text_col)), "\n", -1), _collapsed)
    hashed = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.struct(
        F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))
    rows = docs.select(F.col(host_col).alias("host"), text_key(F.col(text_col)).alias("doc"), hashed.alias("a"))
    return written(rows.groupBy("host", "doc").agg(F.first("a").alias("a")), "lines")


def _on_line(rows: DataFrame, table: DataFrame, how: str, line: str = "h") -> DataFrame:
    """``rows`` joined with a written table of lines (host, h, ..) on host and ``line``."""
    side = small_side(table.withColumnsRenamed({"host": "_host", "h": "_h"}))
    same = rows["host"].eqNullSafe(F.col("_host")) & (rows[line] == F.col("_h"))
    return rows.join(side, same, how).drop("_host", "_h")


def _with_places(texts: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """``texts`` with the array of their places (host, doc, i) as ``name``."""
    found = places.groupBy(F.col("host").alias("_host"), F.col("doc").alias("_doc")).agg(F.collect_set("i").alias(name))
    same = texts["host"].eqNullSafe(F.col("_host")) & (texts["doc"] == F.col("_doc"))
    return texts.join(found, same, "left").drop("_host", "_doc").withColumn(
        name, F.coalesce(name, F.array().cast("array<int>")))


def _marked(lists: DataFrame, max_docs: int) -> DataFrame:
    """The texts that hold a line of more than ``max_docs`` texts of their host, with
    ``hits`` (the places of such lines) and ``sig`` (a hash of their remaining lines).

    In a group of near copies all lines are such lines but the ones that were
    changed.  A changed line stands next to a line after (or before) which most
    texts have one of the frequent lines; it doesn't count as a remaining line, so
    near copies have one signature.  Texts with lines of their own differ in theirs.
    """
    each = lists.select("host", F.explode(F.array_distinct(F.transform("a", lambda x: x["h"]))).alias("h"))
    often = written(each.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs")).filter(
        F.col("n_docs") > max_docs).select("host", "h"), "lines-often")
    rows = lists.select("host", "doc", F.posexplode("a").alias("i", "l")).select("host", "doc", "i", "l.h")
    hits = _on_line(rows, often, "left_semi")
    texts = written(_with_places(lists, hits, "hits").filter(F.size("hits") > 0), "lines-marked")

    # lines beside a hit: which line they stand beside, on which side, and whether they are hits themselves
    def beside(step: int):
        return lambda x, i: F.when(F.array_contains("hits", i + step), F.struct(
            i.alias("i"), F.lit(step).alias("side"), F.get("a", i + step)["h"].alias("h"),
            F.array_contains("hits", i).alias("hit")))

    both = F.array_compact(F.concat(*[F.transform("a", beside(s)) for s in (-1, 1)]))
    near = texts.select("host", "doc", F.explode(both).alias("b")).select("host", "doc", "b.*")
    settled = written(near.groupBy("host", "side", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("long")).alias("k")).filter(2 * F.col("k") > F.col("n")).select(
        "host", "h", F.col("side").alias("at")), "lines-settled")
    changed = _on_line(near.filter(~F.col("hit")), settled, "inner").filter(F.col("side") == F.col("at"))
    out = _with_places(texts, changed.select("host", "doc", "i"), "changed")
    rest = F.filter("a", lambda x, i: ~F.array_contains("hits", i) & ~F.array_contains("changed", i))
    return written(out.withColumn("sig", F.xxhash64(F.transform(rest, lambda x: x["h"]))).drop("changed"), "lines-signed")


def _common(texts: DataFrame, max_docs: int) -> DataFrame:
    hit = F.array_distinct(F.transform("hits", lambda i: F.get("a", i)["h"]))
    votes = texts.select("host", "sig", F.explode(hit).alias("h")).distinct()
    return votes.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > max_docs)


def common_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                 max_docs: int = MAX_DOCS) -> DataFrame:
    """The lines above the limit: host, h, n_docs (distinct documents; near copies are one)."""
    return _common(_marked(_line_lists(docs, text_col, host_col), max_docs), max_docs)


def depleted(docs: DataFrame, text_col: str = "text", host_col: str = "source",
             max_docs: int = MAX_DOCS) -> DataFrame:
    """The texts (host, doc) that the removal of common lines depletes, with words_left; a written table."""
    lists = _line_lists(docs, text_col, host_col)
    texts = _marked(lists, max_docs)
    common = written(_common(texts, max_docs).select("host", "h"), "lines-common")
    hit = F.transform("hits", lambda i: F.get("a", i))
    lost = _on_line(texts.select("host", "doc", F.explode(hit).alias("x")).select("host", "doc", "x.*"), common, "left_semi")
    lost = lost.groupBy(F.col("host").alias("_host"), F.col("doc").alias("_doc")).agg(F.sum("n").alias("lost"))
    total = F.aggregate("a", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    both = texts.select("host", "doc", total.alias("total")).join(
        lost, texts["host"].eqNullSafe(F.col("_host")) & (texts["doc"] == F.col("_doc")))
    left = F.col("total") - F.col("lost")
    gone = written(both.filter((left < MIN_WORDS_LEFT) | (100 * left < MIN_SHARE_LEFT_PCT * F.col("total"))).select(
        "host", "doc", left.alias("words_left")), "depleted")
    discard(lists, texts, common)
    return gone


def apply_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with ``quality`` struct(the five statistics, base_failed, depleted, kept)."""
    stats, key, h, k, out = fresh(docs.columns, "_stats", "_key", "_lhost", "_ldoc", "quality")
    gone = depleted(docs, text_col, host_col, max_docs).select(F.col("host").alias(h), F.col("doc").alias(k))
    left = docs.withColumn(key, text_key(F.col(text_col))).withColumn(stats, text_stats(F.col(text_col)))
    both = left.join(small_side(gone), left[host_col].eqNullSafe(F.col(h)) & (left[key] == F.col(k)), "left")
    failed, empty = base_failed(F.col(stats)), F.col(k).isNotNull()
    return both.select(*docs.columns, F.struct(f"{stats}.*", failed.alias("base_failed"), empty.alias("depleted"),
                                               (~failed & ~empty).alias("kept")).alias(out))


def accepted(docs: DataFrame, text_col: str = "text", host_col: str = "source",
             max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    key, h, k = fresh(docs.columns, "_key", "_lhost", "_ldoc")
    gone = depleted(docs, text_col, host_col, max_docs).select(F.col("host").alias(h), F.col("doc").alias(k))
    good = docs.filter(~let(text_stats(F.col(text_col)), base_failed)).withColumn(key, text_key(F.col(text_col)))
    same = good[host_col].eqNullSafe(F.col(h)) & (good[key] == F.col(k))
    return good.join(small_side(gone), same, "left_anti").select(*docs.columns)
