"""Secret scan with character Markov models (native).

Base spans come from three patterns.  Besides, every run of credential
characters of ``MIN_RUN`` or more outside them is scored by two first-order
character models: one of random strings, one of ordinary identifiers and
words.  A run is a secret when the log-likelihood ratio of the two exceeds
``THRESHOLD`` (the prior odds against a secret).

The models are trained from labelled samples of all documents: values in base
spans are random strings, other runs without a digit or without a letter are
ordinary.  Each different value counts once, so copies of a text weigh nothing.
Only the counts of (label, character pair) leave the executors: at most
2 x 68 x 68 rows.  The ratio grows with the run, so one threshold serves all lengths.

Positions are code points, end exclusive.  Spark finds matches without their
places, so a text is split at the matches and the lengths of gaps and matches
are summed up.

Defined results: a null or empty text has no spans; repeated rows get equal
spans; without any training sample the models are equal (uniform) and add no span.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import fresh, let

#: The base kinds with pattern, group that is measured, and its least length.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
}
ADDED = "random"
RUN_CHARS = "A-Za-z0-9+/_=-"
ALPHABET = "^ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
MIN_RUN = 12
#: Ordinary samples also take shorter runs.
MIN_SAMPLE = 8
THRESHOLD = math.log(1e4)
#: Pseudo-counts that a context shares among all characters by the label's character shares.
PRIOR = 40.0
_BLOCK = 256


def _offsets(lens: Column) -> Column:
    """Sums of the elements before each; by blocks, so that a text of very many matches stays cheap."""
    n = F.size(lens)
    add = lambda a, x: a + x
    zero = F.lit(0).cast("long")
    sums = F.transform(F.sequence(F.lit(0), F.ceil(n / _BLOCK).cast("int")),
                       lambda b: F.aggregate(F.slice(lens, b * _BLOCK + 1, F.lit(_BLOCK)), zero, add))
    heads = let(sums, lambda s: F.transform(s, lambda x, b: F.aggregate(F.slice(s, F.lit(1), b), zero, add)))
    return let(heads, lambda h: F.transform(lens, lambda x, i: F.get(h, F.floor(i / _BLOCK).cast("int")) + F.aggregate(
        F.slice(lens, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK), zero, add)))


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<s, kind, e, value>> of a pattern's matches whose group has ``least`` characters."""
    def build(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        lens = let(gaps, lambda g: F.transform(
            m, lambda x, i: F.struct(F.length(F.get(g, i)).cast("long").alias("gap"), F.length(x).alias("len"))))

        def place(ls: Column) -> Column:
            before = _offsets(F.transform(ls, lambda x: x["gap"] + x["len"]))
            values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else m
            return let(before, lambda b: let(values, lambda v: F.transform(ls, lambda x, i: F.struct(
                (F.get(b, i) + x["gap"]).alias("s"), F.lit(kind).alias("kind"),
                (F.get(b, i) + x["gap"] + x["len"]).alias("e"), F.get(v, i).alias("value")))))

        return let(lens, place)

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), build)
    kept = F.filter(found, lambda x: F.length(x["value"]) >= least)
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<s:bigint,kind:string,e:bigint,value:string>>"


def base_spans(text: Column) -> dict[str, Column]:
    return {k: spans_of(text, k, *spec) for k, spec in KINDS.items()}


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order listed."""
    rank = {k: i for i, k in enumerate([*KINDS, ADDED])}
    number = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    order = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.element_at(number, x["kind"]).alias("r"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"),
                                                                 x["e"].cast("string"))), ",")


def _run_pattern(least: int) -> str:
    return r"(?<![%s])[%s]{%d,}" % (RUN_CHARS, RUN_CHARS, least)


def _runs(text: Column, least: int) -> Column:
    return spans_of(text, ADDED, _run_pattern(least), 0, least)


def _outside(runs: Column, base: Column) -> Column:
    return F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["s"] < r["e"]) & (r["s"] < b["e"])))


def pair_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, pair, n): character pairs of the different labelled values; label 1: random."""
    part = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    part = part.withColumn("b", F.concat(*base_spans(F.col("t")).values()))
    apart = F.transform(_outside(_runs(F.col("t"), MIN_SAMPLE), F.col("b")), lambda x: x["value"])
    every = F.regexp_extract_all("t", F.lit(_run_pattern(MIN_SAMPLE)), F.lit(0))  # places matter beside base spans only
    part = part.select("b", F.when(F.size("b") > 0, apart).otherwise(every).alias("o"))
    ordinary = F.filter("o", lambda v: ~v.rlike("[0-9]") | ~v.rlike("[A-Za-z]"))
    labelled = F.concat(F.transform("b", lambda x: F.struct(F.lit(1).alias("label"), x["value"].alias("v"))),
                        F.transform(ordinary, lambda v: F.struct(F.lit(0).alias("label"), v.alias("v"))))
    runs = part.select(F.explode(labelled).alias("x")).select("x.*").distinct()
    chars = F.split(F.concat(F.lit("^"), F.col("v")), "")
    pairs = let(chars, lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - 1),
                                             lambda i: F.concat(F.get(c, i - 1), F.get(c, i))))
    return runs.filter(F.length("v") > 0).select("label", F.explode(pairs).alias("pair")).groupBy(
        "label", "pair").count()


def llr_table(counts: list[tuple[int, str, int]]) -> list[float]:
    """log P(second | first) as random less the same as ordinary, for every pair of ALPHABET."""
    k = len(ALPHABET)
    seen = {(lab, p[0], p[1]): n for lab, p, n in counts if len(p) == 2}
    ctx: dict[tuple[int, str], int] = {}
    one: dict[tuple[int, str], int] = {}
    for (lab, a, b), n in seen.items():
        ctx[lab, a] = ctx.get((lab, a), 0) + n
        one[lab, b] = one.get((lab, b), 0) + n
    total = {lab: sum(n for (x, _), n in one.items() if x == lab) for lab in (0, 1)}

    def logp(lab: int, a: str, b: str) -> float:
        share = (one.get((lab, b), 0) + 1) / (total[lab] + k)
        return math.log((seen.get((lab, a, b), 0) + PRIOR * share) / (ctx.get((lab, a), 0) + PRIOR))

    return [logp(1, a, b) - logp(0, a, b) for a in ALPHABET for b in ALPHABET]


def _llr(value: Column, table: Column) -> Column:
    k = len(ALPHABET)
    codes = F.transform(F.split(F.concat(F.lit("^"), value), ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(codes, lambda c: F.aggregate(
        F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0),
        lambda a, i: a + F.get(table, F.get(c, i - 1) * k + F.get(c, i))))


def scan(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets``: struct(n_assign, n_access, n_hex, base, spans), the last two joined strings."""
    counts = [tuple(r) for r in pair_counts(docs, text_col).collect()]  # 2 x 68 x 68 rows at most
    table = F.from_json(F.lit(json.dumps(llr_table(counts))), "array<double>")
    t, b, r, out = fresh(docs.columns, "_t", "_b", "_r", "secrets")
    found = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    found = found.withColumn(b, let(F.struct(*[c.alias(k) for k, c in base_spans(F.col(t)).items()]), lambda x: x))
    every = F.concat(*[F.col(f"{b}.{k}") for k in KINDS])
    added = let(every, lambda e: let(_outside(_runs(F.col(t), MIN_RUN), e), lambda runs: F.when(
        F.size(runs) > 0, F.filter(runs, lambda x: _llr(x["value"], table) > threshold)).otherwise(runs)))
    found = found.withColumn(r, added)
    return found.select(*docs.columns, F.struct(
        *[F.size(F.col(f"{b}.{k}")).cast("long").alias(f"n_{k}") for k in KINDS],
        let(every, _joined).alias("base"), let(F.concat(every, F.col(r)), _joined).alias("spans")).alias(out))
