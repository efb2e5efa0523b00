"""Quality classifier: a sparse rule ensemble.

Shallow boosted trees over text statistics give conjunctive rules (the paths to
all their nodes but the root); a lasso logistic regression on the rules keeps
few of them; those are compiled into one Spark column expression, so scoring
is a projection of the documents without Python, shuffle or broadcast.

The fit is on a hash sample of about ``MAX_ROWS`` labelled rows (a parameter of
the fit; every document is scored).  Only the sample's statistics reach the
driver.  Statistics read the whole text and nothing else.

Defined results: null and empty texts have zero statistics and get a score like
any other; a document with several labels counts once, with the majority
(ties: good); without labels the score is 0.5, with one class only it is that
class's smoothed share; repeated rows get equal scores.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import fresh, let, words

MAX_ROWS = 20_000
TREES, DEPTH, RATE = 24, 3, 0.3
LASSO = 0.0015
#: Cut points that a tree tries for each statistic.
CUTS = 24


def statistics(text: Column) -> Column:
    """struct of doubles."""
    t = F.coalesce(text, F.lit(""))
    n_chars = F.greatest(F.length(t), F.lit(1)).cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)).cast("double")

    def by_words(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        pairs = F.when(F.size(w) >= 3, F.size(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))) / (n - 2)).otherwise(1.0)
        return F.struct(F.log1p(F.size(w).cast("double")).alias("log_words"),
                        (F.size(F.array_distinct(w)) / n).alias("distinct_words"),
                        pairs.cast("double").alias("distinct_windows"),
                        (F.length(F.array_join(w, "")) / n).alias("word_chars"),
                        (count("[#*$%&]") / n).alias("symbols"), (count("[|<>]") / n).alias("bars"),
                        (count("!") / n).alias("bangs"), (count("[.?]") / n).alias("stops"),
                        (count("[A-Z]") / n_chars).alias("capitals"), (count("[0-9]") / n_chars).alias("digits"))

    def by_lines(ls: Column) -> Column:
        n = F.greatest(F.size(ls), F.lit(1)).cast("double")
        return F.struct(F.log1p(F.size(ls).cast("double")).alias("log_lines"),
                        (F.size(F.array_distinct(ls)) / n).alias("distinct_lines"),
                        (F.length(F.array_join(ls, "")) / n).alias("line_chars"))

    lines = F.filter(F.split(t, "\n", -1), lambda x: x != "")
    return let(F.struct(let(words(t), by_words).alias("w"), let(lines, by_lines).alias("l")),
               lambda x: F.struct(*[x["w"][c].alias(c) for c in STATS[:10]], *[x["l"][c].alias(c) for c in STATS[10:]]))


STATS = ["log_words", "distinct_words", "distinct_windows", "word_chars", "symbols", "bars", "bangs", "stops",
         "capitals", "digits", "log_lines", "distinct_lines", "line_chars"]

#: A rule is a tuple of (statistic, cut, above): all of them must hold.
Rule = tuple[tuple[str, float, bool], ...]


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, path: Rule, depth: int, out: list[Rule],
          pred: np.ndarray, least: int) -> None:
    """One regression tree on gradients; adds every node's path to ``out``."""
    best, total_g, total_h = (1e-9, None), g[rows].sum(), h[rows].sum()
    if depth and len(rows) >= 2 * least:
        for j in range(x.shape[1]):
            v = x[rows, j]
            cuts = np.unique(np.quantile(v, np.linspace(0.02, 0.98, CUTS), method="lower"))
            where = np.searchsorted(cuts, v, side="left")  # v <= cuts[k] for where <= k
            left_g = np.cumsum(np.bincount(where, g[rows], len(cuts) + 1))[:-1]
            left_h = np.cumsum(np.bincount(where, h[rows], len(cuts) + 1))[:-1]
            left_n = np.cumsum(np.bincount(where, minlength=len(cuts) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            gain[(left_n < least) | (len(rows) - left_n < least)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (j, float(cuts[k])))
    if best[1] is None:
        pred[rows] += RATE * total_g / (total_h + 1)
        return
    j, cut = best[1]
    above = x[rows, j] > cut
    for side, part in ((False, rows[~above]), (True, rows[above])):
        rule = (*path, (STATS[j], cut, side))
        out.append(rule)
        _grow(x, g, h, part, rule, depth - 1, out, pred, least)


def fit_rules(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with weights)."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = math.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return base, []
    pred, rules = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-pred))
        _grow(x, y - p, np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), (), DEPTH, rules, pred, max(5, len(y) // 400))
    rules = list(dict.fromkeys(tuple(sorted(r)) for r in rules))
    on = np.stack([np.all([(x[:, STATS.index(s)] > c) == a for s, c, a in r], axis=0) for r in rules], 1).astype(float)
    _, first = np.unique(on, axis=1, return_index=True)  # rules that hold for the same rows count once
    first = np.sort(first)
    rules, on = [rules[i] for i in first], on[:, first]
    # accelerated proximal gradient
    n, k = on.shape
    step = 4 * n / max(np.linalg.norm(np.c_[np.ones(n), on], 2) ** 2, 1e-9)
    w, b, vw, vb, t = np.zeros(k), base, np.zeros(k), base, 1.0
    for _ in range(600):
        r = 1 / (1 + np.exp(-(vb + on @ vw))) - y
        nw, nb = vw - step * (on.T @ r) / n, vb - step * r.mean()
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * LASSO, 0)
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return float(b), [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6]


def compiled(intercept: float, rules: list[tuple[Rule, float]], stats: Column) -> Column:
    """The score as a column expression over the struct of statistics."""
    total = F.lit(intercept)
    for rule, weight in rules:
        holds = F.lit(True)
        for s, cut, above in rule:
            holds = holds & ((stats[s] > cut) if above else (stats[s] <= cut))
        total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS) -> tuple[float, list[tuple[Rule, float]]]:
    """Rules from the documents that ``labels`` (id, label) marks."""
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg((F.avg(F.col(label_col)) >= 0.5).cast("double").alias("y"))
    total = marked.count()
    share = min(1.0, max_rows / max(1, total))
    sample = marked.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about max_rows pairs of numbers: a proven bound
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(sample), "id")
    got = rows.select("id", "y", statistics(F.col("t")).alias("s")).select(
        "id", "y", *[F.col("s")[c].alias(c) for c in STATS]).dropDuplicates(["id"]).collect()
    got.sort(key=lambda r: r["id"])  # the same fit whatever order the rows came in
    x = np.array([[r[c] for c in STATS] for r in got], dtype=float).reshape(-1, len(STATS))
    return fit_rules(x, np.array([r["y"] for r in got], dtype=float))


def score(docs: DataFrame, model: tuple[float, list[tuple[Rule, float]]], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1."""
    s, out = fresh(docs.columns, "_stats", "score")
    return docs.withColumn(s, let(statistics(F.col(text_col)), lambda x: x)).withColumn(
        out, let(F.col(s), lambda x: compiled(*model, x))).drop(s)
