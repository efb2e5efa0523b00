"""Personal data by weak supervision.

Candidate spans come from broad patterns.  Labelers that read the form of a
span (regular rules), word lists (gazetteer) and its surroundings (context)
vote for or against, or abstain.  Expectation-maximisation estimates how
reliable each labeler is from the votes alone, and a logistic span classifier
is trained on the resulting probabilities; it reads the votes and the form of
a span.  Spans of the strict base patterns always stay; the classifier adds
the other candidates that it takes for personal data.

Spark counts the patterns (kind, votes, form) over all texts; only these
counts reach the driver: kinds x 3^labelers x forms rows at most.  A second
pass applies the classifier to every whole text.  All patterns run in time
linear in the text.

Positions are code points, end exclusive.  Defined results: null and empty
texts have no spans; where two candidates overlap, base spans win, then the
longer one, then the earlier one; repeated rows get equal spans; an empty table
trains nothing and gives an empty result; further columns are carried through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import fresh, slices

KINDS = ("email", "ip", "card", "phone")
#: Log odds from which the classifier adds a span (a probability of 0.8).
LEAST_LOGIT = math.log(4)

# Fixed values of the base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Broader candidates: written-out e-mail addresses, numbers in national form.
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{1,63}"
                      r"(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]{1,63}){1,8}")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z.-])")

_ENDINGS = frozenset("com org net edu gov info biz io co uk de fr es it nl eu ch at us ca au jp br in".split())
_PREFIXES = tuple("34 37 4 51 52 53 54 55 6011 65".split())
_RESERVED = re.compile(r"(?:0|10|127|169\.254|192\.168|2[2-5][0-9])\.")
_FOR = {
    "email": re.compile(r"mail|contact|write|correo|courriel|kontakt|reach"),
    "ip": re.compile(r"\bip\b|host|server|address|login|adresse"),
    "card": re.compile(r"card|visa|master|credit|payment|tarjeta|carte|karte"),
    "phone": re.compile(r"phone|\btel|call|mobil|fax|cell|llam|anruf|appel"),
}
_AGAINST = re.compile(r"version|order|invoice|isbn|issn|serial|total|price|page|chapter|section|release|sku|\bno\.|[$€£]\s*$")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: '@' isn't a local character, so a match starts with the run before one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def strict(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, passes): matches of the base patterns, kept or dropped."""
    out = [("email", s, e, True) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        out.append(("ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            if 13 <= len(d):
                out.append(("card", m.start(), m.end(), len(d) <= 19 and _luhn(d)))
    for m in _PHONE.finditer(text):
        out.append(("phone", m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15))
    return out


def _quiet(text: str) -> bool:
    """No character that a candidate needs."""
    return not (_ANY.search(text) or "[at]" in text or "(at)" in text or "[AT]" in text or "(AT)" in text)


_ANY = re.compile("[0-9@]")


def candidates(text: str) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
    """(kind, start, end, base, pattern): pattern is the votes (1 for, 0 against, -1
    abstains) of form, gazetteer, context before, context after, shape; then the
    length class and whether the span was found by a base pattern."""
    if not text or _quiet(text):
        return []
    found = strict(text)
    kept = sorted((s, e) for _, s, e, ok in found if ok)
    spans = {(k, s, e): ok for k, s, e, ok in found}
    for kind, pattern in (("email", _SPELLED), ("phone", _NATIONAL)):
        for m in pattern.finditer(text):
            spans.setdefault((kind, m.start(), m.end()), False)
    out, at = [], 0
    for (kind, s, e), ok in sorted(spans.items(), key=lambda x: x[0][1]):
        if not ok:  # overlaps a base span: nothing to add
            while at < len(kept) and kept[at][1] <= s:
                at += 1
            if at < len(kept) and kept[at][0] < e:
                continue
        out.append((kind, s, e, ok, _votes(text, kind, s, e, ok)))
    return out


def _votes(text: str, kind: str, s: int, e: int, ok: bool) -> tuple[int, ...]:
    span = text[s:min(e, s + 200)]
    before, after = text[max(0, s - 40) : s].lower(), text[e : e + 20].lower()
    digits = _digits(span)
    form = 1 if ok else 0 if kind in ("ip", "card") else -1
    if kind == "email":
        lists = 1 if re.split(r"[\s.\[\]()]+", span.lower().rstrip("])"))[-1] in _ENDINGS else -1
    elif kind == "ip":
        lists = 0 if _RESERVED.match(span) else -1
    elif kind == "card":
        lists = 1 if digits.startswith(_PREFIXES) else 0
    else:
        lists = 1 if span.startswith("+") else -1
    left = 1 if _FOR[kind].search(before) else 0 if _AGAINST.search(before) else -1
    touches = (s and (text[s - 1].isalnum() or text[s - 1] in "_-/.=")) or (after[:1].isalnum() or after[:1] in ("_", "=", "/"))
    right = 0 if touches else -1  # standing free says nothing
    shape = 0 if kind != "email" and len(set(digits)) <= 2 else -1
    return form, lists, left, right, shape, min(3, (e - s) // 8), int(ok)


LABELERS = 5


def reliabilities(rows: list[tuple[str, tuple[int, ...], int]], rounds: int = 100):
    """EM over (kind, votes, count).  Per kind the share of personal data, and per
    kind and labeler the chance to vote right (given a vote) in either class."""
    out = {}
    for kind in KINDS:
        own = [(v[:LABELERS], n) for k, v, n in rows if k == kind]
        if not own:
            out[kind] = (0.5, [(0.7, 0.7)] * LABELERS)
            continue
        votes, n = np.array([v for v, _ in own]), np.array([c for _, c in own], dtype=float)
        score = (votes == 1).sum(1) - (votes == 0).sum(1)
        p = np.where(score > 0, 0.8, np.where(score < 0, 0.2, 0.5))
        for _ in range(rounds):
            # two pseudo-votes each way keep labelers better than a coin and away from 0 and 1
            share = (n @ p + 1) / (n.sum() + 2)
            hit, rej = [], []
            for j in range(LABELERS):
                yes, no = votes[:, j] == 1, votes[:, j] == 0
                hit.append(max(0.55, (n[yes] @ p[yes] + 1.4) / (n[yes | no] @ p[yes | no] + 2)))
                rej.append(max(0.55, (n[no] @ (1 - p[no]) + 1.4) / (n[yes | no] @ (1 - p[yes | no]) + 2)))
            z = np.full(len(n), math.log(share / (1 - share)))
            for j in range(LABELERS):
                yes, no = votes[:, j] == 1, votes[:, j] == 0
                z += yes * math.log(hit[j] / (1 - rej[j])) + no * math.log((1 - hit[j]) / rej[j])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        out[kind] = (share, list(zip(hit, rej)))
    return out


def _posterior(model, kind: str, votes: tuple[int, ...]) -> float:
    share, able = model[kind]
    z = math.log(share / (1 - share))
    for v, (hit, rej) in zip(votes[:LABELERS], able):
        z += math.log(hit / (1 - rej)) if v == 1 else math.log((1 - hit) / rej) if v == 0 else 0.0
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _features(kind: str, pattern: tuple[int, ...]) -> list[float]:
    own = [float(kind == k) for k in KINDS]
    for v in pattern[:LABELERS]:
        own += [float(v == 1), float(v == 0)]
    return own + [float(pattern[LABELERS] == k) for k in range(4)] + [float(pattern[LABELERS + 1])]


def train(rows: list[tuple[str, tuple[int, ...], int]]) -> list[float]:
    """Weights of the span classifier, fitted to the EM probabilities of the patterns."""
    model = reliabilities(rows)
    width = len(_features(KINDS[0], (0,) * (LABELERS + 2)))
    if not rows:
        return [0.0] * width
    x = np.array([_features(k, v) for k, v, _ in rows])
    y = np.array([_posterior(model, k, v) for k, v, _ in rows])
    n = np.array([math.sqrt(c) for _, _, c in rows])  # frequent patterns don't drown the others
    w = np.zeros(width)
    for _ in range(50):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + 0.5 * w
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(width)
        w = w - np.linalg.solve(h, g)
    return [float(v) for v in w]


def pattern_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, pattern, n) over all texts."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            c = Counter((k, v) for t in b.column(0).to_pylist() for k, _, _, _, v in candidates(t or ""))
            yield pa.RecordBatch.from_pydict({"kind": [k for k, _ in c], "pattern": [list(v) for _, v in c],
                                              "n": list(c.values())}, schema=pa.schema(
                [("kind", pa.string()), ("pattern", pa.list_(pa.int32())), ("n", pa.int64())]))

    seen = docs.select(text_col).mapInArrow(count, "kind string, pattern array<int>, n long")
    return seen.groupBy("kind", "pattern").agg(F.sum("n").alias("n"))


def choose(text: str, weights: list[float]) -> list[tuple[str, int, int, bool]]:
    """The spans of one text: (kind, start, end, base), by kind as listed, then start."""
    found = candidates(text)
    added = []
    for k, s, e, ok, v in found:
        if not ok and sum(a * b for a, b in zip(weights, _features(k, v))) >= LEAST_LOGIT:
            added.append((s - e, s, e, k))
    taken, out = [], [(k, s, e, True) for k, s, e, ok, _ in found if ok]
    ends: list[tuple[int, int]] = taken
    for _, s, e, k in sorted(added):
        if all(e <= a or b <= s for a, b in ends):
            ends.append((s, e))
            out.append((k, s, e, False))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    counts = pattern_counts(docs, text_col).collect()  # kinds x 3^labelers x forms rows at most
    return train(sorted((r["kind"], tuple(r["pattern"]), r["n"]) for r in counts))


def find(docs: DataFrame, weights: list[float], text_col: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` with ``spans`` (array of kind, start, end, base); with ``redact``
    the text has the kind in angle brackets in place of each span (overlapping
    spans: one place, named after the first)."""
    (out,) = fresh(docs.columns, "spans")
    span = T.StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("base", "boolean")

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("base", pa.bool_())]))
        for b in slices(batches):
            texts = b.column(text_col).to_pylist()
            spans = [choose(t or "", weights) for t in texts]
            cols = dict(zip(b.schema.names, b.columns))
            if redact and any(spans):
                cols[text_col] = pa.array([redacted(t, s) if s else t for t, s in zip(texts, spans)],
                                          type=b.schema.field(text_col).type)
            cols[out] = pa.array([[{"kind": k, "start": s, "end": e, "base": o} for k, s, e, o in x] for x in spans],
                                 type=kind)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    schema = T.StructType([*docs.schema.fields]).add(out, T.ArrayType(span))
    return docs.mapInArrow(work, schema)


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    out, at = [], 0
    for k, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join(out) + text[at:]
