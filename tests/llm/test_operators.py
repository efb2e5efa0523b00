"""Small fixtures against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables, clashing columns, hot groups."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm import (bpe, decontaminate, html_extract, jaccard_join, lm_score, pii, quality_rules,
                         rules_classifier, secrets, sharding)

SCHEMA = "doc_id long, text string, source string"


def sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def odd_rows():
    rng = random.Random(4)
    rows = [(1, None, "a"), (2, "", "a"), (None, "   \n\t ", None), (None, None, None), (5, sentence(rng, 60), "a")]
    rows += [(6, rows[-1][1], "b"), (6, rows[-1][1], "b"), (7, "x" * 20000, "b"), (8, "one two", "a")]
    rows += [(9, "\n".join(sentence(rng, 9) for _ in range(400)), None), (10, "é日本語 " * 30, "c")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit(7))
    return df


# ---------------------------------------------------------------- 7 quality rules


def brute_stats(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c, m = Counter(zip(w, w[1:], w[2:])), [0] * len(w)
    for i in range(len(w) - 2):
        if c[w[i], w[i + 1], w[i + 2]] > 1:
            m[i] = m[i + 1] = m[i + 2] = 1
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), dup, sum(m)


def test_quality_statistics(spark):
    rng = random.Random(1)
    texts = [r[1] for r in odd_rows()] + ["a b a b a b", "a b c a b c", "l\nl\n \n\nl", "## a|b <c>"]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (3, 5, 40, 400)]
    texts += [" ".join(f"w{i % 150}" for i in range(900))]  # more repeated windows than are looked up one by one
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: tuple(r["s"]) for r in df.select("i", quality_rules.text_stats(F.col("text")).alias("s")).collect()}
    assert got == {i: brute_stats(t) for i, t in enumerate(texts)}


def test_common_lines_deplete(spark):
    rng = random.Random(2)
    body = lambda n: "\n".join(sentence(rng, 10) for _ in range(n))
    rows = [(i, f"{body(7)}\nThe Common  line {i % 10} of this site", "a") for i in range(30)]  # digits and blanks normalise
    rows += [(100 + i, "\n".join([f"{sentence(rng, 2)}", "the common line 1 of this site"] * 9), "a") for i in range(3)]
    copy = body(8)
    rows += [(200 + i, copy, "b") for i in range(60)]  # a group of copies is no boilerplate
    near = [copy.replace(copy.split()[k], "changed", 1) for k in range(60)]
    rows += [(300 + i, t, "b") for i, t in enumerate(near)]
    df = spark.createDataFrame(rows, SCHEMA)
    common = quality_rules.common_lines(df).collect()
    assert len(common) == 1 and common[0]["host"] == "a"
    kept = {r["doc_id"] for r in quality_rules.accepted(clashing(df, "quality", "_key")).collect()}
    assert kept == {r[0] for r in rows} - {100, 101, 102}


def brute_kept(rows, max_docs=20):
    """The verdict by the dealt rule alone: distinct documents of a host that hold a line (rows without near copies)."""
    def norm(line):
        return re.sub(" +", " ", re.sub(r"[\t\x0b\x0c\r]", " ", re.sub("[1-9]", "0", line.lower()))).strip(" ")

    lines = {(s, t): [x for x in map(norm, (t or "").split("\n")) if x] for _, t, s in rows}
    count = Counter((s, x) for (s, _), ls in lines.items() for x in set(ls))
    kept = []
    for d, t, s in rows:
        words, _, _, _, rep = brute_stats(t)
        total = sum(len(x.split(" ")) for x in lines[s, t])
        left = sum(len(x.split(" ")) for x in lines[s, t] if count[s, x] <= max_docs)
        gone = left < total and (left < 30 or 100 * left < 30 * total)
        kept += [d] * (words >= 50 and 100 * rep <= 50 * words and not gone)
    return sorted(kept)


def test_verdict_matches_brute_force(spark):
    rng = random.Random(21)
    body = lambda n: "\n".join(sentence(rng, 10) for _ in range(n))
    block = body(6)
    rows = [(i, f"{sentence(rng, 4)}\n{block}", "a") for i in range(300)]  # a title and six lines of boilerplate
    rows += [(400 + i, f"{body(rng.randint(1, 9))}\n{block}", "a") for i in range(60)]
    rows += [(500 + i, f"{body(5)}\n{block}", "b") for i in range(15)]  # few documents of this host have it
    rows += [(600 + i, f"{block}\n{body(2)}\nall rights reserved {i}", None) for i in range(25)]
    rows += [(700, block, "a"), (701, block, "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality_rules.apply_rules(df).collect()
    assert sorted(r["doc_id"] for r in out if r["quality"]["kept"]) == brute_kept(rows)
    assert not {r["doc_id"] for r in out if r["quality"]["kept"]} & set(range(300))
    assert sorted(r["doc_id"] for r in quality_rules.accepted(df).collect()) == brute_kept(rows)


def test_quality_odd_rows(spark, odd, none):
    out = quality_rules.apply_rules(clashing(odd, "quality")).collect()
    assert len(out) == odd.count() and sum(r["_quality"]["kept"] for r in out) == 4  # 5, 6 twice, 9
    assert quality_rules.apply_rules(none).count() == 0 and quality_rules.accepted(none).columns == none.columns


# ---------------------------------------------------------------- 4 sharding


def test_communication_matrix():
    counts = [0, 5, 100, 17, 3]
    m = sharding.communication_matrix(counts, 8, 1)
    assert m.sum(1).tolist() == counts and set(m.sum(0)) <= {15, 16} and m.min() >= 0
    mean = np.mean([sharding.communication_matrix([50, 50], 4, s)[0] for s in range(300)], axis=0)
    assert np.abs(mean - 12.5).max() < 0.5


@pytest.mark.parametrize("good,bad,draws", [(100, 300, 80), (300, 100, 200), (70, 5000, 70), (90, 90, 100), (200, 200, 200)])
def test_large_draws_follow_the_exact_law(good, bad, draws):
    """The way of more than 10^9 rows, on numbers whose law can be written out."""
    rng, n = np.random.default_rng(good), 2000
    law = {x: math.comb(good, x) * math.comb(bad, draws - x) / math.comb(good + bad, draws)
           for x in range(max(0, draws - bad), min(good, draws) + 1)}
    seen = Counter(sharding.hypergeometric(rng, good, bad, draws, small=0) for _ in range(n))
    assert set(seen) <= set(law)
    common = [x for x in law if law[x] * n >= 5]
    chi = sum((seen[x] - law[x] * n) ** 2 / (law[x] * n) for x in common)
    assert chi < len(common) + 5 * math.sqrt(2 * len(common))


def test_large_draws_keep_mean_and_variance():
    rng, good, bad, draws = np.random.default_rng(0), 10**12, 39 * 10**12, 10**12 // 7
    got = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(300)], dtype=float)
    share = good / (good + bad)
    variance = draws * share * (1 - share) * (good + bad - draws) / (good + bad - 1)
    assert abs(got.mean() - draws * share) < 5 * math.sqrt(variance / 300) and 0.6 < got.var() / variance < 1.5
    m = sharding.communication_matrix([10**12, 3 * 10**12 + 5, 0], 4, 1)
    assert m.sum(1).tolist() == [10**12, 3 * 10**12 + 5, 0] and m.sum(0).max() - m.sum(0).min() <= 1 and m.min() >= 0


def test_shards_are_exact_and_gapless(spark, odd, none):
    df = clashing(spark.range(5000).withColumnRenamed("id", "doc_id"), "shard", "_rank")
    out = sharding.shard(df, [F.col("doc_id")], shards=7, blocks=16, cell_rows=50)
    rows = [(r["doc_id"], r["_shard"], r["slot"]) for r in out.collect()]
    assert sorted(r[0] for r in rows) == list(range(5000))
    sizes = Counter(r[1] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    assert all(sorted(r[2] for r in rows if r[1] == s) == list(range(n)) for s, n in sizes.items())
    order = [r[0] for r in sorted(rows, key=lambda r: r[1:])]
    assert abs(np.corrcoef(order, range(5000))[0, 1]) < 0.05  # shuffled
    assert {(r["doc_id"], r["_shard"], r["slot"]) for r in out.collect()} == set(rows)  # and again the same
    assert sharding.shard(none, [F.col("doc_id")]).count() == 0
    assert sharding.shard(odd, [F.col("doc_id"), F.col("text")], shards=3).count() == odd.count()


# ---------------------------------------------------------------- 9 secrets


KINDS = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
         ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32)]


def brute_random(texts):
    """Spans of 12 characters and more that the two models call random, from the written-out definition."""
    alphabet = "^" + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + "+/_=-."
    base = [[(m.start(), m.end(), m[g]) for _, p, g, n in KINDS for m in re.finditer(p, t) if len(m[g]) >= n] for t in texts]
    runs = [[(m.start(), m.end(), m[0]) for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}", t)
             if not any(s < m.end() and m.start() < e for s, e, _ in bs)] for t, bs in zip(texts, base)]
    values = {1: {v for bs in base for _, _, v in bs},
              0: {v for rs in runs for _, _, v in rs if not re.search("[0-9]", v) or not re.search("[A-Za-z]", v)}}
    logp = {}
    for lab, vs in values.items():
        pairs = Counter(p for v in vs for p in zip("^" + v, v))
        first, second = Counter(), Counter()
        for (a, b), n in pairs.items():
            first[a] += n
            second[b] += n
        for a, b in itertools.product(alphabet, alphabet):
            share = (second[b] + 1) / (second.total() + len(alphabet))
            logp[lab, a, b] = math.log((pairs[a, b] + 40 * share) / (first[a] + 40))
    return [[(s, e) for s, e, v in rs if e - s >= 12
             and sum(logp[1, a, b] - logp[0, a, b] for a, b in zip("^" + v, v)) > math.log(1e4)] for rs in runs]


def test_secrets_base_and_added(spark, odd, none):
    rng = random.Random(7)
    pieces = ["password=", "Token: ", "api_key", "apikey = '", "'", "AKIA", "ABCDEFGHIJKL012", "deadbeef" * 4, "é", " ", "\n",
              "x", "secret:short", "abcdefgh12", ":", "=", "日本"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    texts += ["token=abcdefgh1 " * 700]  # more matches than one block of offsets
    key = "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/xyzXYZqQ") for _ in range(44))
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    runs = ["".join(rng.choice(chars[:62]) for _ in range(n)) for n in (12, 14, 16, 18, 19, 24, 32)]
    texts += [f"{sentence(rng, 20)} {r} 4785380592391139 2024-01-15" for r in runs]
    texts += [f"here {sentence(rng, 30)} {key} end", sentence(rng, 200), "internationalisation_of_ordinary_names"]
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    more = [sentence(rng, 200) for _ in range(100)]  # labelled samples to train from
    more += [f"token = '{''.join(rng.choice(chars) for _ in range(40))}' {sentence(rng, 9)}" for _ in range(60)]
    df = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts + more)], "doc_id long, text string"), "secrets")
    got = {r["doc_id"]: r["_secrets"] for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        spans = sorted((m.start(), k, m.end(), name) for k, (name, p, g, n) in enumerate(KINDS)
                       for m in re.finditer(p, t) if len(m[g]) >= n)
        assert got[i]["base"] == ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans), t
        assert set(filter(None, got[i]["base"].split(","))) <= set(got[i]["spans"].split(","))
    want = brute_random(texts + more)
    for i, t in enumerate(texts):
        added = [tuple(map(int, x.split(":")[1:])) for x in got[i]["spans"].split(",") if x.startswith("random:")]
        assert added == want[i], t
    n = len(texts)
    for i, run in enumerate(runs, n - 3 - len(runs)):
        at = texts[i].index(run)
        assert got[i]["spans"] == f"random:{at}:{at + len(run)}"
    at = texts[n - 3].index(key)
    assert got[n - 3]["spans"] == f"random:{at}:{at + 44}" and got[n - 2]["spans"] == got[n - 1]["spans"] == ""
    assert secrets.scan(none).count() == 0 and secrets.scan(odd).count() == odd.count()


# ---------------------------------------------------------------- 3 decontamination


def brute_overlap(text, item):
    toks = lambda t: [w for w in re.split(r"""[\x20\x09-\x0D.,;:!?"'()\[\]{}<>|*#$%&_-]+""", (t or "").lower()) if w]
    a, b = toks(text), toks(item)
    if len(b) < 9:
        return len(b) >= 5 and any(a[i : i + len(b)] == b for i in range(len(a)))
    w = min(20, len(b))
    for d in range(-len(b), len(a)):
        same = [0 <= d + j < len(a) and a[d + j] == x for j, x in enumerate(b)]
        if any(100 * sum(same[s : s + w]) >= 80 * w for s in range(len(b) - w + 1)):
            return True
    return False


def test_decontamination(spark, odd, none):
    rng = random.Random(9)
    items = [sentence(rng, n) for n in (40, 25, 12, 6, 3)] + [None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    texts = [sentence(rng, 80) for _ in range(15)]
    for k, item in enumerate(items[:5]):
        words = item.split()
        texts.append(f"{sentence(rng, 30)}, {item.upper()}! {sentence(rng, 30)}")
        if len(words) > 10:
            words[len(words) // 2] = "other"
            words[3] = "changed"
            texts.append(f"{sentence(rng, 5)} {' '.join(words)}")
        texts.append(" ".join(words[: len(words) // 3]))
    df = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "doc_key", "item")
    want = {(i, k) for i, t in enumerate(texts) for k, x in enumerate(items) if x and brute_overlap(t, x)}
    assert len(want) >= 6
    twice = bench.unionByName(bench.selectExpr("item_id + 100 AS item_id", "text"))  # items with equal words are each reported
    for most in (decontaminate.MAX_SEEDS, 20):  # tables that are broadcast, shuffled ones
        rows = decontaminate.overlaps(df, twice, max_seeds=most, max_words=most).collect()
        got = {(r["doc"]["doc_id"], r["item"]) for r in rows}
        assert got == want | {(i, k + 100) for i, k in want} and len({(*r["doc"], r["item"], r["at"]) for r in rows}) == len(rows)
    clean = decontaminate.clean(df, bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert clean.columns == df.columns
    assert decontaminate.clean(odd, bench).count() == odd.count() and decontaminate.clean(none, bench).count() == 0
    assert decontaminate.clean(odd, bench.limit(0)).count() == odd.count()


def test_masks_miss_no_substitutions(spark):
    # every placement of all the substitutions that the rule allows, for items of every seeded length
    def missed(masks, n):
        most = n - -(-decontaminate.SAME_PCT * n // 100)
        at = [{o + k for k, x in enumerate(m) if x == "1"} for m in masks for o in range(n - len(m) + 1)]
        return sum(all(a & set(gone) for a in at) for gone in itertools.combinations(range(n), most))

    assert missed(("110101011", "111001011"), 20) == 71  # the masks before
    for n in range(decontaminate.SEEDED, decontaminate.STRETCH + 1):
        assert missed(decontaminate.MASKS, n) == 0
    core = {k for k, x in enumerate(decontaminate.CORE) if x == "1"}
    assert all(m[k] == "1" for m in decontaminate.MASKS for k in core)
    # the operator itself: all placements in the shortest and a middle length, 400 of the longest stretch
    rng = random.Random(29)
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (9, 10, 11, 15, 20, 24)}
    texts = []
    for n, words in items.items():
        w = min(n, 20)
        places = list(itertools.combinations(range(w), w - -(-80 * w // 100)))
        for gone in rng.sample(places, min(len(places), 400)):
            new = ["other" if k in gone or k >= w else x for k, x in enumerate(words)]
            texts.append((n, " ".join(["before", *new, "after"])))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc"]["doc_id"], r["item"]) for r in decontaminate.overlaps(df, bench).collect()}
    assert got == {(i, n) for i, (n, _) in enumerate(texts)}


# ---------------------------------------------------------------- 8 BPE


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_bpe_equals_library(spark, odd, none):
    from tokenizers import Tokenizer

    tok, rng = Tokenizer.from_file(tokenizer_path()), random.Random(5)
    texts = [r[1] for r in odd_rows()] + ["Don't <|endoftext|> STOP.", "a... b.,c \x1c\x85 İ ß ǅ é", "ab" * 6000,
                                          "x " + "the" * 4000 + " y", "q" * 9000 + "<|endoftext|>" + "!" * 9000 + " tail",
                                          "".join(rng.choice("abcdeé") for _ in range(9500))]
    df = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "n_tokens", "k")
    got = {r["doc_id"]: r for r in bpe.encode(df, tokenizer_path(), leaf=500).collect()}
    for i, t in enumerate(texts):
        e = tok.encode(t or "", add_special_tokens=False)
        d = tok.decode(e.ids, skip_special_tokens=False)
        assert got[i]["ids"] == np.array(e.ids, "<u4").tobytes() and got[i]["decoded"] == d
        assert got[i]["_n_tokens"] == len(e.ids)
        assert got[i]["decoded_sha256"] == hashlib.sha256(d.encode()).hexdigest()
    assert bpe.encode(none, tokenizer_path()).count() == 0


def test_tree_concatenation_of_small_leaves():
    c, rng = bpe.codec(tokenizer_path()), random.Random(1)
    for trial in range(200):
        w = "".join(rng.choice(rng.choice(["ab", "abcdefgh", "thrinogae", "é日本xyz"])) for _ in range(rng.randint(1, 300)))
        leaf, ids = rng.choice([2, 3, 7, 16]), []
        for piece, _ in c.pre_tokens(w):
            cut = [piece[x : x + leaf] for x in range(0, len(piece), leaf)]
            leaves = [(y, c.symbols(y, k == len(cut) - 1)) for k, y in enumerate(cut)]
            ids += bpe.concatenate(c, leaves)
        assert ids == c.tok.encode(w, add_special_tokens=False).ids


# ---------------------------------------------------------------- 6 personal data


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def brute_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, t) if ok(m[0])]


def test_pii_base_spans():
    rng = random.Random(3)
    for _ in range(4000):
        t = "".join(rng.choice(["a", ".", "@", "1", "2", "55", "+", "-", " ", "(", ")", "9.9", "x@y.z", "4111 1111 1111 1111",
                                "1.2.3.4", "é"]) for _ in range(rng.randint(0, 25)))
        assert sorted((k, s, e) for k, s, e, ok in pii.strict(t) if ok) == sorted(brute_pii(t)), t


def test_pii_adds_and_redacts(spark, odd, none):
    rng = random.Random(8)
    rows = [(i, f"mail me: user{i}@mail.example.com or call +1 (212) 555-01{i:02d} {sentence(rng, 5)}", "a") for i in range(40)]
    rows += [(90, "please call 212-555-0143 today", "a"), (91, "serial 1234567890123456 only", "a"), (92, None, None)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "spans")
    w = pii.fit(df)
    got = {r["doc_id"]: r for r in pii.find(df, w, redact=True).collect()}
    assert [s["kind"] for s in got[90]["_spans"]] == ["phone"] and got[90]["text"] == "please call <phone> today"
    assert got[91]["_spans"] == [] and got[91]["text"] == rows[41][1] and got[92]["text"] is None
    assert got[3]["text"].startswith("mail me: <email> or call <phone> ")
    assert pii.find(none, pii.fit(none)).count() == 0 and pii.find(odd, pii.fit(odd)).count() == odd.count()


# ---------------------------------------------------------------- 1 html


PAGE = """<html><head><title>t</title><script>var a="</p>";</script></head><body class="x1"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav><div class="cookie-notice">We use cookies, ok</div>
<div class="post{i}"><h1>T&eacute;st &amp; {i}</h1><p>{body}<br>more<p>{body2}</p><div class="ad">Buy, now, buy</div>
<form><p>Your name</p></form><div id="comments"><p>Nice post, really, thanks a lot for writing it.</p></div></div>
<aside><p>Other things, long enough to look like running text, or so they say here.</p></aside><footer>&copy; us</footer></body></html>"""


def test_html_consensus(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(12):
        a, b = sentence(rng, 2 if i == 11 else 30), sentence(rng, 1 if i == 11 else 30)
        rows.append((i, f"http://www.example.com/{i}", PAGE.replace("{i}", str(i)).replace("{body}", a).replace("{body2}", b)))
        want[i] = f"Tést & {i}\n\n{a} more\n\n{b}"
    rows += [(20, None, None), (21, "nonsense", ""), (22, "http://h/", "plain  text\n only"), (23, None, "<p>a<p>b&#33;")]
    want |= {20: "", 21: "", 22: "plain text only", 23: "a\n\nb!"}
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "text", "host_path")
    for limit in (100, 0):  # broadcast and shuffled
        got = {r["page_id"]: r["_text"] for r in html_extract.extract(df, broadcast_hosts=limit).collect()}
        assert got == want
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_wrappers_around_the_page(spark):
    rng = random.Random(31)
    inner = """<div class="sidebar"><p>Other things, long enough to look like running text.</p></div>{open}<h1>Title</h1><p>{a}</p>
<p>{b}</p>{close}<div id="comments"><p>Nice post, really.</p></div><div class="related"><article><p>A teaser, short.</p></article></div>"""
    wrappers = ["div class='container has-sidebar'", "div class='no-sidebar'", "div id='with-banner'", "div class='widget-area content'",
                "form id='aspnetForm'", "div role='form'", "div class='no-sidebar'><div class='with-banner'", "section class='comments-open'"]
    pages, want = [], {}
    for w in wrappers:
        for o, c in (("<main>", "</main>"), ("<article>", "</article>"), ("<div class='post'>", "</div>"), ("", "")):
            a, b = sentence(rng, 60), sentence(rng, 60)
            page = inner.replace("{open}", o).replace("{close}", c).replace("{a}", a).replace("{b}", b)
            want[len(pages)] = f"Title\n\n{a}\n\n{b}"
            pages.append(f"<html><body><nav><a href='/'>Home</a></nav><{w}>{page}</{w.split()[0]}><footer>us</footer></body></html>")
    # a title outside of the wrapper, a page of hinted halves (both as without the classes), and hints that
    # hold long text but not the main one
    for page, text in (("<h1>T</h1><div class='no-sidebar'><p>one, two</p></div>", "one, two"),
                       ("<div class='no-ads'><p>one, two</p></div><div class='no-menu'><p>six, ten</p></div>", "one, two"),
                       ("<div class='post'><h1>T</h1><p>one, two</p><div id='comments'><p>" + "long, " * 90 + "</p></div></div>", "T\n\none, two"),
                       ("<form><div class='post'><h1>T</h1><p>one, two</p><div id='comments'><p>" + "long, " * 90 + "</p></div></div></form>",
                        "T\n\none, two")):
        want[len(pages)] = text
        pages.append(f"<html><body>{page}</body></html>")
    got = {i: html_extract.Page(p).text(None) for i, p in enumerate(pages)}
    assert got == want
    df = spark.createDataFrame([(i, f"http://h{i}/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()} == want


def test_html_deep_headers_and_long_tags():
    deep = "<article>" + "<div>" * 20 + "<header><h1>Title</h1></header>" + "<p>one, two</p>" + "</div>" * 20 + "</article>"
    assert html_extract.Page(f"<body>{deep}</body>").text(None) == "Title\n\none, two"
    low = "<article><header>" + "<div>" * 20 + "<p>by us</p>" + "</div>" * 20 + "</header><p>one, two, three, four</p></article>"
    assert html_extract.Page(f"<body>{low}</body>").text(None) == "one, two, three, four"
    attrs = " ".join(f'data-a{i}="{i} > {i - 1}"' for i in range(900))
    assert html_extract.Page(f"<body><div {attrs}><p {attrs}>one, two</p></div></body>").text(None) == "one, two"
    assert html_extract.Page("<body><p title=\"x>one, two</p></body>").text(None) == "one, two"
    assert html_extract.Page("<body><p>1 < 2, \"a <b or c\"</p></body>").text(None) == "1 < 2, \"a <b or c\""


def test_html_stays_linear():
    for s in ("<div>" * 50000 + "x", "<" * 50000, "<a \"" * 20000, "<table>" + "<tr><td>x" * 20000, "</p>" * 50000):
        html_extract.Page(s).text(None)


# ---------------------------------------------------------------- 5 language model


def test_language_model(spark, none):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choice(["The cat sat", "a dog ran home", "rare%d" % rng.randint(0, 50)]) for _ in range(20)), "a")
            for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", "a"), (None, "the cat", "b"), (1002, "unseen words only", "b"), (3, rows[3][1], "a")]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "score", "n_tokens")
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    is_train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0
    toks = lambda t: (t or "").encode().lower().split() + [b"\n"]
    c = Counter(w for i, t, _ in rows if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    train = [toks(t) for i, t, _ in rows if not held(i)]
    for word_cut, gram_cut in ((1, 2), (30, 40), (None, None), (10, 2)):  # all words are symbols, or rare ones come through the join
        model, counts = lm_score.train(df, is_train, word_cut=word_cut, gram_cut=gram_cut)
        got = lm_score.score(df, model, counts).collect()
        assert model.n == n and model.v == v and len(got) == len(rows)
        want = Counter((i, len(toks(t)), sum(c[w] > 0 for w in toks(t)),
                        round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)), 6)) for i, t, _ in rows)
        assert Counter((r["doc_id"], r["_n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
        out = [r for r in got if r["doc_id"] is not None and held(r["doc_id"]) and r["doc_id"] < 1000]
        assert sum(r["_score"] for r in out) > sum(r["base_score"] for r in out) and all(r["_score"] < 0 for r in got)
        cuts = (word_cut or lm_score.cutoff(n, lm_score.WORD_ROOT), gram_cut or lm_score.cutoff(n, lm_score.GRAM_ROOT))
        weigh, total = brute_model(train, c, n, v, *cuts)
        for r in got:
            text = next(t for i, t, _ in rows if i == r["doc_id"])
            assert r["_score"] == pytest.approx(weigh(toks(text)), abs=1e-9)
        # probabilities of the next word sum to one in every state
        words = sorted(c) + [b"unknown"]
        for h in [(), *total]:
            assert sum(10 ** weigh([*h, w], last=True) for w in words) == pytest.approx(1, abs=1e-5)


def brute_model(train, c, n, v, word_cut, gram_cut):
    """Interpolated absolute discounting by dictionaries: (log10 weight of a text, the contexts with arcs)."""
    once, twice = sum(k == 1 for k in c.values()), sum(k == 2 for k in c.values())
    d1 = min(0.95, max(0.1, once / (once + 2 * twice))) if once else lm_score.DISCOUNT
    kept = {w for w in c if c[w] >= word_cut or w == b"\n"}
    grams = Counter(tuple(t[i : i + k]) for t in train for k in (2, 3) for i in range(len(t) - k + 1))
    grams = {g: k for g, k in grams.items() if k >= gram_cut and set(g) <= kept}
    arcs = {}
    for g, k in grams.items():
        arcs.setdefault(g[:-1], {})[g[-1]] = k
    total = {h: grams[h] if len(h) > 1 else c[h[0]] for h in arcs}

    def prob(h, w):
        if not h:
            return max(c[w] - d1, 0) / n + d1 * v / n / (v + 1)
        if h not in arcs:
            return prob(h[1:], w)
        free = max(1e-6, 1 - sum(k - lm_score.DISCOUNT for k in arcs[h].values()) / total[h])
        low = free * prob(h[1:], w)
        return low + (max((arcs[h][w] - lm_score.DISCOUNT) / total[h], 0) * (1 - 1e-6) if w in arcs[h] else 0)

    def weigh(words, last=False):
        out = [math.log10(prob(tuple(words[max(0, i - 2) : i]), w)) for i, w in enumerate(words)]
        return out[-1] if last else sum(out)

    return weigh, total


def test_language_model_states_grow(spark, none):
    rng = random.Random(14)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, weights, k=200)), "a") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    grams = []
    for part in (df.filter("doc_id < 40"), df):
        model, _ = lm_score.train(part, F.lit(True))
        grams.append([len(x) for x in model.text.codes[2:]])
    assert grams[0][0] < grams[1][0] and sum(grams[0]) < sum(grams[1])
    model, counts = lm_score.train(none, F.lit(True))
    assert lm_score.score(none, model, counts).count() == 0


def test_language_model_keeps_rare_ngrams_at_any_size(spark, monkeypatch):
    """Words and n-grams that occur twice count in 90,000 tokens as in 90; buckets, dealt contexts and
    the number of slices change nothing."""
    rng = random.Random(15)
    words = ["The"] + [f"w{i}" for i in range(400)]
    weights = [60, *(1 / (i + 1) for i in range(400))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 400))), "a") for i in range(430)]
    rows += [(2000 + i, "once the pair of rare words", "a") for i in range(2)] + [(3000, "never seen the rare words", "a"), (None, None, "b")]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "score", "n_tokens")
    is_train = (F.col("doc_id") % 10 != 0) | (F.col("doc_id") == 2000)
    toks = lambda t: (t or "").encode().lower().split() + [b"\n"]
    train = [toks(t) for i, t, _ in rows if i is not None and (i % 10 or i == 2000)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    assert n > 60000
    weigh, _ = brute_model(train, c, n, v, 1, 2)
    want = {i: weigh(toks(t)) for i, t, _ in rows}
    for places, size, df in ((1_000_000, 2000, df.coalesce(1)), (1_000_000, 2000, df), (1500, 37, df)):
        monkeypatch.setattr(lm_score, "PLACES", places, raising=False)
        monkeypatch.setattr(lm_score, "SLICE", size, raising=False)
        model, counts = lm_score.train(df, is_train)
        got = {r["doc_id"]: r for r in lm_score.score(df, model, counts).collect()}
        assert len(got) == len(rows)
        for i, t, _ in rows:
            assert got[i]["_score"] == pytest.approx(want[i], abs=1e-8)
            assert got[i]["_n_tokens"] == len(toks(t)) and got[i]["n_known"] == sum(c[w] > 0 for w in toks(t))
    # texts other than those trained on
    other = df.filter("doc_id >= 3000 or doc_id is null or doc_id % 10 = 0").select("text", "doc_id")
    got = {r["doc_id"]: r["score"] for r in lm_score.score(other, model, counts).collect()}
    assert got == pytest.approx({i: want[i] for i in got}, abs=1e-8) and len(got) == 46


def test_language_model_shuffles_answers_only(spark, monkeypatch):
    """Slices are read where they lie when answers come to them: a second copy in the shuffle took the
    disk over its limit.  No table stays in the catalog, and a session's later partitions change nothing."""
    rng = random.Random(16)
    rows = [(i, " ".join(rng.choices(["the", "cat", "sat", "on", "a", "mat"], k=rng.randint(0, 60))), "a") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(lm_score, "SLICE", 40)
    monkeypatch.setattr(lm_score, "PLACES", 2000)
    before = {t.name for t in spark.catalog.listTables()}
    model, counts = lm_score.train(df, F.lit(True))
    out = lm_score.score(df, model, counts)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(sid") == 1
    c = Counter(w for _, t, _ in rows for w in [*t.encode().split(), b"\n"])
    weigh, _ = brute_model([[*t.encode().split(), b"\n"] for _, t, _ in rows], c, sum(c.values()), len(c), 1, 2)
    want = {i: weigh([*t.encode().split(), b"\n"]) for i, t, _ in rows}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for k in (partitions, "7", "2"):
        spark.conf.set("spark.sql.shuffle.partitions", k)
        try:
            got = {r["doc_id"]: r["score"] for r in out.select("*").collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert got == pytest.approx(want, abs=1e-8)


# ---------------------------------------------------------------- 10 rule ensemble


def test_rule_ensemble(spark, odd, none):
    rng = random.Random(12)
    rows = [(i, sentence(rng, 80) if i % 3 else " ".join(w + "***" for w in sentence(rng, 80).split()), "a") for i in range(600)]
    labels = [(i, int(i % 3 > 0)) for i in range(600)] + [(0, 0), (None, 1), (700, None)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "score")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model = rules_classifier.fit(df, lab.filter("doc_id % 4 != 2 or doc_id is null"))
    got = {r["doc_id"]: r["_score"] for r in rules_classifier.score(df, model).collect()}
    assert all((got[i] >= 0.7) == (i % 3 > 0) for i in range(600)) and len(model[1]) < 20
    some = rules_classifier.score(odd, model).collect()
    assert len(some) == odd.count() and all(0 <= r["score"] <= 1 for r in some)
    empty = rules_classifier.fit(df, lab.limit(0))
    assert empty[1] == [] and rules_classifier.score(none, empty).count() == 0
    assert rules_classifier.score(odd.limit(1), empty).first()["score"] == pytest.approx(0.5)


# ---------------------------------------------------------------- 2 near duplicates


def brute_links(texts):
    sets = []
    for t in texts:
        w = [x for x in re.split("[ \t\n\r\x0b\x0c]+", (t or "").lower()) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
            and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def test_jaccard_join(spark, none):
    rng = random.Random(13)
    texts = [None, "", "a b", "A  b", sentence(rng, 4000)]
    texts += [sentence(rng, 60) for _ in range(30)]
    base = sentence(rng, 150).split()
    for _ in range(70):  # a large group of near copies, more than a trie node pairs directly
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "z" + str(rng.randint(0, 9))
        texts.append(" ".join(w))
    passage = sentence(rng, 40)
    texts += [f"{sentence(rng, 60)} {passage} {sentence(rng, 60)}" for _ in range(40)]
    texts += [texts[20]] * 35 + [texts[21], texts[21] + " more"]
    df = clashing(spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string"), "k", "component")
    n, links = len(texts), brute_links(texts)
    same = lambda i, j: (texts[i] or "") == (texts[j] or "")
    near = {i: {j for j in range(n) if j != i and (same(i, j) or (i, j) in links or (j, i) in links)} for i in range(n)}
    comp = {}
    for i in range(n):
        if i not in comp:
            todo, group = [i], {i}
            while todo:
                for j in near[todo.pop()] - group:
                    group.add(j), todo.append(j)
            comp |= dict.fromkeys(group, min(group) + 1)
    want = {i + 1: (min(j for j in range(n) if same(i, j)) + 1, comp[i], len(near[i])) for i in range(n)}
    for block in (2048, 16):
        old, jaccard_join.BLOCK = jaccard_join.BLOCK, block
        try:
            got = {r[0]: tuple(r)[1:] for r in jaccard_join.join(df).collect()}
        finally:
            jaccard_join.BLOCK = old
        assert got == want
    left = jaccard_join.distinct(df)
    assert sorted(comp[r["doc_id"] - 1] for r in left.collect()) == sorted(set(comp.values()))
    assert left.columns == df.columns
    assert jaccard_join.join(none).count() == 0 and jaccard_join.distinct(none).count() == 0


def test_links_inside_groups(spark, monkeypatch):
    """Groups of close copies, of scattered ones, of two cores and without a core, against all pairs."""
    rng = random.Random(17)
    rows, sets = [], {}
    for g, (cores, lost, own) in enumerate([(1, 3, 3), (1, 12, 25), (2, 6, 6), (0, 0, 40)]):
        base = [rng.sample(range(1000 * g, 1000 * g + 400), 90) for _ in range(cores)]
        for k in range(60):
            c = list(base[k % cores]) if cores else []
            s = set(rng.sample(c, len(c) - rng.randint(0, lost)) if c else []) | {
                1000 * g + rng.randint(400, 450) for _ in range(rng.randint(0, own))}
            key = bytes([g, k])
            sets[key] = (g, s or {-1}, rng.randint(1, 3))
            rows.append((bytes([g]), key, sets[key][2], sorted(sets[key][1])))
    rows.append((b"z", b"z", 4, [1]))  # a group of one
    want, near = {}, {}
    for a, (g, s, _) in sets.items():
        near[a] = {b for b, (g2, s2, _) in sets.items() if a != b and g == g2 and 100 * len(s & s2) >= 80 * len(s | s2)}
        want[a] = sum(sets[b][2] for b in near[a])

    def reached(start, edges):
        todo, seen = [start], {start}
        while todo:
            for b in edges.get(todo.pop(), set()) - seen:
                seen.add(b), todo.append(b)
        return seen

    members = spark.createDataFrame(rows, "g binary, key binary, copies long, shingles array<long>")
    for block, most in ((2048, 1 << 21), (7, 1 << 21), (2048, 100)):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", most)
        got, edges = Counter(), {}
        for key, links, parent in jaccard_join._inside(members).collect():
            key = bytes(key)
            got[key] += links
            if parent is not None:
                edges.setdefault(key, set()).add(bytes(parent))
                edges.setdefault(bytes(parent), set()).add(key)
                assert bytes(parent) in near[key]
        assert {k: n for k, n in want.items() if n} == dict(got)
        assert all(reached(k, edges) == reached(k, near) for k in sets)
    close = sum(n > 0 for n in want.values())
    assert 60 < close


def test_common_shingles_of_blocks():
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 40 if k % 2 else 900, 30)) for k in range(n)] for n in (37, 90))
    got = jaccard_join._common(left, right)
    assert (got == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()
    assert (jaccard_join._common(left, [np.zeros(0, np.int64)]) == 0).all()


def test_distinct_odd_rows(spark, odd):
    left = jaccard_join.distinct(odd).collect()
    assert len(left) == len({r[1] or "" for r in odd_rows()})
