"""Fill-in-middle, substring deduplication and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm import fim, prefix_trie, queries, substring_dedup


def clashing(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit(7))
    return df


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- 11 fill-in-middle


def brute_fim(doc_id, text, unit="line", rate=100, spm=50):
    t = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", t) if unit == "line" else list(t)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, t
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_ROWS = [(1, None), (2, ""), (None, "a\nb"), (3, "é\n日本\n\nx𝒳y\n"), (4, "no newline"), (5, "has <S> in\nit"), (6, "\n\n\n"),
            (7, "<\nP>\n<P\n>"), (8, "é日" * 30000 + "\n" + "x\n" * 5000), (8, "é日" * 30000 + "\n" + "x\n" * 5000), (-9, "𝒳")]


@pytest.mark.parametrize("settings", [{}, {"unit": "char"}, {"rate": 40}, {"spm": 100}, {"spm": 0, "unit": "char"}])
def test_fill_in_middle(spark, settings):
    rng = random.Random(5)
    rows = FIM_ROWS + [(i, "".join(rng.choice("ab\n\né日𝒳<S>") for _ in range(rng.randint(0, 60)))) for i in range(20, 150)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "fim", "form")
    s = fim.Settings(**settings)
    out = fim.transform(df, s)
    assert out.columns == [*df.columns, "_fim"]
    got = out.select("doc_id", "text", "_fim.*", fim.restored(F.col("_fim.output"), F.col("_fim.form"), s).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:7]) == brute_fim(r["doc_id"], r["text"], **settings) and r["back"] == (r["text"] or "")
    assert fim.transform(df.limit(0), s).count() == 0


def test_exception_index():
    rng = random.Random(6)
    for _ in range(50):
        text = "".join(rng.choice("abcé日𝒳") for _ in range(rng.randint(0, 40)))
        index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
        cuts = np.arange(len(text) + 1)
        bytes_ = np.array([len(text[:i].encode()) for i in cuts])
        assert index.to_byte(cuts).tolist() == bytes_.tolist() and index.to_char(bytes_).tolist() == cuts.tolist()
        assert len(index.byte) == sum(ord(c) > 127 for c in text)


def test_sentinels_must_not_overlap():
    for bad in (("<P>", "<P>", "<M>"), ("aXa", "b", "c"), ("ab", "bc", "x"), ("", "a", "b"), ("xay", "a", "b")):
        with pytest.raises(ValueError):
            fim.Settings(sentinels=bad)


# ---------------------------------------------------------------- 12 substring deduplication


def brute_dedup(rows, window=20):
    """Rows (id, text) with distinct ids -> {id: (words, removed, kept)}."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            if g in seen:
                gone.update(range(s, s + window))
            seen.add(g)
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def dedup(df, **options):
    return {r["doc_id"]: tuple(r["dedup"]) for r in substring_dedup.deduplicated(df, **options).collect()}


def passages(rng):
    vocab = [f"w{i}" for i in range(400)] + ["é", "日本"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    shared, hot = [say(n) for n in (20, 21, 35, 60, 19)], say(12)
    rows = []
    for i in range(120):
        parts = [say(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            words = rng.choice(shared).split()
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = "changed"
            parts += [" ".join(words[rng.randint(0, 4):]), say(rng.randint(0, 9))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200 + i, f"{say(15)} {hot} {say(15)}") for i in range(40)]  # a short run in many surroundings
    rows += [(300 + i, rows[3][1]) for i in range(5)] + [(400, "x " * 300), (401, "a b " * 200 + "c"), (402, "x " * 25)]
    return rows + [(None, rows[7][1]), (500, None), (501, ""), (502, "  \n"), (503, "word")]


@pytest.mark.parametrize("hot", [4096, 3])  # 3: anchors grow until they are whole windows
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_ROWS", 40)
    rows = passages(random.Random(11))
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "tie", "doc", "_cuts")
    assert dedup(df) == brute_dedup(rows)


def test_substring_dedup_windows_and_ids(spark):
    rng = random.Random(12)
    rows = [(f"{i:03}", " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for window in (8, 13):
        assert dedup(df, window=window) == brute_dedup(rows, window)


def test_substring_dedup_repeated_rows(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (2, text), (3, "z " + text + " y"), (3, "other")]
    out = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"], r["dedup"]["n_words"], r["dedup"]["n_removed"]) for r in out)
    # wholly equal rows are one document
    assert got == [(1, 30, 0), (1, 30, 0), (2, 30, 30), (2, 30, 30), (3, 1, 0), (3, 32, 30)]
    assert substring_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fm_index_counts():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 30, 40)
    symbols = rng.integers(1, 5, lengths.sum())
    texts = np.split(symbols, np.cumsum(lengths)[:-1])
    index = substring_dedup.FMIndex(symbols, lengths)
    joined = "|".join("".join(map(str, t)) for t in texts)
    for _ in range(200):
        pattern = rng.integers(1, 5, rng.integers(1, 7))
        lo, hi = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = sum(joined.startswith("".join(map(str, pattern)), i) for i in range(len(joined)))
        assert int(hi[0] - lo[0]) == want


# ---------------------------------------------------------------- 13 prefix trie


def brute_trie(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t, r or "", x or ""))

    def key(t):
        return t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()

    own = {c: [(r, x) for _, r, x in sorted(v, key=key)] for c, v in conv.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), kids[p], leaves[p], saved[p],
                   sha(",".join(str(c) for c in m if len(full[c]) == len(p)))) for p, m in members.items())


TURNS = "conv_id long, turn long, role string, text string"


def trie(df):
    out = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.ordered_turns(df)))
    return sorted(tuple(-1 if k == 2 and v is None else v for k, v in enumerate(r)) for r in out.collect())


@pytest.mark.parametrize("chunk", [1024, 2])
def test_prefix_trie(spark, monkeypatch, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK_BLOCKS", chunk)
    rng = random.Random(3)
    rows = []
    for c in [*range(-12, 30), None, 100, 103]:
        for t in range(rng.choice([1, 2, 3, 8, 9, 17, 25, 40])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", None, ""])))
    rows += [(c, t, "u", "z") for c in (200, 201, 202) for t in range(70)]  # blocks below blocks
    rows += rows[:5]
    df = clashing(spark.createDataFrame(rows, TURNS).repartition(3), "conv", "depth", "t1")
    assert trie(df) == brute_trie(rows)


def test_prefix_trie_without_turns(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    rows = [(c, t, "u", "only") for c in range(1, 5) for t in range(1)]  # their base is absent: some lose all turns
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


# ---------------------------------------------------------------- the registered queries


def test_queries_on_small_tables(spark, tmp_path):
    rng = random.Random(8)
    docs = passages(rng)[:60] + [(None, "a\nb\n"), (700, "has <M>"), (701, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(c, t, "u", rng.choice("xyz") * (t + 1)) for c in range(9) for t in range(10)]
    spark.createDataFrame(turns, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op11_sparse_fim"](spark, str(tmp_path)).collect()
    want = {d: brute_fim(d, t) + (t or "",) for d, t in docs}
    assert {tuple(r) for r in got} == {(d, *w[:4], sha(w[4]), sha(w[5])) for d, w in want.items()}
    got = queries.QUERIES["op12_fm_substrings"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {(d, w[0], w[1], sha(w[2])) for d, w in brute_dedup(docs).items()}
    got = queries.QUERIES["op13_rollup_trie"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == brute_trie(turns)
