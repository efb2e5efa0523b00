"""Near-duplicate join: MinHash bands of fixed length with exact verification.

Equal texts form a class; the classes are joined by the Jaccard similarity of
their sets of five-word shingles.

*Bands.*  They stand in for an LSH forest: each class has ``TREES`` signatures of d
minima, d being the most (up to ``MAX_DEPTH``) at which two texts at the threshold
meet in some tree with the target recall, 1 - (1 - t^d)^trees.  d follows from the
constants alone; longer prefixes are never matched.  The classes that share a
signature are the members of its node.

*Small nodes* (up to ``SMALL`` members) give candidate pairs.  *Large nodes* hold
candidates, mostly near copies, and give no pairs: nodes that share members are connected
to a group.  Its core are the c shingles that more than half of its members hold; a
member that lacks a of them and has b others differs from the core by a rest of
a + b shingles.  Two members reach a threshold of T percent exactly if

    f1 + f2 <= (100 - T) c + (100 + T) (size of the intersection of their rests),  f = 100 a + T b.

*Close* members (2 f <= (100 - T) c) are linked to each other whatever their rests, so
their links are counts and need no comparison.  The *far* members are compared with each
other and with the close ones, block with block, by their rests; tasks return each
member's number of links and a spanning set of links.  A group of m members with k far
ones shuffles about 2 k m / ``BLOCK`` rests besides its m rows.  Pairs from small nodes
whose sides are in one group are left to the group.

*Verification* is exact: sets of shingle hashes (64 bits) are intersected.

*Classes to components*: links are contracted by rounds of minimum labels with
pointer jumping, each round written to the shared folder.

Result per document: class (equal texts), component and number of links (other
documents of the class, and all documents of linked classes).  Nothing about
all documents is collected.

Defined results: null counts as empty; texts of fewer than five words have one
shingle, all their words (empty texts: none, they link to nothing but each
other as one class); a null id counts as a member, and class and component
carry the least id (null only if no member has one); further columns are
dropped by :func:`join` and kept by :func:`distinct`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import fresh, slices, small_side, text_key, written

WORDS, THRESHOLD_PCT = 5, 80
TREES, MAX_DEPTH, RECALL = 24, 10, 0.9995
#: Members of a trie node that are paired directly.
SMALL = 24
#: Members of a block of a large group, and the shingles of their rests, on the mean at most.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21
#: Shingles of all cores together up to which they are broadcast (32 MB).
CORE_SHINGLES = 1 << 22
_SEED = np.uint64(0x9E3779B97F4A7C15)


def depth(threshold: float, trees: int = TREES, recall: float = RECALL, longest: int = MAX_DEPTH) -> int:
    """The longest prefix at which pairs at the threshold still meet with the target recall."""
    d = longest
    while d > 1 and 1 - (1 - threshold**d) ** trees < recall:
        d -= 1
    return d


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_INVERSE = pow(0x100000001B3, -1, 1 << 64)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, text after text (with repeats), and each text's number."""
    counts = np.zeros(len(texts), dtype=np.int64)
    parts = []
    for i, t in enumerate(texts):
        h = _word_hashes((t or "").lower().encode("utf-8", "replace"))
        if not len(h):
            continue
        n = max(1, len(h) - WORDS + 1)
        s = np.zeros(n, dtype=np.uint64)
        for k in range(min(WORDS, len(h))):
            s = _mix(s * np.uint64(0x100000001B3) + h[k : k + n] + np.uint64(k + 1))
        counts[i] = n
        parts.append(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word: a polynomial over its bytes, from prefix sums of byte * base^place."""
    b = np.frombuffer(data, dtype=np.uint8)
    blank = _BLANK[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, back = _powers(len(b))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)])])
    return _mix((sums[ends] - sums[starts]) * back[starts] + _SEED * (ends - starts).astype(np.uint64))


_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((0x100000001B3, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _TABLES[i] = np.cumprod(steps)
    return _TABLES[0], _TABLES[1]


def _trie_nodes(texts: list[str | None], d: int) -> list[np.ndarray | None]:
    """For each text the hash of its node in every tree (None: no words)."""
    rng = np.random.default_rng(11)
    a = rng.integers(1, 1 << 63, TREES * d, dtype=np.uint64) | np.uint64(1)
    c = rng.integers(0, 1 << 63, TREES * d, dtype=np.uint64)
    out: list[np.ndarray | None] = []
    for lo in range(0, len(texts), 256):
        s, counts = shingles(texts[lo : lo + 256])
        have = counts > 0
        at = np.concatenate([[0], np.cumsum(counts[have])[:-1]]).astype(np.int64)
        nodes = np.zeros((int(have.sum()), TREES), dtype=np.uint64)
        if len(s):
            for t in range(TREES):
                node = np.full(len(nodes), t + 1, dtype=np.uint64)
                for k in range(t * d, t * d + d):
                    x = s * a[k] + c[k]
                    x ^= x >> np.uint64(32)
                    low = np.minimum.reduceat(x * _SEED, at)
                    node = _mix(node * np.uint64(0x100000001B3) + low)
                nodes[:, t] = node
        rows = iter(nodes.view(np.int64))
        out += [next(rows) if h else None for h in have]
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", d: int | None = None) -> DataFrame:
    """Written table (key, id, copies, nodes): one row per different text."""
    d = d or depth(THRESHOLD_PCT / 100)

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            nodes = _trie_nodes(b.column(2).to_pylist(), d)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.list_(pa.int64()))],
                                             names=["key", "id", "nodes"])

    rows = docs.select(text_key(F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("t")).mapInArrow(sign, "key binary, id long, nodes array<long>")
    return written(rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"),
                                           F.first("nodes").alias("nodes")), "near-classes")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): each vertex of the undirected edges (a, b) with its component's least vertex."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "near-edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(
        F.col("a").alias("v"), "label"), "near-labels")
    while True:
        # the least label among the neighbours, then the label of that label
        l2 = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
        near = both.join(l2, "b").groupBy("a").agg(F.min("lb").alias("m"))
        step = labels.join(near, labels["v"] == near["a"]).select(
            "v", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("v").alias("j"), F.col("label").alias("lj"))
        step = step.join(jump, F.col("label") == F.col("j"), "left").select(
            "v", "old", F.least("label", F.coalesce("lj", F.col("label"))).alias("label"))
        step = written(step, "near-labels")
        labels = step.select("v", "label")
        if step.filter("old != label").isEmpty():
            return labels


def _sets(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """(key, shingles): sorted sets of the texts whose key is in ``keys`` (written)."""
    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            s, counts = shingles(b.column(1).to_pylist())
            ends = np.cumsum(counts)
            sets = [np.unique(s[e - n : e]).view(np.int64) for n, e in zip(counts, ends)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])

    rows = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("t"))
    once = rows.join(small_side(keys.select("key")), "key", "left_semi").dropDuplicates(["key"])
    return written(once.mapInArrow(make, "key binary, shingles array<long>"), "near-sets")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
    owner = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    shared = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(shared):
        return out
    who, first, held = [], [], []
    for x, o in zip(flat, owner):
        at = np.searchsorted(shared, x)
        hit = shared[np.minimum(at, len(shared) - 1)] == x
        order = np.argsort(at[hit], kind="stable")
        who.append(o[hit][order])
        held.append(np.bincount(at[hit], minlength=len(shared)))
        first.append(np.cumsum(held[-1]) - held[-1])
    # shingles that many hold: matrix products; the others: one addition for each pair that shares one
    many = held[0] * held[1] * 100 > out.size
    dense = np.flatnonzero(many)
    for lo in range(0, len(dense), 1024):
        part = []
        for side, rows in enumerate(out.shape):
            m = np.zeros((rows, len(dense[lo : lo + 1024])), dtype=np.float32)
            for k, e in enumerate(dense[lo : lo + 1024]):
                m[who[side][first[side][e] : first[side][e] + held[side][e]], k] = 1
            part.append(m)
        out += part[0] @ part[1].T
    entry = np.repeat(np.arange(len(shared)), held[0])  # the shingle of each entry of who[0]
    rest = np.flatnonzero(~many[entry])
    ends = np.cumsum(held[1][entry[rest]])
    lo = 0
    while lo < len(rest):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + (1 << 21), "right")))
        e = entry[rest[lo:hi]]
        n = held[1][e]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        np.add.at(out, (np.repeat(who[0][rest[lo:hi]], n), who[1][np.repeat(first[1][e], n) + place]), 1)
        lo = hi
    return out


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block against another (or itself): links of each member, and links that span them."""
    pdf = pdf.sort_values("side", kind="stable")
    n, left = len(pdf), int((pdf["side"] == 0).sum())
    same = bool((pdf["bi"] == pdf["bj"]).all())
    rests = [np.asarray(x, dtype=np.int64) for x in pdf["rest"]]
    f, copies, keys = pdf["f"].to_numpy(), pdf["copies"].to_numpy(), pdf["key"].tolist()
    right = 0 if same else left  # the member that the first column stands for
    linked = f[:left, None] + f[None, right:] <= pdf["budget"].iloc[0] + (100 + THRESHOLD_PCT) * _common(
        rests[:left], rests[right:]).astype(np.int64)
    if same:
        np.fill_diagonal(linked, False)
    total = np.zeros(n, dtype=np.int64)
    total[:left] += linked @ copies[right:]
    if not same:
        total[left:] += copies[:left] @ linked
    seen, span = np.zeros(n, dtype=bool), {}
    for root in range(n):  # breadth first: each member's parent
        if seen[root]:
            continue
        seen[root], front = True, [root]
        while front:
            nxt = []
            for v in front:
                if v < left:
                    new = right + np.flatnonzero(linked[v] & ~seen[right:])
                else:
                    new = np.flatnonzero(linked[:, v - left] & ~seen[:left])
                seen[new] = True
                for u in new.tolist():
                    span[u] = keys[v]
                nxt += new.tolist()
            front = nxt
    return pd.DataFrame([(keys[k], int(total[k]), span.get(k)) for k in np.flatnonzero(total)],
                        columns=["key", "links", "parent"])


def _inside(members: DataFrame) -> DataFrame:
    """Written table (key, links, parent) of the links inside groups, from members
    (g, key, copies, shingles): a key may have several rows, whose links add up."""
    sizes = written(members.groupBy("g").agg(F.count("*").alias("m")), "near-sizes")
    # the size travels with the members: only the core's shingles meet by group, never all of a group's
    held = members.join(small_side(sizes), "g").select("g", "m", F.explode("shingles").alias("s"))
    core = held.groupBy("g", "m", "s").agg(F.count("*").alias("h")).filter(2 * F.col("h") > F.col("m")).groupBy("g").agg(
        F.collect_list("s").alias("core"))  # at most twice the mean size of a member
    core = written(core, "near-cores")
    if (core.agg(F.sum(F.size("core")).alias("n")).first()["n"] or 0) <= CORE_SHINGLES:
        core = F.broadcast(core)
    none = F.array().cast("array<long>")
    apart = members.join(core, "g", "left").withColumn("core", F.coalesce("core", none)).select(
        "g", "key", "copies", F.array_except("core", "shingles").alias("lacks"),
        F.array_except("shingles", "core").alias("has"), ((100 - THRESHOLD_PCT) * F.size("core")).cast("long").alias("budget"))
    f = (100 * F.size("lacks") + THRESHOLD_PCT * F.size("has")).cast("long")
    rests = written(apart.select("g", "key", "copies", "budget", f.alias("f"), (2 * f <= F.col("budget")).alias("close"),
                                 F.concat("lacks", "has").alias("rest")), "near-rests")
    far = ~F.col("close")
    blocks = lambda which: F.ceil(F.greatest(
        F.sum(which.cast("long")) / BLOCK, F.sum(F.when(which, F.size("rest"))) / BLOCK_SHINGLES)).cast("int")
    of = rests.groupBy("g").agg(blocks(far).alias("nf"), F.greatest(blocks(F.col("close")), F.lit(1)).alias("nc"),
                                F.sum(F.when(F.col("close"), F.col("copies"))).alias("close_copies"),
                                F.min(F.when(F.col("close"), F.col("key"))).alias("least"))
    of = small_side(written(of, "near-cut"))
    # close members link to each other
    counted = rests.filter("close").join(of, "g").select(
        "key", (F.col("close_copies") - F.col("copies")).alias("links"),
        F.when(F.col("key") != F.col("least"), F.col("least")).alias("parent")).filter("links > 0")
    # far members against all: blocks 0 to nf - 1 are far, the nc after them close
    own = F.pmod(F.xxhash64("key"), F.when(far, F.col("nf")).otherwise(F.col("nc"))).cast("int") + F.when(far, 0).otherwise(F.col("nf"))
    last = F.when(far, F.col("nf") + F.col("nc")).otherwise(F.col("nf")) - 1
    placed = rests.join(of.filter("nf > 0"), "g").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last)))
    placed = placed.select("g", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                           (F.col("own") > F.col("other")).cast("int").alias("side"), "key", "copies", "f", "budget", "rest")
    compared = placed.groupBy("g", "bi", "bj").applyInPandas(_compare, "key binary, links long, parent binary")
    return written(counted.unionByName(compared), "near-blocks")


def links(docs: DataFrame, table: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """From the classes: (key, links) of linked classes (documents of other
    classes that they link to), and edges (a, b) that connect them."""
    placed = table.filter(F.col("nodes").isNotNull()).select("key", F.explode("nodes").alias("node"))
    sizes = placed.groupBy("node").agg(F.count("*").alias("n"), F.min("key").alias("least")).filter("n > 1")
    placed = written(placed.join(sizes, "node"), "near-placed")
    # large nodes: connected to groups by their least members
    large = placed.filter(F.col("n") > SMALL).filter("key != least").select(
        F.col("least").alias("a"), F.col("key").alias("b")).distinct()
    groups = components(large).select(F.col("v").alias("key"), F.col("label").alias("g"))
    # small nodes: pairs that no group sees
    small = placed.filter(F.col("n") <= SMALL).join(groups, "key", "left")
    members = small.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("key", "g"))).alias("m"))
    pairs = members.select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(
        F.filter(F.slice("m", i + 2, F.lit(SMALL)), lambda y: x["g"].isNull() | y["g"].isNull() | (x["g"] != y["g"])),
        lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b")))))).alias("p")).select("p.*").distinct()
    pairs = written(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).unionByName(
        groups.select("key")).distinct()
    wanted = written(wanted, "near-wanted")
    sets = _sets(docs, wanted, text_col).join(table.select("key", "copies"), "key")
    a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"), F.col("copies").alias("ca"))
    b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"), F.col("copies").alias("cb"))
    # sizes that differ too much can't reach the threshold
    both = pairs.join(a, "a").join(b, "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    near = F.least(F.size("sa"), F.size("sb")) * 100 >= F.greatest(F.size("sa"), F.size("sb")) * THRESHOLD_PCT
    true = written(both.filter(near).withColumn("i", inter).filter(
        100 * F.col("i") >= THRESHOLD_PCT * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b", "ca", "cb"),
        "near-links")
    inside = _inside(sets.join(groups, "key"))
    edges = true.select("a", "b").unionByName(
        inside.filter("parent is not null").select(F.col("key").alias("a"), F.col("parent").alias("b")))
    count = true.select(F.col("a").alias("key"), F.col("cb").alias("links")).unionByName(
        true.select(F.col("b").alias("key"), F.col("ca").alias("links"))).unionByName(inside.select("key", "links"))
    return count.groupBy("key").agg(F.sum("links").alias("links")), edges


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id (least id among equal texts), component
    (least id among all that links connect) and n_links."""
    table = classes(docs, id_col, text_col)
    counted, edges = links(docs, table, text_col)
    label = components(edges)
    named = label.join(table.select(F.col("key").alias("v"), "id"), "v")
    least = named.groupBy("label").agg(F.min("id").alias("component"))
    per = (table.select("key", F.col("id").alias("class_id"), "copies")
           .join(counted, "key", "left").join(label.withColumnRenamed("v", "key"), "key", "left").join(least, "label", "left"))
    per = per.select(F.col("key").alias("k"), "class_id", F.coalesce("component", "class_id").alias("component"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = docs.select(F.col(id_col), text_key(F.col(text_col)).alias("k"))
    return rows.join(per, "k").select(id_col, "class_id", "component", "n_links")


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: of the component's least
    class (by text key) the one with the least id (of wholly equal rows, one).
    Texts without near copies all stay; columns are kept."""
    table = classes(docs, id_col, text_col)
    _, edges = links(docs, table, text_col)
    # a class is dropped when its component has a lesser one
    gone = components(edges).filter("v != label").select(F.col("v").alias("k"))
    key, n = fresh(docs.columns, "_key", "_n")
    # copies: the least id of each text that occurs more than once
    several = table.filter("copies > 1").select(F.col("key").alias("k2"), F.col("id").alias("first"))
    rows = docs.withColumn(key, text_key(F.col(text_col)))
    rows = rows.join(small_side(gone), rows[key] == gone["k"], "left_anti")
    rows = rows.join(small_side(several), rows[key] == several["k2"], "left")
    rows = rows.filter(F.col("k2").isNull() | F.col(id_col).cast("long").eqNullSafe(F.col("first"))).drop("first")
    # equal ids among the copies: number the few rows that are left of them
    single = rows.filter(F.col("k2").isNull()).select(*docs.columns)
    doubled = rows.filter(F.col("k2").isNotNull()).withColumn(
        n, F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns))))
    return single.unionByName(doubled.filter(F.col(n) == 1).select(*docs.columns))
