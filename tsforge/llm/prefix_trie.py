"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn is an id (digest of role and text, and the text's bytes), so texts never
move.  The turns of a conversation fill the columns t1..tB of a row; one
``GROUP BY block, key, ROLLUP(t1..tB)`` with ``grouping_id`` aggregates all
prefixes together.  A longer conversation goes on in further rows (blocks),
keyed by the node at which the block before ended: the key is a 128-bit
digest of all turns before the block, so every block is in the same GROUP BY.

What a node's subtree holds is a second ROLLUP over the nodes.  Blocks hand
their totals to the blocks above by pointer doubling, in log2(blocks) rounds.

Numbering is a sample sort and digests are running XORs with a carry between
chunks of 8,192 turns, so one conversation with most of the turns is spread
over many tasks.  ``ends_sha256`` hashes a node's conversations as a stream of
sorted ids: memory stays bounded, one task a node.

Defined results: rows without conversation id belong to no conversation; a null
turn number comes first, equal ones are in order of their digests, null role
and text are empty; repeated rows are repeated turns; an empty table has no
node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import written
from tsforge.operators.scan import number_rows

WIDTH = 8
CHUNK_BLOCKS = 1024
KEY = ["depth", "x1", "x2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()
_T = [f"t{i}" for i in range(1, WIDTH + 1)]


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, pos, turn): the turns numbered from 0; turn = digest of role and text, then the text's bytes."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    size = F.octet_length(text)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.unhex(F.concat(digest, F.lpad(F.hex(size.cast("long")), 16, "0")))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("at"), turn.alias("turn"))
    hold = lambda df: written(df, "turns")
    return number_rows(rows, ["conv"], [F.col("at").asc_nulls_first(), "turn"], hold=hold).select("conv", "pos", "turn")


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations, and all conversations (conv).

    Conversation c has the first h turns of c - c % ``family``, h = crc32(c) %
    ``heads``, and then its own turns after its first h."""
    turns = written(turns, "numbered")
    convs = written(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "convs")
    root = lambda c: c - c % family
    shared = lambda c: F.crc32(c.cast("string").cast("binary")) % heads
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = (convs.withColumn("base", root(F.col("conv"))).withColumn("h", shared(F.col("conv")))
            .join(base, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m")))
    own = turns.withColumn("h", shared(F.col("conv"))).filter(F.col("pos") >= F.col("h"))
    short = plan.filter(F.col("m") < F.col("h")).select("conv", "m")  # their base has fewer turns than they take
    own = own.join(short, "conv", "left").select(
        "conv", (F.col("pos") - F.col("h") + F.coalesce("m", "h")).alias("pos"), "turn")
    first = turns.filter((F.col("pos") < heads - 1) & (F.col("conv") % family == 0))
    head = first.select(F.col("conv").alias("base"), "pos", "turn").join(plan, "base").filter(
        F.col("pos") < F.col("h")).select("conv", "pos", "turn")
    return own.unionByName(head), convs.select("conv")


def _mark(turn: Column, pos: Column, k: int) -> Column:
    return F.xxhash64(turn, pos.cast("long"), F.lit(k))


def _blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and block: conv, block, x1, x2 (digest of the turns before), t1..tB."""
    slot, none = F.col("pos") % WIDTH, F.lit(None)
    rows = turns.unionByName(convs.select("conv", F.lit(0).cast("long").alias("pos"), none.cast("binary").alias("turn")))
    rows = rows.select("conv", F.expr(f"pos div {WIDTH * CHUNK_BLOCKS}").alias("chunk"),
                       F.expr(f"pos div {WIDTH}").alias("block"), "pos", "turn").repartition("conv", "chunk")
    marked = F.col("turn").isNotNull()
    mine = [F.bit_xor(F.when(marked, _mark(F.col("turn"), F.col("pos"), k)).otherwise(F.lit(0).cast("long"))).alias(f"y{k}")
            for k in (1, 2)]
    cells = [F.max(F.when(slot == i, F.col("turn"))).alias(t) for i, t in enumerate(_T)]
    blocks = rows.groupBy("conv", "chunk", "block").agg(*mine, *cells)
    inside = Window.partitionBy("conv", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy("conv", "chunk").agg(*mine).select(
        "conv", "chunk", *[F.bit_xor(f"y{k}").over(before).alias(f"c{k}") for k in (1, 2)]).filter("chunk > 0")
    zero = F.lit(0).cast("long")
    held = blocks.select("*", *[F.coalesce(F.bit_xor(f"y{k}").over(inside), zero).alias(f"i{k}") for k in (1, 2)])
    return held.join(carry, ["conv", "chunk"], "left").select(
        "conv", "block", *[F.col(f"i{k}").bitwiseXOR(F.coalesce(f"c{k}", zero)).alias(f"k{k}") for k in (1, 2)],
        "y1", "y2", *_T)


def _rollup(df: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes inside the blocks of ``df``: block, k1, k2, t1..tB (null past the prefix), d (its turns), aggregates."""
    cols = ", ".join(_T)
    out = df.sparkSession.sql(
        f"SELECT block, k1, k2, {cols}, {WIDTH} - bit_count(grouping_id()) AS d, {aggregates} "
        f"FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({cols})", rows=df)
    last = F.get(F.array(*_T), F.col("d") - 1)
    return out.filter(F.when(F.col("d") == 0, F.col("block") == 0).otherwise(last.isNotNull()))


def _named(prefixes: DataFrame) -> DataFrame:
    """Adds depth and digest (x1, x2) of each prefix."""
    def digest(k: int) -> Column:
        marks = [F.when(F.col(t).isNotNull(), _mark(F.col(t), F.col("block") * WIDTH + i, k)).otherwise(
            F.lit(0).cast("long")) for i, t in enumerate(_T)]
        return reduce(lambda a, b: a.bitwiseXOR(b), marks, F.col(f"k{k}"))

    return prefixes.withColumn("depth", (F.col("block") * WIDTH + F.col("d")).cast("long")).withColumn(
        "x1", digest(1)).withColumn("x2", digest(2))


def _nodes(blocks: DataFrame) -> DataFrame:
    """All nodes: KEY, their parent's digest (p1, p2), conv, n, size, and their place in the block."""
    found = _named(_rollup(blocks, "count(1) AS n, min(conv) AS conv"))
    last = F.get(F.array(*_T), F.col("d") - 1)
    found = found.withColumn("_last", last)
    up = [F.when(F.col("d") > 0, F.col(f"x{k}").bitwiseXOR(_mark(F.col("_last"), F.col("depth") - 1, k))).alias(f"p{k}")
          for k in (1, 2)]
    size = F.conv(F.hex(F.substring("_last", 17, 8)), 16, 10).cast("long")
    return written(found.select("*", *up, F.coalesce(size, F.lit(0)).alias("size")).drop("_last"), "nodes")


def _below(parts: DataFrame) -> DataFrame | None:
    """Totals of all blocks under each block key (block >= 1), deeper ones included: block, k1, k2, leaves, saved."""
    deepest = parts.agg(F.max("block")).first()[0] or 0
    if not deepest:
        return None
    key = ["block", "k1", "k2"]
    own = parts.filter("block > 0").groupBy(*key).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    edge = parts.filter((F.col("d") == WIDTH) & (F.col("block") > 0)).select(
        (F.col("block") + 1).alias("block"), F.col("x1").alias("k1"), F.col("x2").alias("k2"),
        F.struct(*key).alias("up"))
    totals = written(own.join(edge, key, "left"), "block-totals")
    reach = 1
    while reach < deepest:  # totals hold all blocks less than ``reach`` below; up is the block key ``reach`` above
        add = totals.filter("up IS NOT NULL").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        add = add.select("up.*", "l", "s")
        higher = totals.select(F.struct(*key).alias("up"), F.col("up").alias("upper"))
        totals = written(totals.join(add, key, "left").join(higher, "up", "left").select(
            *key, (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("upper").alias("up")), "block-totals")
        reach *= 2
    return totals.drop("up")


def _ends(blocks: DataFrame) -> DataFrame:
    """KEY and ends_sha256 of the nodes at which a conversation ends."""
    filled = sum(F.col(t).isNotNull().cast("long") for t in _T)
    whole = blocks.groupBy("conv").agg(F.sum(filled).alias("depth"), F.bit_xor("y1").alias("x1"), F.bit_xor("y2").alias("x2"))
    rows = whole.repartition(*KEY).sortWithinPartitions(*KEY, "conv")

    def digests(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*done))[:3]]
                                              + [pa.array([d[3] for d in done], pa.string())], names=[*KEY, "ends_sha256"])

        now, h = None, None
        for b in batches:
            done = []
            for *key, conv in zip(*(b.column(c).to_pylist() for c in (*KEY, "conv"))):
                if key == now:
                    h.update(b",%d" % conv)
                    continue
                if now is not None:
                    done.append((*now, h.hexdigest()))
                now, h = key, hashlib.sha256(b"%d" % conv)
            if done:
                yield out(done)
        if now is not None:
            yield out([(*now, h.hexdigest())])

    return rows.mapInArrow(digests, "depth long, x1 long, x2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the conversations' prefixes; ``turns`` (conv, pos from 0
    without gaps, turn), ``convs`` (conv) also those without turns."""
    blocks = written(_blocks(turns, convs), "blocks")
    nodes = _nodes(blocks)
    up = ["_depth", "_x1", "_x2"]
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parts = written(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("size")), "trie-parts")
    below, sums = _below(parts), parts
    if below is not None:
        deeper = below.select((F.col("block") - 1).alias("block"), F.col("k1").alias("x1"), F.col("k2").alias("x2"),
                              F.col("leaves").alias("_l"), F.col("saved").alias("_s"))
        at_end = F.col("d") == WIDTH
        sums = parts.join(deeper.withColumn("d", F.lit(WIDTH)), ["block", "x1", "x2", "d"], "left")
        sums = sums.withColumn("leaf", F.col("leaf") + F.when(at_end, F.coalesce("_l", F.lit(0))).otherwise(0)).withColumn(
            "saved", F.col("saved") + F.when(at_end, F.coalesce("_s", F.lit(0))).otherwise(0))
    subtree = _named(_rollup(sums.select("block", "k1", "k2", *_T, "leaf", "saved"),
                             "sum(leaf) AS n_leaves, sum(saved) AS saved_tokens")).select(*KEY, "n_leaves", "saved_tokens")
    parent = parts.filter("n_children > 0").select(*[F.col(c).alias(u) for c, u in zip(KEY, up)],
                                                   F.col("conv").alias("parent_conv_id"))
    out = parts.join(subtree, KEY).join(_ends(blocks), KEY, "left")
    out = out.join(parent, (F.col("depth") - 1 == F.col("_depth")) & (F.col("p1") == F.col("_x1"))
                   & (F.col("p2") == F.col("_x2")), "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
