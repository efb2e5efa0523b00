"""Uniform shuffle into shards of exact sizes (native).

The rows are dealt into ``blocks`` source blocks by a hash.  A communication
matrix says how many rows of each block go to each shard: it is drawn from the
multivariate hypergeometric law given the block counts (its column sums are
the exact shard sizes, at most one apart), which is the law that a uniform
permutation of all rows would give (exact at every size: beyond the reach of
doubles the draws are decided in long arithmetic).  Each block permutes its rows (a seeded
hash gives the order), hands runs of the drawn lengths to the shards, and each
shard permutes what it received, so every order of all rows is equally likely
up to the quality of the hash.

Only the block counts (``blocks`` numbers, a fixed parameter) reach the driver.
Ranks inside a block or shard are exact and never computed in one task: rows
are cut into fine cells by the leading bits of their order hash, the cells are
counted, and a row's rank is its cell's offset plus its rank inside the cell.

Defined results: a null text has size 16 and the crc of the empty text; a null
id hashes as null, and wholly equal rows are interchangeable (any of them may
take any of their slots); an empty table gives an empty result; further columns are carried through.
"""

from __future__ import annotations

import json
import math
from decimal import ROUND_FLOOR, Decimal, localcontext

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import fresh

SHARDS = 40
BLOCKS = 256
#: Rows that one cell of a rank holds on average.
CELL_ROWS = 4096
#: numpy's generator draws from fewer rows than this.
GENERATOR_ROWS = 1_000_000_000
#: So many draws are made one after the other.
FEW_DRAWS = 64
#: Terms numerator / (denominator * n^power) of Stirling's series, and log(2 pi) / 2.
STIRLING = [(1, 12, 1), (-1, 360, 3), (1, 1260, 5), (-1, 1680, 7), (1, 1188, 9), (-691, 360360, 11)]
HALF_LOG_2PI = Decimal("0.91893853320467274178032973640561763986139747363778")


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows per (block, shard): rows sum to ``counts``, columns to the exact sizes."""
    rng, total = np.random.default_rng(seed), int(sum(counts))
    left = np.array([total // shards + (j < total % shards) for j in range(shards)], dtype=np.int64)
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for i, n in enumerate(counts):
        # a row given the rows before it: shard by shard, from what the shards still lack
        need, lack = int(n), int(left.sum())
        for j in range(shards):
            rest = lack - int(left[j])
            got = need if rest == 0 else hypergeometric(rng, int(left[j]), rest, need)
            out[i, j], need, lack = got, need - got, rest
        left -= out[i]
    return out


def _log_factorial(n: int) -> Decimal:
    """Stirling's series in 50 digits: its error is below 1e-30 from 500 on."""
    if n < 500:
        return Decimal(math.factorial(n)).ln()
    z = Decimal(n)
    series = Decimal(0)
    for numerator, denominator, power in STIRLING:
        series += Decimal(numerator) / (Decimal(denominator) * z**power)
    return (z + Decimal("0.5")) * z.ln() - z + HALF_LOG_2PI + series


def _one_by_one(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    got = 0
    for k in range(draws):
        got += int(rng.integers(good + bad - k)) < good - got
    return got


def _ratio_of_uniforms(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Rejection from the region under a ratio of uniforms, accepted by the exact
    log-probability relative to the mode's, so the cost doesn't depend on the numbers."""
    n = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    with localcontext() as context:
        context.prec = 50
        share = Decimal(good) / n
        mean = draws * share
        deviation = (mean * (1 - share) * (n - draws) / (n - 1) + Decimal("0.5")).sqrt()
        width = Decimal(2 * math.sqrt(2 / math.e)) * deviation + Decimal(3 - 2 * math.sqrt(3 / math.e))

        def log_weight(x: int) -> Decimal:
            return -(_log_factorial(x) + _log_factorial(good - x) + _log_factorial(draws - x) + _log_factorial(bad - draws + x))

        top = log_weight((draws + 1) * (good + 1) // (n + 2))
        while True:
            u, v = 1.0 - rng.random(), rng.random()
            x = int((mean + Decimal("0.5") + width * (Decimal(v) - Decimal("0.5")) / Decimal(u)).to_integral_value(ROUND_FLOOR))
            if low <= x <= high and 2 * Decimal(u).ln() <= log_weight(x) - top:
                return x


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int, small: int = GENERATOR_ROWS) -> int:
    """An exact draw at any size: numpy's generator below ``small`` rows, whose
    logarithms lose their digits beyond, and the same law in long arithmetic above."""
    if draws == 0 or good == 0:
        return 0
    n = good + bad
    if n < small:
        return int(rng.hypergeometric(good, bad, draws))
    # the law is the same with good rows and drawn rows exchanged, and with the rows left instead of drawn
    if draws > n - draws:
        return good - hypergeometric(rng, good, bad, n - draws, small)
    if good > n - good:
        return draws - hypergeometric(rng, bad, good, draws, small)
    few, many = min(good, draws), max(good, draws)
    if few <= FEW_DRAWS:
        return _one_by_one(rng, many, n - many, few)
    return _ratio_of_uniforms(rng, good, bad, draws)


def _rank(df: DataFrame, group: str, order: str, cells: int, out: str) -> DataFrame:
    """0-based rank by ``order`` (a long hash) inside ``group``."""
    cell, at, g, c, n = fresh(df.columns, "_cell", "_at", "_g", "_c", "_n")
    # leading bits of the hash, so that cells follow the order
    df = df.withColumn(cell, F.floor((F.col(order).cast("double") / 2.0**64 + 0.5) * cells).cast("long"))
    sizes = df.groupBy(F.col(group).alias(g), F.col(cell).alias(c)).agg(F.count("*").alias(n))
    before = Window.partitionBy(g).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(g, c, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(at))
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(group, cell).orderBy(order)) - 1)
    both = ranked.join(sizes, (ranked[group] == sizes[g]) & (ranked[cell] == sizes[c]))
    return both.withColumn(out, (F.col(out) + F.col(at)).cast("long")).drop(cell, at, g, c)


def shard(docs: DataFrame, identity: list[Column], shards: int = SHARDS, seed: int = 7,
          blocks: int = BLOCKS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (0-based, without gaps).  ``identity``
    are the columns that tell rows apart; the order hashes read nothing else."""
    block, local, rank, shard_col, slot, b, lo, hi, s, order = fresh(
        docs.columns, "_block", "_local", "_rank", "shard", "slot", "_b", "_lo", "_hi", "_s", "_order")
    spark = docs.sparkSession
    dealt = docs.withColumn(block, F.pmod(F.xxhash64(F.lit(f"{seed}b"), *identity), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn(local, F.xxhash64(F.lit(f"{seed}l"), *identity))
    dealt = dealt.withColumn(order, F.xxhash64(F.lit(f"{seed}s"), *identity))
    have = {r[0]: r[1] for r in dealt.groupBy(block).count().collect()}
    counts = [have.get(i, 0) for i in range(blocks)]
    total = sum(counts)
    matrix = communication_matrix(counts, shards, seed)
    ends = matrix.cumsum(axis=1)
    runs = [[i, j, int(ends[i, j] - matrix[i, j]), int(ends[i, j])]
            for i in range(blocks) for j in range(shards) if matrix[i, j]]
    runs_df = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(runs)), "array<array<bigint>>")).alias("r")
                                    ).select(F.col("r")[0].cast("int").alias(b), F.col("r")[1].cast("int").alias(s),
                                             F.col("r")[2].alias(lo), F.col("r")[3].alias(hi))
    ranked = _rank(dealt, block, local, max(1, total // (blocks * cell_rows)), rank)
    # the runs of one block as one array: a row finds its shard by where its rank falls
    by_block = runs_df.groupBy(b).agg(F.array_sort(F.collect_list(F.struct(hi, s))).alias(lo))
    sent = ranked.join(F.broadcast(by_block), ranked[block] == by_block[b])  # blocks x shards numbers at most
    sent = sent.withColumn(shard_col, F.filter(F.col(lo), lambda x: x[hi] > F.col(rank))[0][s]).drop(b, lo)
    placed = _rank(sent, shard_col, order, max(1, total // (shards * cell_rows)), slot)
    return placed.select(*docs.columns, F.col(shard_col), F.col(slot))
