"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` words in a row; words covered by a window that also
starts earlier (smaller id, or further up in the same document) are removed.

Equal windows must meet in one shard.  Each window is sent by the least hash
among its ``GRAM``-word runs (its anchor); windows in a row with the same anchor
travel together as a stretch of at most 2 * window words.  Stretches whose
anchor occurs nowhere else are done; of equal stretches only the first one goes
on, all others are removed whole.  What remains are different stretches around
the same anchor, few rows even of heavily copied corpora.  Their words are
fetched and each shard builds an FM-index of them: the Burrows-Wheeler
transform as a wavelet matrix of packed bits with rank counts.  The stretches
are streamed through it from right to left (backward search, all in step) and
every window whose suffix interval holds two suffixes or more is reported; the
first window of an interval stays, the others are removed.

An anchor shared by more than ``HOT`` different stretches is made longer by
words from the left (windows that have enough of them there) or the right (the
others), over and over, until its groups are small or it is a whole window,
whose stretches are all equal.  So no anchor, line or passage fills a task,
and copies are combined before each shuffle.

Words are compared by 64-bit hashes, stretches by two of them (anchor, stretch).

Defined results: null and wordless texts have no words and an empty ``kept``; a
null id comes before all others; rows with the same id are ordered by a hash of
the text, wholly equal ones are one document and get the same result; texts
shorter than a window stay whole; an empty table gives an empty table; further
columns are carried through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import discard, fresh, slices, written

WINDOW = 20
GRAM = 4
#: Different stretches of one anchor up to which a shard takes them.
HOT = 4096
SHARD_ROWS = 8192
_VOCAB = 500_000  # word hashes that a task keeps


class _Hashes(dict):
    """64-bit hashes of words, kept for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _VOCAB:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p)


def stretches(h: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """The stretches of texts whose word hashes stand one after the other in ``h``:
    text (its number), start, n (windows), at (anchor's place in the stretch), route, seg."""
    n, span = len(h), window - gram + 1
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    none = {k: np.zeros(0, np.int64) for k in ("text", "start", "n", "at", "route", "seg")}
    if n < window:
        return none
    grams, mul, done = h, _MUL, 1
    while done < gram:  # hashes of 1, 2, 4 .. words
        step = min(done, gram - done)
        left = grams[: len(grams) - step]
        if step == done:
            grams, mul, done = left + np.uint64(mul) * grams[step:], mul * mul % (1 << 64), done * 2
        else:
            raise ValueError("gram must be a power of two")
    value = _mix(grams)
    place = np.arange(len(value))
    least, wide = value, 1
    while wide < span:  # least hash (the leftmost of equals) in 1, 2, 4 .. span runs
        step = min(wide, span - wide)
        a, b = least[:-step], least[step:]
        left = a <= b
        least, place, wide = np.where(left, a, b), np.where(left, place[:-step], place[step:]), wide + step
    text = np.repeat(np.arange(len(lengths)), np.maximum(lengths - window + 1, 0))
    if not len(text):
        return none
    per = np.maximum(lengths - window + 1, 0)
    at = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    where = first[text] + at  # windows that lie in one text
    anchor = place[where]
    new = np.ones(len(text), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(text)))
    s = where[head]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(h) * _powers(_MUL, n))])
    seg = _mix((sums[s + count + window - 1] - sums[s]) * _powers(_INV, n)[s] + count.astype(np.uint64))
    return {"text": text[head], "start": at[head], "n": count, "at": anchor[head] - s,
            "route": value[anchor[head]].view(np.int64), "seg": seg.view(np.int64)}


class FMIndex:
    """Burrows-Wheeler transform of short texts over integer symbols (1 and up), as a wavelet matrix."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        m, n = len(lengths), len(symbols) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)  # 0 closes a text
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = symbols
        rank = np.where(inner, text + m, 0)
        rank[ends] = np.arange(m)  # closing symbols differ, so the order is complete after the longest text
        step, order = 1, None
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + ahead
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
            step *= 2
            if rank[order[-1]] == n - 1 or step >= n:
                break
        bwt = text[order - 1]
        sigma = int(text.max()) + 1
        self.size = n
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:-1]
        self.levels = []
        for bit in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            ones = (bwt >> bit & 1).astype(np.uint8)
            packed = np.zeros((n >> 6) + 1, np.uint64)
            raw = np.packbits(ones, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))])[:-1].astype(np.int32)
            self.levels.append((bit, packed, counts, n - int(ones.sum())))
            bwt = np.concatenate([bwt[ones == 0], bwt[ones == 1]])
        every = np.arange(sigma)
        self.base = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` comes to when it follows the bits of ``c`` through the matrix."""
        for bit, packed, counts, zeros in self.levels:
            word = i >> 6
            below = packed[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
            ones = counts[word] + np.bitwise_count(below)
            i = np.where(c >> bit & 1, zeros + ones, i - ones)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of c + pattern from those of the patterns."""
        both = self._down(np.concatenate([c, c]), np.concatenate([lo, hi]))
        shift = self.before[c] - self.base[c]
        return both[: len(c)] + shift, both[len(c) :] + shift


def repeated_windows(symbols: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, start, interval) of every window that occurs twice or more in the texts."""
    index = FMIndex(symbols, lengths)
    first = np.cumsum(lengths) - lengths
    lane = np.flatnonzero(lengths >= window)
    end = np.full(len(lane), window - 1)
    lo, hi, done = np.zeros(len(lane), np.int64), np.full(len(lane), index.size), np.zeros(len(lane), np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    while len(lane):
        lo, hi = index.extend(symbols[first[lane] + end - done], lo, hi)
        done += 1
        many, whole = hi - lo >= 2, done == window
        hit = many & whole
        if hit.any():
            found.append((lane[hit], end[hit] - window + 1, lo[hit]))
        # a run that occurs once rules out all windows that hold it: go on to the right of its first word
        end = np.where(hit, end + 1, np.where(many, end, end - done + 1 + window))
        again = ~many | whole
        lo, hi, done = np.where(again, 0, lo), np.where(again, index.size, hi), np.where(again, 0, done)
        live = end < lengths[lane]
        lane, end, lo, hi, done = lane[live], end[live], lo[live], hi[live], done[live]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _runs(group: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Heads of runs of intervals (sorted) that follow on one another in a group."""
    head = np.ones(len(start), bool)
    head[1:] = (group[1:] != group[:-1]) | (start[1:] > start[:-1] + n[:-1])
    return np.flatnonzero(head)


def _in_order(batch, *names):
    import pyarrow.compute as pc

    return batch.take(pc.sort_indices(batch, sort_keys=[(n, "ascending") for n in names], null_placement="at_start"))


def _groups(batch, *names) -> np.ndarray:
    """Numbers of the distinct (null-safe) values of sorted rows."""
    import pyarrow as pa

    new = np.zeros(batch.num_rows, bool)
    for n in names:
        codes = batch.column(n)
        codes = pa.chunked_array([codes]).combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        ids = codes.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= ids[1:] != ids[:-1]
    return np.cumsum(new)


def _place(start, n, at):
    return (start << 16) | (n << 8) | at


def _start(place):
    return place >> 16 if not isinstance(place, Column) else F.shiftright(place, 16)


def _field(place: Column, shift: int) -> Column:
    return F.shiftright(place, shift).bitwiseAND(F.lit(255).cast("long"))


def _anchored(docs: DataFrame, kind, window: int) -> DataFrame:
    """Rows doc, tie, place, route, seg; of the stretches of a slice that are equal
    only the first, the others joined to runs with ``seg`` null (route: their windows)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = _Hashes()
        for b in slices(batches):
            b = _in_order(b, "doc", "tie")
            texts = [_words(t) for t in b.column("text").to_pylist()]
            lengths = np.array([len(w) for w in texts], np.int64)
            h = np.fromiter((seen[w] for t in texts for w in t), np.uint64, int(lengths.sum()))
            s = stretches(h, lengths, window, GRAM)
            doc = _groups(b, "doc", "tie")[s["text"]] if len(s["text"]) else s["text"]
            _, first, of = np.unique(s["seg"] ^ s["route"], return_index=True, return_inverse=True)
            same = first[of]
            later = (doc != doc[same]) | (s["start"] != s["start"][same])
            # a repeated row is the same document: its stretches are neither first nor later
            keep = np.flatnonzero(same == np.arange(len(same)))
            gone = np.flatnonzero(later)
            head = _runs(s["text"][gone], s["start"][gone], s["n"][gone])
            total = np.add.reduceat(s["n"][gone], head) if len(head) else np.zeros(0, np.int64)
            gone = gone[head]
            rows = np.concatenate([keep, gone])
            place = _place(s["start"], s["n"], s["at"])[keep]
            yield pa.RecordBatch.from_arrays([
                b.column("doc").take(pa.array(s["text"][rows])), b.column("tie").take(pa.array(s["text"][rows])),
                pa.array(np.concatenate([place, s["start"][gone]])),
                pa.array(np.concatenate([s["route"][keep], total])),
                pa.array(np.concatenate([s["seg"][keep], total]), mask=np.arange(len(rows)) >= len(keep))],
                names=["doc", "tie", "place", "route", "seg"])

    schema = T.StructType([T.StructField("doc", kind)]).add("tie", "long").add("place", "long").add(
        "route", "long").add("seg", "long")
    return docs.mapInArrow(run, schema)


def _sorted_out(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removed, open) of ``rows`` (doc, tie, place, route, seg, ..): removed (doc, tie,
    start, n) are stretches equal to an earlier one, open are the first ones of
    equal stretches whose route has different ones."""
    often = rows.groupBy("route").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("route")
    some = written(rows.join(often, "route", "left_semi"), "stretches-some")
    more = [c for c in rows.columns if c not in ("doc", "tie", "place", "route", "seg")]
    firsts = written(some.groupBy("route", "seg").agg(
        F.min(F.struct("doc", "tie", "place", *more)).alias("f"), F.count(F.lit(1)).alias("copies")), "stretches-first")
    lead = firsts.filter("copies > 1").select("route", "seg", F.col("f.doc").alias("_d"), F.col("f.tie").alias("_t"),
                                              F.col("f.place").alias("_p"))
    same = F.col("doc").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")) & (F.col("place") == F.col("_p"))
    removed = written(some.join(lead, ["route", "seg"]).filter(~same).select(
        "doc", "tie", _start(F.col("place")).alias("start"), _field(F.col("place"), 8).alias("n")), "stretches-removed")
    shared = firsts.groupBy("route").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("route")
    left = written(firsts.join(shared, "route", "left_semi").select("route", "f.*"), "stretches-open")
    discard(some, firsts)
    return removed, left


def _with_words(docs: DataFrame, left: DataFrame, kind, window: int) -> DataFrame:
    """``left`` with the hashes of the stretches' words."""
    wanted = left.groupBy(F.col("doc").alias("_d"), F.col("tie").alias("_t")).agg(
        F.collect_list(F.struct("place", "route")).alias("want"))
    both = docs.join(wanted, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t"))).select(
        "doc", "tie", "text", "want")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = _Hashes()
        for b in slices(batches):
            want = b.column("want").combine_chunks() if hasattr(b.column("want"), "combine_chunks") else b.column("want")
            inner = want.flatten()
            place, route = (inner.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            per = np.diff(want.offsets.to_numpy())
            row = np.repeat(np.arange(len(per)), per)
            lists, at = [], 0
            for t, k in zip(b.column("text").to_pylist(), per):
                h = np.fromiter((seen[w] for w in _words(t)), np.uint64).view(np.int64)
                lists += [h[(p >> 16) : (p >> 16) + (p >> 8 & 255) + window - 1] for p in place[at : at + k].tolist()]
                at += k
            sizes = np.array([len(x) for x in lists], np.int32)
            words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                             pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(row)), b.column("tie").take(pa.array(row)), pa.array(place),
                 pa.array(route), words], names=["doc", "tie", "place", "route", "words"])

    schema = T.StructType([T.StructField("doc", kind)]).add("tie", "long").add("place", "long").add(
        "route", "long").add("words", T.ArrayType(T.LongType()))
    # repeated rows give the same stretches
    return both.mapInArrow(run, schema).groupBy("doc", "tie", "place", "route").agg(F.first("words").alias("words"))


def _longer(rows: DataFrame, long: int, grow: int, window: int) -> DataFrame:
    """Rows of anchors with ``long`` words as rows of anchors that have ``grow`` words more, left or right."""
    place, words = F.col("place"), F.col("words")
    start, n, at = _start(place), _field(place, 8), _field(place, 0)
    # windows that start at or before at - grow have the further words on the left, the others on the right
    n_left = F.least(n, F.greatest(at - grow + 1, F.lit(0).cast("long")))

    def piece(skip: Column, count: Column, place_at: Column, key: Column, side: int) -> Column:
        return F.when(count > 0, F.struct(
            (F.shiftleft(start + skip, 16) + F.shiftleft(count, 8) + place_at).alias("place"),
            F.xxhash64(F.col("route"), F.lit(side), key).alias("route"),
            F.slice(words, (skip + 1).cast("int"), (count + window - 1).cast("int")).alias("words")))

    one = F.lit(1).cast("long")
    left = piece(one * 0, n_left, at - grow, F.slice(words, F.greatest(at - grow + 1, one).cast("int"), F.lit(grow)), 0)
    right = piece(n_left, n - n_left, at - n_left, F.slice(words, (at + long + 1).cast("int"), F.lit(grow)), 1)
    cut = rows.select("doc", "tie", F.explode(F.array_compact(F.array(left, right))).alias("x"))
    return cut.select("doc", "tie", "x.*").withColumn("seg", F.xxhash64("words", F.lit(3)))


def _searched(rows: DataFrame, kind, window: int) -> DataFrame:
    """(doc, tie, start, n) of the windows in ``rows`` (doc, tie, place, words, shard) that occur earlier in their shard."""
    def run(table):
        import pyarrow as pa

        t = _in_order(table, "doc", "tie", "place").combine_chunks()
        doc, place = _groups(t, "doc", "tie"), t.column("place").to_numpy()
        words = t.column("words").combine_chunks()
        lengths = np.diff(words.offsets.to_numpy()).astype(np.int64)
        _, symbols = np.unique(words.flatten().to_numpy(), return_inverse=True)
        text, start, interval = repeated_windows(symbols.astype(np.int64) + 1, lengths, window)
        begin = (place >> 16)[text] + start
        order = np.lexsort((start, text, interval))
        text, begin, interval = text[order], begin[order], interval[order]
        new = np.ones(len(text), bool)
        new[1:] = interval[1:] != interval[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
        later = (doc[text] != doc[text[first]]) | (begin != begin[first])
        text, begin = text[later], begin[later]
        order = np.lexsort((begin, text))
        text, begin = text[order], begin[order]
        head = _runs(text, begin, np.ones(len(text), np.int64))
        n = np.diff(np.append(head, len(text)))
        rows = pa.array(text[head])
        return pa.table([t.column("doc").take(rows), t.column("tie").take(rows), pa.array(begin[head]), pa.array(n)],
                        names=["doc", "tie", "start", "n"])

    schema = T.StructType([T.StructField("doc", kind)]).add("tie", "long").add("start", "long").add("n", "long")
    return rows.groupBy("shard").applyInArrow(run, schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, tie, start, n): runs of n windows from word ``start`` on that occur earlier; tie = hash of the text."""
    if not 2 * GRAM <= window <= 120:
        raise ValueError(f"window must have {2 * GRAM} to 120 words: {window}")
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).alias("doc"), _tie(text_col).alias("tie"), F.col(text_col).alias("text"))
    every = written(_anchored(texts, kind, window), "stretches")
    whole = every.filter("seg IS NULL").select("doc", "tie", F.col("place").alias("start"), F.col("route").alias("n"))
    removed = [written(whole, "stretches-removed")]
    more, left = _sorted_out(every.filter("seg IS NOT NULL"))
    discard(every)
    removed.append(more)
    rows, long = written(_with_words(texts, left, kind, window), "stretches-words"), GRAM
    while long < window:
        sizes = rows.groupBy("route").agg(F.count(F.lit(1)).alias("_n"))
        hot = written(sizes.filter(F.col("_n") > HOT).select("route"), "hot-anchors")
        if hot.isEmpty():
            break
        grow = (window - long + 1) // 2
        cut = written(_longer(rows.join(hot, "route", "left_semi"), long, grow, window), "stretches-longer")
        more, left = _sorted_out(cut)
        removed.append(more)
        # cold anchors of the rows so far stay as they are
        done = rows.join(hot, "route", "left_anti").select("doc", "tie", "place", "route", "words")
        removed.append(_shards(written(done, "stretches-cold"), kind, window))
        rows, long = left.select("doc", "tie", "place", "route", "words"), long + grow
    removed.append(_shards(rows, kind, window))
    out = removed[0]
    for r in removed[1:]:
        out = out.unionByName(r)
    return out


def _shards(rows: DataFrame, kind, window: int) -> DataFrame:
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    return written(_searched(rows.withColumn("shard", F.pmod(F.xxhash64("route", F.lit(5)), F.lit(shards))), kind, window),
                   "windows-removed")


def _tie(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``dedup`` struct(n_words, n_removed, kept): the words that stay, joined by a blank."""
    doc, tie, cuts, out = fresh(docs.columns, "_doc", "_tie", "_cuts", "dedup")
    found = repeats(docs, id_col, text_col, window).groupBy(F.col("doc").alias(doc), F.col("tie").alias(tie)).agg(
        F.collect_list(F.struct("start", "n")).alias(cuts))
    both = docs.join(found, F.col(id_col).eqNullSafe(F.col(doc)) & (_tie(text_col) == F.col(tie)), "left").select(
        *docs.columns, cuts)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(b.column(text_col).to_pylist(), b.column(cuts).to_pylist()):
                words = _words(t)
                edge = np.zeros(len(words) + 1, np.int64)
                for x in spans or ():
                    edge[x["start"]] += 1
                    edge[x["start"] + x["n"] + window - 1] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                n_words.append(len(words))
                n_removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(words if stay.all() else [w for w, s in zip(words, stay.tolist()) if s]))
            result = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"])
            names = [n for n in b.schema.names if n != cuts]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), result], names=[*names, out])

    result = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return both.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, result)]))
