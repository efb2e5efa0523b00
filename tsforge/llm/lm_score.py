"""Language-model scores by a weighted backoff automaton.

Every word n-gram that occurs LEAST times or more in the training texts is a state
or an arc, whatever the corpus' size.  A state has arcs with interpolated,
discounted log probabilities and a failure arc to its longest shorter suffix.  The
root knows all words: a word's discounted share of the tokens plus an even share
of what the discounts free.  Words that training lacks are one word, the unknown
word, as in the base score (V + 1 words in all).

No task holds the whole automaton.  Texts are kept in slices of some thousand
(token numbers and digests of the slice's words).  For each order, a slice sends its
contexts (words, then kept word pairs) with the words that follow them to buckets
by the context's digest; a bucket adds up the training counts of all slices and answers each
slice in its own order: how often a context occurs, how many kept arcs it has and what they
add up to, and the count of each arc.  A slice's next order uses only n-grams that
were kept, as an n-gram is only as frequent as its parts are, and asks nothing about those
that no other slice has: it has all that follows them itself.  With the answers a slice has the
states that its texts visit, and traverses each text once from left to right: the
state before each place follows from the one before it, and log probabilities are added up.

Buckets hold about PLACES tokens' n-grams each, so there are more of them as the corpus
grows; contexts with very frequent words are dealt over several by the next word.
Words are told apart by a digest of 64 bits, contexts by 56 bits within a bucket that other
bits choose, the words after a context by 48.
Word counts, slices and answers are written to the shared folder, slices in buckets by their
number, so that only answers move when a slice meets them; the driver holds the
sums of the word counts and the words that are dealt over buckets (at most 1/8 of
the number of buckets).

``word_cut`` and ``gram_cut`` ask for a smaller model instead: n-grams of at least so many
occurrences, which the driver and the workers hold as one automaton of arrays (32
bytes an n-gram); words below the cut lead to the root from any state, and a text
gets the sum of their own weights from a join with the word table.

Defined results: null and empty texts are the end token alone; a null id has
the remainder of the empty text's crc; repeated rows are scored alike and, in
training, counted as often as they occur; without training tokens the unknown
word is the only one and has probability 1.
"""

from __future__ import annotations

import gc
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import count as numbers

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import bucketed, fresh, slices, written

ORDER = 3
#: An n-gram that occurs so often in training is kept.
LEAST = 2
#: Tokens whose n-grams make a bucket; texts of a slice.
PLACES = 1_000_000
SLICE = 2000
#: Words (n-grams) of :attr:`Model.text` occur sqrt(tokens) / root times or more.
WORD_ROOT = 400
GRAM_ROOT = 100
DISCOUNT = 0.75
END = b"\n"  # no word holds it


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case: what bytes.lower() and bytes.split() do."""
    return text.encode("utf-8", "replace").lower().split() if text else []


class Automaton:
    """The kept n-grams as arrays, order by order.  An n-gram's number is its place in
    ``codes[n]`` (sorted; code = number of its first n-1 words * symbols + last symbol);
    ``fail[n]`` is the number of its last n-1 words (the failure arc), ``logp[n]`` the
    weight of the arc that its last word is, ``back[n]`` what its failure arc costs as a
    state (0 where it has no arcs)."""

    def __init__(self, root: np.ndarray):
        self.m = max(1, len(root))
        none = np.zeros(0, np.int64)
        self.codes, self.fail = [none, none], [none, none]
        self.logp, self.back = [np.zeros(0), np.log10(root)], [np.zeros(0), np.zeros(len(root))]

    @property
    def order(self) -> int:
        return len(self.codes) - 1

    def grow(self, codes: np.ndarray, n: np.ndarray, context: np.ndarray, taken: np.ndarray | None = None,
             arcs: np.ndarray | None = None) -> None:
        """Adds the n-grams of the next order with their counts; ``context``: counts of the order below,
        ``arcs`` and ``taken``: number and summed counts of their arcs, if not all are among ``codes``."""
        k = self.order
        before, last = codes // self.m, codes % self.m
        fail = last if k == 1 else np.searchsorted(self.codes[k], self.fail[k][before] * self.m + last)
        total = context[before]
        if arcs is None:
            arcs, taken = np.bincount(before, minlength=len(context)), np.bincount(before, n, len(context))
        free = np.maximum(1.0 - (taken - DISCOUNT * arcs) / np.maximum(context, 1), 1e-6)
        share = np.maximum((n - DISCOUNT) / total, 0.0) * (1 - 1e-6)
        self.back[k] = np.where(arcs > 0, np.log10(free), 0.0)
        self.codes.append(codes)
        self.fail.append(fail)
        self.logp.append(np.log10(share + free[before] * 10 ** self.logp[k][fail]))
        self.back.append(np.zeros(len(codes)))

    def states(self, ids: np.ndarray) -> list[np.ndarray]:
        """For each order the number of the kept n-gram that ends at each place (-1: none)."""
        out = [np.full(len(ids), -1), ids]
        for codes in self.codes[2:]:
            out.append(_followed(out[-1], ids, codes, self.m))
        return out

    def traverse(self, ids: np.ndarray, at: list[np.ndarray] | None = None) -> np.ndarray:
        """Weight of each symbol given the words before it.  The state before a place is the
        longest n-gram that ends there; its arc is taken, or failure arcs down to the
        state that has one.  A word that is no symbol (< 0) fails down to the root, whose
        weight for it is not included.  ``at``: what :meth:`states` returns, if known."""
        at = at or self.states(ids)
        out = np.where(ids >= 0, self.logp[1][np.maximum(ids, 0)] if len(self.logp[1]) else 0.0, 0.0)
        for k in range(1, self.order):
            before = np.concatenate([[-1], at[k][:-1]])
            arc = at[k + 1] >= 0
            down = np.where(before >= 0, self.back[k][np.maximum(before, 0)] if len(self.back[k]) else 0.0, 0.0)
            out = np.where(arc, self.logp[k + 1][np.maximum(at[k + 1], 0)] if len(self.logp[k + 1]) else 0.0, out + down)
        return out


def _followed(state: np.ndarray, ids: np.ndarray, codes: np.ndarray, m: int) -> np.ndarray:
    """Number in ``codes`` of (state before a place, symbol there), -1 where there is none."""
    if not len(codes):
        return np.full(len(ids), -1)
    code = np.concatenate([[-1], np.where((state[:-1] >= 0) & (ids[1:] >= 0), state[:-1] * m + ids[1:], -1)])[: len(ids)]
    at = np.searchsorted(codes, code)
    at[at == len(codes)] = 0
    return np.where(codes[at] == code, at, -1)


def word_counts(docs: DataFrame, train: Column, text_col: str = "text") -> DataFrame:
    """(word, n): occurrences in training texts; words of other texts have n = 0."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches, 2000):
            c: Counter = Counter()
            others: set[bytes] = {END}
            for text, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if own:
                    c.update(words_of(text))
                    c[END] += 1
                else:
                    others.update(words_of(text))
            for w in others:
                c.setdefault(w, 0)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                             names=["word", "n"])

    rows = docs.select(F.col(text_col).alias("text"), train.alias("own")).mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _ids(texts: list[list[bytes]], index: dict[bytes, int]) -> np.ndarray:
    """Symbols of the texts one after the other (-1: no symbol), each closed by the end token and -2."""
    out: list[int] = []
    get, end = index.get, index.get(END, -1)
    for ws in texts:
        out += [get(w, -1) for w in ws]
        out += (end, -2)
    return np.array(out, dtype=np.int64)


def gram_counts(docs: DataFrame, model: Model, often: np.ndarray, text_col: str = "text") -> DataFrame:
    """(code, n) of the n-grams one order above the automaton's; the first and the last
    n-1 words must be kept ones and all symbols ``often``, as any n-gram's that is as frequent."""
    index, auto = model.index, model.text

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches, 2000):
            ids = _ids([words_of(t) for t in b.column(0).to_pylist()], index)
            ids = np.where((ids >= 0) & often[np.maximum(ids, 0)], ids, -1) if len(often) else ids
            s = auto.states(ids)[-1]
            ok = (s[:-1] >= 0) & (ids[1:] >= 0) & (s[1:] >= 0)
            codes, n = np.unique(s[:-1][ok] * auto.m + ids[1:][ok], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    return docs.select(text_col).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def cutoff(n: int, root: float) -> int:
    """The least count of what :attr:`Model.text` shows of n tokens: sqrt(n) / root, 2 at least."""
    return max(2, math.ceil(math.sqrt(n) / root))


class Model:
    """N, V, the discount of single words, and what was trained on.  ``cuts``: least counts of
    words and n-grams of a model that is held as arrays, None if all n-grams count."""

    def __init__(self, n: int, v: int, discount: float, order: int, cuts: tuple[int, int] | None,
                 docs: DataFrame, is_train: Column, text_col: str, words: DataFrame):
        self.n, self.v, self.discount, self.order, self.cuts = n, v, discount, order, cuts
        self.docs, self.is_train, self.text_col, self.words = docs, is_train, text_col, words
        self.least, self.index, self.counts, self._text = 1, {}, [], None

    @property
    def text(self) -> Automaton:
        """The automaton of the symbols (``index``, with ``counts``; ``least``: their least count, but
        the end token's) as arrays.  Without cuts it shows the frequent n-grams only (:func:`cutoff`);
        scores don't come from it then."""
        if self._text is None:
            self.least, gram_cut = self.cuts or (cutoff(self.n, WORD_ROOT), cutoff(self.n, GRAM_ROOT))
            top = self.words.filter((F.col("n") > 0) & ((F.col("n") >= self.least) | (F.col("word") == F.lit(END)))).toArrow()
            symbols = sorted(zip(top.column("word").to_pylist(), top.column("n").to_pylist()))
            self.index = {w: i for i, (w, _) in enumerate(symbols)}
            self.counts = [c for _, c in symbols]
            self._text = Automaton(np.array([self.root(c) for c in self.counts]))
            own, context = self.docs.filter(self.is_train), np.array(self.counts, dtype=np.int64)
            often = context >= gram_cut
            for _ in range(2, self.order + 1):
                found = gram_counts(own, self, often, self.text_col).filter(F.col("n") >= gram_cut).toArrow()
                codes, k = (found.column(c).to_numpy() for c in ("code", "n"))
                if not len(codes):
                    break
                by = np.argsort(codes)
                self._text.grow(codes[by], k[by], context)
                context = k[by]
        return self._text

    def root(self, c: int) -> float:
        """Probability of a word seen c times: its discounted share, and an even
        share of what the discounts free among the V words and the unknown word."""
        if not self.n:
            return 1.0
        return max(c - self.discount, 0.0) / self.n + self.discount * self.v / self.n / (self.v + 1)

    def base(self, c: int) -> float:
        return math.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1)))


def train(docs: DataFrame, is_train: Column, text_col: str = "text", order: int = ORDER,
          word_cut: int | None = None, gram_cut: int | None = None) -> tuple[Model, DataFrame]:
    """The model, and the written word table (word, n) of all texts.  N-grams of LEAST
    occurrences or more are kept, at any size; :func:`score` counts them, with the texts
    that it scores.  With ``word_cut`` or ``gram_cut``: a smaller model, see above."""
    counts = written(word_counts(docs, is_train, text_col), "lm-words")
    n, v, once, twice = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)),
                                   F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))).first()
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else DISCOUNT
    cuts = (word_cut or LEAST, gram_cut or LEAST) if word_cut or gram_cut else None
    return Model(n, v, discount, order, cuts, docs, is_train, text_col, counts), counts


# ---------------------------------------------------------------- slices and buckets

KEY, NEXT = (1 << 56) - 1, (1 << 48) - 1  # bits that tell contexts in a bucket apart, and words after a context


def _digests(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in words]), "<u8")


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads each number over all 64 bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(a: np.ndarray, width: int) -> bytes:
    """Numbers as ``width`` bytes, all first bytes first: equal ones lie together and compress well."""
    a = a.astype("<u8", copy=False)
    return b"".join([(a >> np.uint64(8 * i)).astype(np.uint8).tobytes() for i in range(width)])


def _unpack(body: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    for i in range(width):
        out[:, i] = np.frombuffer(body, np.uint8, n, at + i * n)
    return out.view("<i8").ravel()


def _squeeze(body: bytes) -> bytes:
    import pyarrow as pa

    return len(body).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(body, asbytes=True)


def _swell(body: bytes) -> bytes:
    import pyarrow as pa

    return pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value is found, in their order, and the number of each place's value."""
    by = np.argsort(x)
    y = x[by]
    new = np.concatenate([[True], y[1:] != y[:-1]])[: len(x)]
    number = np.empty(len(x), np.int64)
    number[by] = np.cumsum(new) - 1
    return by[new], number


def sliced(docs: DataFrame, own: Column, text_col: str) -> DataFrame:
    """One row per slice: number, the texts' other columns by position with their tokens' count, a byte for
    each text (1: training), tokens as numbers in the slice, digests of the words so numbered."""
    rest = [f for f in docs.schema.fields if f.name != text_col]
    item = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(rest)]).add("n_tokens", "long")
    schema = T.StructType().add("sid", "long").add("docs", T.ArrayType(item)).add("own", "binary") \
        .add("ids", "binary").add("digests", "binary")
    flat = docs.select(F.col(text_col).alias("text"), F.coalesce(own, F.lit(False)).cast("byte").alias("own"),
                       *[F.col(f.name).alias(f"c{i}") for i, f in enumerate(rest)])

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sid = TaskContext.get().partitionId() << 40
        for b in slices(batches, SLICE):
            index: dict[bytes, int] = defaultdict(numbers().__next__)
            ids, size, get = [], [], index.__getitem__
            get(END)
            for text in b.column(0).to_pylist():
                ws = words_of(text)
                ids.extend(map(get, ws))
                ids += (0, -2)
                size.append(len(ws) + 1)
            rows = pa.StructArray.from_arrays([*b.columns[2:], pa.array(size, pa.int64())], names=[*b.schema.names[2:], "n_tokens"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([sid], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(b)], pa.int32()), rows),
                 pa.array([b.column(1).to_numpy().tobytes()], pa.binary()), pa.array([_squeeze(_pack(np.array(ids) + 2, 4))], pa.binary()),
                 pa.array([_digests(list(index)).tobytes()], pa.binary())], names=schema.names)
            sid += 1

    return flat.mapInArrow(cut, schema)


class Slice:
    """The texts of a slice and the part of the automaton that they visit, order by order."""

    def __init__(self, own: bytes, ids: bytes, digests: bytes, buckets: int, hot: tuple[np.ndarray, np.ndarray]):
        ids = _swell(ids)
        self.ids = _unpack(ids, 0, len(ids) // 4, 4) - 2
        self.first = np.concatenate([[0], np.flatnonzero(self.ids == -2)[:-1] + 1])
        self.own = np.repeat(np.frombuffer(own, np.int8).astype(float), np.diff(np.append(self.first, len(self.ids))))
        words = np.frombuffer(digests, "<u8")
        self.words = np.stack([words, _mix(words ^ np.uint64(0xA0761D6478BD642F))], axis=1)
        self.m, self.buckets = len(self.words), buckets
        at = np.minimum(np.searchsorted(hot[0], self.words[:, 0]), max(0, len(hot[0]) - 1))
        self.parts = np.where(hot[0][at] == self.words[:, 0], hot[1][at], 1) if len(hot[0]) else np.ones(self.m, np.int64)
        #: of the present order: n-gram that ends at each place, digests, buckets over which each is dealt
        #: (0: no other slice has it, so what follows it is counted here)
        self.at, self.keys, self.dealt = [np.full(len(self.ids), -1), self.ids], self.words, self.parts
        self.auto: Automaton | None = None

    def follow(self) -> None:
        """What follows each context, and the order in which that is asked."""
        s, ids = self.at[-1], self.ids
        ok = (s[:-1] >= 0) & (ids[1:] >= 0) & (s[1:] >= 0)
        self.ok = np.flatnonzero(ok) + 1
        codes = s[:-1][ok] * self.m + ids[1:][ok]
        first, self.inverse = _distinct(codes)
        self.codes = codes[first]
        self.ctx, self.last = self.codes // self.m, self.codes % self.m
        start = np.cumsum(self.dealt) - self.dealt
        self.of = np.repeat(np.arange(len(self.dealt)), self.dealt)
        self.part = np.arange(len(self.of)) - start[self.of]
        sent = np.flatnonzero(self.dealt[self.ctx] > 0)
        ctx = self.ctx[sent]
        row = start[ctx] + (self.words[self.last[sent], 1] % self.dealt[ctx].astype(np.uint64)).astype(np.int64)
        self.asked = _mix(self.keys[self.of] + (self.part.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))[:, None])
        self.bucket = ((self.asked[:, 1] >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)
        # contexts by bucket, then by the leading bits of their digests
        self.by = np.argsort((self.bucket.astype(np.uint64) << np.uint64(40)) | ((self.asked[:, 0] & np.uint64(KEY)) >> np.uint64(16)),
                             kind="stable")
        rank = np.empty(len(self.by), np.int64)
        rank[self.by] = np.arange(len(self.by))
        self.row = rank[row]
        self.arcs_by = sent[np.argsort(self.row * len(sent) + np.arange(len(sent)))]  # stable, as no two are equal
        self.n = np.bincount(self.inverse, self.own[self.ok], len(self.codes)).astype(np.int64)

    def ask(self) -> list[tuple[int, bytes]]:
        """(bucket, contexts with the words that follow them), by bucket."""
        self.follow()
        s = self.at[-1]
        n = self.n[self.arcs_by]
        seen = np.bincount(s[s >= 0], self.own[s >= 0], len(self.dealt)).astype(np.int64)
        seen = np.where(self.part == 0, seen[self.of], 0)[self.by]
        keys, bucket = self.asked[self.by, 0] & np.uint64(KEY), self.bucket[self.by]
        words = self.words[self.last[self.arcs_by], 0] & np.uint64(NEXT)
        arcs = np.bincount(self.row, minlength=len(keys))
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(keys)]
        ends = np.append(0, np.cumsum(arcs)).tolist()
        out = []
        for a, b in zip(cuts, cuts[1:]):
            x, y = ends[a], ends[b]
            out.append((int(bucket[a]), _squeeze(b"".join([
                np.array([b - a, y - x], "<i8").tobytes(), _pack(keys[a:b], 7), _pack(seen[a:b], 5), _pack(arcs[a:b], 4),
                _pack(words[x:y], 6), _pack(n[x:y], 5)]))))
        return out

    def learn(self, answers: list[bytes], root, order: int) -> None:
        """Takes the buckets' answers to :meth:`ask`, in the order of :meth:`follow`; ``root``: words' probabilities by their counts."""
        got = [[], [], [], []]
        for body in map(_swell, answers):
            rows, arcs = np.frombuffer(body, "<i8", 2).tolist()
            for i in range(3):
                got[i].append(_unpack(body, 16 + i * 6 * rows, rows, 6))
            got[3].append(_unpack(body, 16 + 18 * rows, arcs, 6))
        seen, arcs, taken, n = (np.concatenate(g) if g else np.zeros(0, np.int64) for g in got)
        seen, arcs, taken = (np.bincount(self.of[self.by], x, len(self.dealt)) for x in (seen, arcs, taken))
        if self.auto is None:
            self.seen = self.context = seen
            self.auto = Automaton(root(seen))
        if self.auto.order == order:
            return
        alone = self.dealt[self.ctx] == 0
        count = np.where(alone & (self.n >= LEAST), self.n, 0)
        arcs = arcs + np.bincount(self.ctx[count > 0], minlength=len(arcs))
        taken = taken + np.bincount(self.ctx, count, len(taken))
        count[self.arcs_by] = n >> 1
        alone[self.arcs_by] = n & 1
        kept = np.flatnonzero(count > 0)
        self.auto.grow(self.codes[kept], count[kept], self.context, taken, arcs)
        number = np.full(len(self.codes), -1)
        number[kept] = np.arange(len(kept))
        state = np.full(len(self.ids), -1)
        state[self.ok] = number[self.inverse]
        ctx, last = self.ctx[kept], self.last[kept]
        self.at.append(state)
        self.keys = _mix(self.keys[ctx] * np.uint64(0x9E3779B97F4A7C15) + self.words[last])
        self.dealt = np.where(alone[kept], 0, np.minimum(self.dealt[ctx], self.parts[last]))
        self.context = count[kept]


def _bucket(bodies: list[bytes], least: int) -> list[bytes]:
    """Answers of a bucket to what slices asked: of each context the training count, kept arcs and
    their summed count; of each arc twice the count (0: not kept), plus 1 if no other slice has it."""
    bodies = [_swell(b) for b in bodies]
    size = [np.frombuffer(b, "<i8", 2).tolist() for b in bodies]
    part = [[], [], [], [], []]
    for body, (rows, arcs) in zip(bodies, size):
        at = 16
        for i, (n, width) in enumerate(((rows, 7), (rows, 5), (rows, 4), (arcs, 6), (arcs, 5))):
            part[i].append(_unpack(body, at, n, width))
            at += n * width
    keys, seen, arcs, words, n = (np.concatenate(p) for p in part)
    first, which = _distinct(keys)
    total = len(first)
    seen = np.bincount(which, seen, total).astype(np.int64)
    of = np.repeat(which, arcs)
    first, inverse = _distinct(_mix(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words.astype(np.uint64)))
    n = np.bincount(inverse, n, len(first)).astype(np.int64)
    n[n < least] = 0
    of = of[first]
    arcs, taken = np.bincount(of[n > 0], minlength=total), np.bincount(of, n, total).astype(np.int64)
    n = 2 * n + (np.bincount(inverse, minlength=len(first)) == 1)
    out, a, x = [], 0, 0
    for rows, k in size:
        own, its = which[a : a + rows], inverse[x : x + k]
        out.append(_squeeze(b"".join([np.array([rows, k], "<i8").tobytes(), _pack(seen[own], 6), _pack(arcs[own], 6),
                                      _pack(taken[own], 6), _pack(n[its], 6)])))
        a, x = a + rows, x + k
    return out


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs that no table refers to; it
    does so when the driver collects garbage, and keeps the last job's until the next one."""
    spark.range(1).count()
    gc.collect()
    spark._jvm.System.gc()


def _exact(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """:func:`score` by slices and buckets."""
    n_c, k_c, b_c, s_c = fresh(docs.columns, "n_tokens", "n_known", "base_score", "score")
    rest = [f for f in docs.schema.fields if f.name != text_col]
    n, v, order = model.n, model.v, model.order
    buckets = max(1, math.ceil(n / PLACES))
    top = model.words.filter(F.col("n") * buckets >= 8 * max(n, 1)).toArrow()
    lead = _digests(top.column("word").to_pylist())
    by = np.argsort(lead)
    hot = lead[by], np.array(top.column("n").to_pylist(), dtype=np.int64)[by] * buckets // (4 * max(n, 1))
    discount, unseen = model.discount, model.root(0)
    same = docs is model.docs and text_col == model.text_col  # then texts are sliced once
    released(docs.sparkSession)  # the word counts' shuffle
    table = bucketed(sliced(docs, model.is_train if same else F.lit(False), text_col), "lm-slices", "sid")
    texts = table.select("sid", "own", "ids", "digests")
    if not same:
        own = model.docs.filter(model.is_train).select(F.col(model.text_col).alias("text"))
        trained = written(sliced(own, F.lit(True), "text"), "lm-slices")
        texts = texts.unionByName(trained.select(F.expr("-1 - sid").alias("sid"), "own", "ids", "digests"))

    def root(c: np.ndarray) -> np.ndarray:
        return np.maximum(c - discount, 0.0) / n + unseen if n else np.ones(len(c))

    def known(row, right, rounds: int) -> Slice:
        """The slice of a row with the answers of so many rounds."""
        s = Slice(*(row.column(c)[0].as_py() for c in ("own", "ids", "digests")), buckets, hot)
        got = sorted(zip(*(right.column(c).to_pylist() for c in ("k", "bucket", "body"))), key=lambda x: x[:2]) if rounds else []
        for i in range(rounds):
            s.follow()
            s.learn([body for k, _, body in got if k == i], root, order)
        return s

    def asked(row, right=None, rounds: int = 0):
        import pyarrow as pa

        asks = known(row, right, rounds).ask()
        return pa.table({"sid": pa.array([row.column("sid")[0].as_py()] * len(asks), pa.int64()), "bucket": pa.array([b for b, _ in asks], pa.int32()),
                         "body": pa.array([x for _, x in asks], pa.binary())})

    def ask_first(batches: Iterator) -> Iterator:
        for b in slices(batches, 1):
            yield from asked(b).to_batches()

    def asking(rounds: int):
        return lambda left, right: asked(left, right, rounds)

    def answering(k: int):
        def answer(group):
            import pyarrow as pa

            out = _bucket(group.column("body").to_pylist(), LEAST)
            return pa.table({"sid": group.column("sid"), "k": pa.array([k] * len(out), pa.int32()),
                             "bucket": group.column("bucket"), "body": pa.array(out, pa.binary())})

        return answer

    question, rounds, answers = "sid long, bucket int, body binary", max(1, order - 1), None
    for k in range(rounds):
        asks = texts.mapInArrow(ask_first, question) if not k else \
            texts.groupBy("sid").cogroup(answers.groupBy("sid")).applyInArrow(asking(k), question)
        new = written(asks.groupBy("bucket").applyInArrow(answering(k), "sid long, k int, bucket int, body binary"), "lm-answers")
        answers = new if answers is None else answers.unionByName(new)
        # the answers are written: what was asked needn't stay on the executors' disks
        del asks, new
        released(table.sparkSession)

    schema = T.StructType(list(rest))
    for name, kind in ((n_c, T.LongType()), (k_c, T.LongType()), (b_c, T.DoubleType()), (s_c, T.DoubleType())):
        schema = schema.add(name, kind)

    def traverse(left, right):
        import pyarrow as pa

        s = known(left, right, rounds)
        at, word = s.ids != -2, np.maximum(s.ids, 0)
        base = np.log10((s.seen + 0.1) / (n + 0.1 * (v + 1)))
        weight = s.auto.traverse(s.ids, s.at)
        rows = left.column("docs").combine_chunks().flatten()
        cols = [rows.field(i) for i in range(len(rest) + 1)]
        sums = [np.add.reduceat(np.where(at, x, 0), s.first) for x in ((s.seen > 0)[word].astype(np.int64), base[word], weight)]
        return pa.Table.from_arrays([*cols, *(pa.array(x) for x in sums)], names=schema.names)

    # slices that were only trained on have numbers below 0
    return table.groupBy("sid").cogroup(answers.filter("sid >= 0").groupBy("sid")).applyInArrow(traverse, schema)


def score(docs: DataFrame, model: Model, counts: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without their text, with n_tokens, n_known, base_score and score."""
    if model.cuts is None:
        return _exact(docs, model, text_col)
    auto = model.text
    uid, n_c, k_c, b_c, s_c, rare = fresh(docs.columns, "_uid", "n_tokens", "n_known", "base_score", "score", "_rare")
    rest = [c for c in docs.columns if c != text_col]
    base = np.array([model.base(c) for c in model.counts] + [0.0, 0.0])  # -1 and -2 weigh nothing
    index, end = model.index, model.index.get(END, -1)
    end_base, end_logp = (0.0, 0.0) if end >= 0 else (model.base(0), math.log10(model.root(0)))

    def traverse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        get = index.get
        part, row = TaskContext.get().partitionId() << 40, 0
        item = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
        for b in slices(batches):
            texts = [words_of(t) for t in b.column(text_col).to_pylist()]
            ids = _ids(texts, index)
            weight = np.where(ids == -2, 0.0, auto.traverse(ids))
            size = np.array([len(ws) + 2 for ws in texts])
            at = np.cumsum(size) - size
            seen = np.add.reduceat((ids >= 0).astype(np.int64), at)
            others = [[{"word": w, "n": n} for w, n in Counter(w for w in ws if get(w) is None).items()]
                      if k < len(ws) + (end >= 0) else [] for ws, k in zip(texts, seen.tolist())]
            cols = [size - 1, seen, np.add.reduceat(base[ids], at) + end_base, np.add.reduceat(weight, at) + end_logp, others]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), item)
            ids_out = pa.array(range(part + row, part + row + len(b)), pa.int64())
            row += len(b)
            keep = [(n, c) for n, c in zip(b.schema.names, b.columns) if n != text_col]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in keep] + [ids_out] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=[n for n, _ in keep] + [uid, n_c, k_c, b_c, s_c, rare])

    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col])
    for name, kind in ((uid, T.LongType()), (n_c, T.LongType()), (k_c, T.LongType()), (b_c, T.DoubleType()),
                       (s_c, T.DoubleType()),
                       (rare, T.ArrayType(T.StructType().add("word", T.BinaryType()).add("n", T.IntegerType())))):
        schema = schema.add(name, kind)
    texts = written(docs.mapInArrow(traverse, schema), "lm-texts")  # read twice; its row numbers must not change

    others = counts.filter((F.col("word") != F.lit(END)) & (F.col("n") < model.least))  # unseen words have n = 0
    c = F.col("n").cast("double")
    logp = F.log10(F.greatest(c - model.discount, F.lit(0.0)) / model.n + model.root(0)) if model.n else F.lit(0.0)
    table = others.select("word", F.col("n").alias("c"), logp.alias("logp"),
                          F.log10((c + 0.1) / (model.n + 0.1 * (model.v + 1))).alias("base"))
    used = texts.select(F.col(uid).alias("u"), F.explode(rare).alias("x")).select("u", "x.word", "x.n")
    sums = used.join(table, "word").groupBy("u").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"), F.sum(F.col("base") * F.col("n")).alias("b"),
        F.sum(F.col("logp") * F.col("n")).alias("s"))
    out = texts.drop(rare).join(sums, F.col(uid) == F.col("u"), "left")
    zero = F.lit(0.0)
    return out.select(*rest, n_c, (F.col(k_c) + F.coalesce("k", F.lit(0))).alias(k_c),
                      (F.col(b_c) + F.coalesce("b", zero)).alias(b_c), (F.col(s_c) + F.coalesce("s", zero)).alias(s_c))
