"""BPE encoding and decoding by tree concatenation.

White space ends every pre-token, so the white-space separated words of a text
encode independently of each other: a task keeps the ids and the decoded form
of the words that it has met (a bounded table) and asks the tokenizer only for
the others.  Special tokens hold no white space, so they stay inside one word.

A long unsplit run (a word over ``long_word`` characters) is normalised and
split into pre-tokens; a pre-token over ``leaf`` symbols is cut into leaves
that Spark encodes in parallel.  Neighbouring results are then joined pairwise,
level by level: a window around the join is encoded again and grown until its
first token is the left side's own token there and its last token the right
side's.  Adjacent tokens of a BPE encoding stay valid whatever stands beside
them, so sides that agree at both ends make the concatenation the encoding of
the whole.  A leaf that doesn't end its pre-token is encoded without the
end-of-word mark.

Every task holds one text's words or ids.  Defined results: a null or empty
text has no ids and decodes to the empty text; equal long texts are encoded
once; further columns are carried through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import fresh, slices, text_key

#: Characters of a word from which it is cut into leaves, and symbols of a leaf.
LONG_WORD = 8192
LEAF = 4096
#: Words that a task remembers at most.
REMEMBERED = 300_000
#: Characters of the texts whose words are learnt together.
LEARN_CHARS = 1_000_000
#: Symbols on each side of a join that the first window re-encodes.
WINDOW = 64


def _specification(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f) | {"truncation": None, "padding": None}


class Codec:
    """The tokenizer of a file, its model without end-of-word marks, and remembered words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        # tasks are the parallel unit: threads of the library would add memory, not speed
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec = _specification(path)
        self.tok = Tokenizer.from_str(json.dumps(spec))
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.path = path
        self.plain = spec["decoder"] is None
        self.lowers = '{"type": "Lowercase"}' in json.dumps(spec["normalizer"])
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.vocabulary = [""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.vocabulary[i] = t
        self.remembered, self.known, self.older = remembered, {}, {}

    @cached_property
    def bare(self):
        """The same model without end-of-word marks (for leaves that don't end their pre-token)."""
        from tokenizers import Tokenizer

        spec = _specification(self.path)
        spec["model"]["end_of_word_suffix"] = None
        return Tokenizer.from_str(json.dumps(spec))

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of ``words``.  Two generations: words that recur move to
        the younger one, the older one is dropped when the younger is full."""
        if len(self.known) + len(words) > self.remembered // 2:
            self.older, self.known = self.known, {}
        known, older, new = self.known, self.older, []
        for w in words:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    new.append(w)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for w, e in zip(part, self.tok.encode_batch(part, add_special_tokens=False)):
                known[w] = self.packed(e.ids)
        return known

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def decoded(self, raw: bytes) -> str:
        ids = struct.unpack(f"<{len(raw) // 4}I", raw)
        # without a decoder in the file the library's decode() joins the tokens by blanks
        return " ".join(map(self.vocabulary.__getitem__, ids)) if self.plain else self.tok.decode(
            ids, skip_special_tokens=False)

    def symbols(self, piece: str, ends: bool) -> list[tuple[int, int]]:
        """(id, end in symbols) of a pre-token's piece; ends: whether the pre-token ends with it."""
        model = (self.tok if ends else self.bare).model
        at, out = 0, []
        for t in model.tokenize(piece):
            at += len(t.value.removesuffix("</w>")) if ends else len(t.value)
            out.append((t.id, at))
        return out

    def pre_tokens(self, word: str) -> Iterator[tuple[str, bool]]:
        """(piece, special) of one word, in order."""
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", word) if self.special else [word]
        for part in parts:
            if part in self.special:
                yield part, True
            elif part:
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part)):
                    yield piece, False


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def join(c: Codec, left: tuple[str, list], right: tuple[str, list], ends: bool, window: int = WINDOW):
    """The encoding of left + right from theirs; a side is (piece, [(id, end)])."""
    a, ta = left
    b, tb = right
    reach = window
    while True:
        # token borders at least `reach` symbols from the join, on either side
        i = max((k for k in range(len(ta)) if len(a) - (ta[k - 1][1] if k else 0) >= reach), default=0) if ta else 0
        j = min((k for k in range(len(tb)) if tb[k][1] >= reach), default=len(tb) - 1)
        start, stop = (ta[i - 1][1] if i else 0), tb[j][1]
        last = j == len(tb) - 1
        mid = c.symbols(a[start:] + b[:stop], ends and last)
        begins = i == 0 or (mid[0][0], mid[0][1] + start) == ta[i]
        closes = last or (mid[-1][0] == tb[j][0] and mid[-2][1] + start - len(a) == (tb[j - 1][1] if j else 0)
                          if len(mid) > 1 else False)
        if begins and closes:
            shift = len(a)
            return a + b, ta[:i] + [(t, e + start) for t, e in mid] + [(t, e + shift) for t, e in tb[j + 1 :]]
        reach *= 2


def concatenate(c: Codec, leaves: list[tuple[str, list]]) -> list[int]:
    """Ids of a pre-token from its encoded leaves, joined pairwise level by level."""
    while len(leaves) > 1:
        paired = [join(c, leaves[k], leaves[k + 1], k + 2 == len(leaves)) for k in range(0, len(leaves) - 1, 2)]
        leaves = paired + ([leaves[-1]] if len(leaves) % 2 else [])
    return [t for t, _ in leaves[0][1]] if leaves else []


def _digest(ids: bytes, decoded: str) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")


_MARKS = re.compile(r"(?<=[a-z\xe0-\xf6\xf8-\xff])([.,;:!?]+)(?![^ \t\n\r\x0b\x0c])")


def _plainer(c: Codec, text: str) -> str:
    """Fewer distinct words with the same encoding: A-Z in lower case (the
    tokenizer lowers all letters itself) and closing marks apart from the word
    (they are pre-tokens of their own).  Not where a special token may be."""
    if not c.lowers or any(x[:2] in text for x in c.special):
        return text
    return _MARKS.sub(r" \1", text.encode().lower().decode())


def _encode_words(c: Codec, text: str) -> bytes:
    return next(_encode_texts(c, [text]))


def _encode_texts(c: Codec, texts: list[str]) -> Iterator[bytes]:
    """The ids of each text; words are learnt for a few texts at a time."""
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and size < LEARN_CHARS:
            part.append([w for w in _BLANK.split(_plainer(c, texts[at])) if w])
            size += len(texts[at])
            at += 1
        known = c.learn(set().union(*part))
        for ws in part:
            yield b"".join([known[w] for w in ws])


def encode(docs: DataFrame, path: str, text_col: str = "text", long_word: int = LONG_WORD, leaf: int = LEAF,
           ids: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids (little-endian unsigned 32-bit, left out when
    ``ids`` is false), ids_sha256, decoded and decoded_sha256 (decoded likewise left out)."""
    names = fresh(docs.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded", "_key", "_long")
    n_c, i_c, d_c, ids_c, dec_c, key, is_long = names
    extra = [n_c, i_c, d_c] + ([ids_c, dec_c] if ids else [])
    kinds = "long string string".split() + (["binary", "string"] if ids else [])
    schema = docs.schema
    for n, k in zip(extra, kinds):
        schema = type(schema)([*schema.fields]).add(n, k)

    def results(c: Codec, raw: bytes) -> tuple:
        decoded = c.decoded(raw)
        return _digest(raw, decoded) + ((raw, decoded) if ids else ())

    # a word this long is rare: the test is a scan of the text, and only its rows take the parallel way
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumn(is_long, text.rlike(r"[^\x20\x09-\x0D]{%d}" % long_word))
    short = marked.filter(~F.col(is_long)).drop(is_long)
    long = marked.filter(is_long).drop(is_long)

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        c = codec(path)
        for b in slices(batches):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            got = [results(c, x) for x in _encode_texts(c, texts)]
            cols = [pa.array([g[k] for g in got], type=_ARROW[kinds[k]]()) for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *extra])

    done = short.mapInArrow(whole, schema)
    return done.unionByName(_encode_long(long, path, text_col, long_word, leaf, key, extra, results))


def _arrow_types():
    import pyarrow as pa

    return {"long": pa.int64, "string": pa.string, "binary": pa.binary}


_ARROW = _arrow_types()


def _encode_long(long: DataFrame, path: str, text_col: str, long_word: int, leaf: int, key: str, extra: list[str],
                 results) -> DataFrame:
    """Texts with long unsplit runs: parts -> encoded leaves (in parallel) -> one text's tree."""
    keyed = long.withColumn(key, text_key(F.col(text_col)))
    texts = keyed.select(F.col(key).alias("k"), F.col(text_col).alias("t")).dropDuplicates(["k"])

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """kind: 'w' words, 's' special token, 'p' a whole pre-token, 'l' a leaf, 'e' the leaf that ends one."""
        c = codec(path)
        for pdf in batches:
            for k, t in zip(pdf["k"], pdf["t"]):
                rows, run = [], []
                for w in filter(None, _BLANK.split(t or "")):
                    if len(w) < long_word:
                        run.append(w)
                        continue
                    if run:
                        rows.append(("w", " ".join(run)))
                        run = []
                    for piece, special in c.pre_tokens(w):
                        if special or len(piece) <= leaf:
                            rows.append(("s" if special else "p", piece))
                        else:
                            cut = [piece[x : x + leaf] for x in range(0, len(piece), leaf)]
                            rows += [("e" if x == len(cut) - 1 else "l", y) for x, y in enumerate(cut)]
                if run:
                    rows.append(("w", " ".join(run)))
                for at in range(0, len(rows), 1000):
                    yield pd.DataFrame({"k": k, "i": range(at, at + len(rows[at : at + 1000])),
                                        "kind": [r[0] for r in rows[at : at + 1000]],
                                        "part": [r[1] for r in rows[at : at + 1000]]})

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            raw, leaf_of = [], []
            for kind, part in zip(pdf["kind"], pdf["part"]):
                leaf_of.append(part if kind in "le" else "")
                if kind in "le":
                    raw.append(b"".join(struct.pack("<II", *x) for x in c.symbols(part, kind == "e")))
                elif kind == "w":
                    raw.append(_encode_words(c, part))
                else:
                    raw.append(c.packed([c.tok.token_to_id(part)] if kind == "s" else
                                        [x for x, _ in c.symbols(part, True)]))
            yield pd.DataFrame({"k": pdf["k"], "i": pdf["i"], "kind": pdf["kind"], "raw": raw, "leaf": leaf_of})

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        pdf = pdf.sort_values("i")
        raw, leaves = [], []
        for kind, r, x in zip(pdf["kind"], pdf["raw"], pdf["leaf"]):
            if kind in "le":
                leaves.append((x, list(struct.iter_unpack("<II", r))))
                if kind == "l":
                    continue
                r, leaves = c.packed(concatenate(c, leaves)), []
            raw.append(r)
        got = results(c, b"".join(raw))
        return pd.DataFrame([(pdf["k"].iloc[0], *got)], columns=["k", *extra])

    spread = texts.mapInPandas(parts, "k binary, i int, kind string, part string").repartition("k", "i")
    leaves = spread.mapInPandas(coded, "k binary, i int, kind string, raw binary, leaf string")
    kinds = {3: "long string string", 5: "long string string binary string"}[len(extra)].split()
    whole = leaves.groupBy("k").applyInPandas(
        tree, "k binary, " + ", ".join(f"`{n}` {t}" for n, t in zip(extra, kinds)))
    out = whole.withColumnRenamed("k", f"{key}r")
    return keyed.join(out, keyed[key] == out[f"{key}r"]).select(*long.columns, *extra)
