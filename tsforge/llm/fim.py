"""Fill-in-middle transformation with a sparse exception index.

A text is cut into prefix, middle and suffix at two units (lines or
characters) that a hash of its id draws, and put together again in the order
PSM or SPM around three sentinels.  The work is done on the UTF-8 bytes that
Arrow hands over: an ASCII character is one byte, so only the multibyte
characters are recorded, by position and excess bytes.  A byte cut becomes a
code-point cut (and back) by subtracting (adding) the excess of the exceptions
before it, found with ``searchsorted``; an ASCII text has no exceptions and its
cuts are plain arithmetic.  No text is decoded.

Each row is a task of its own: no shuffle, memory of some slices of rows.

Defined results: null and empty texts and texts that hold a sentinel are
``plain`` and come out as they are (null: empty); a null id is hashed as the
empty text; repeated rows are transformed alike; an empty table gives an empty
table; further columns are carried through, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import fresh, slices

RESULT = (T.StructType().add("n", T.LongType()).add("form", T.StringType()).add("prefix_chars", T.LongType())
          .add("middle_chars", T.LongType()).add("output", T.StringType()))


@dataclass(frozen=True)
class Settings:
    """``rate`` percent of the texts are transformed, ``spm`` percent of these as SPM."""

    unit: str = "line"  # or "char"
    rate: int = 100
    spm: int = 50
    seed: int = 7
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def __post_init__(self):
        if self.unit not in ("line", "char"):
            raise ValueError(f"unit must be line or char: {self.unit!r}")
        pairs = [(s, t) for i, s in enumerate(self.sentinels) for j, t in enumerate(self.sentinels) if i != j]
        ends = [(s, t[k:]) for s in self.sentinels for t in self.sentinels for k in range(1, len(t))]
        if not all(self.sentinels) or any(s in t for s, t in pairs) or any(s.startswith(e) for s, e in ends):
            raise ValueError(f"sentinels must differ and must not overlap: {self.sentinels}")


class Exceptions:
    """Byte position, code-point position and running excess of the multibyte characters of a text."""

    def __init__(self, raw: np.ndarray):
        self.byte = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.byte]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)])
        self.char = self.byte - self.excess[:-1]

    def to_char(self, cut):
        """Code points before byte ``cut`` (a character's first byte, or the end)."""
        return cut - self.excess[np.searchsorted(self.byte, cut, "left")]

    def to_byte(self, cut):
        """Bytes before code point ``cut``."""
        return cut + self.excess[np.searchsorted(self.char, cut, "left")]


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def split(raw: np.ndarray, h1: int, h2: int, unit: str) -> tuple[int, tuple[int, int], tuple[int, int]]:
    """Units of the text, the two cuts in bytes and in code points."""
    index = Exceptions(raw)
    if unit == "char":
        n = int(index.to_char(len(raw)))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        chars = np.array([a, b])
        return n, tuple(index.to_byte(chars).tolist()), (a, b)
    ends = np.flatnonzero(raw == 0x0A) + 1
    n = len(ends) + (len(raw) > 0 and raw[-1] != 0x0A)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    cuts = np.array([0 if k == 0 else len(raw) if k > len(ends) else ends[k - 1] for k in (a, b)])
    return n, tuple(cuts.tolist()), tuple(index.to_char(cuts).tolist())


def _one(raw: np.ndarray, doc_id, s: Settings, marks: list[bytes]) -> tuple:
    text = raw.tobytes()
    h1, h2, h3, h4 = draws(doc_id, s.seed)
    n, (i, j), (ci, cj) = split(raw, h1, h2, s.unit)
    if not text or h3 % 100 >= s.rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    p, u, m = marks
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < s.spm:
        return n, "spm", ci, cj - ci, b"".join((u, suffix, p, prefix, m, middle))
    return n, "psm", ci, cj - ci, b"".join((p, prefix, u, suffix, m, middle))


def transform(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` with ``fim`` struct(n units, form, prefix_chars, middle_chars, output)."""
    (out,) = fresh(docs.columns, "fim")
    marks = [m.encode() for m in settings.sentinels]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            texts = b.column(text_col).cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            missing = texts.is_null().to_pylist()
            rows = [_one(raw[0:0] if none else raw[x:y], i, settings, marks)
                    for i, x, y, none in zip(b.column(id_col).to_pylist(), at[:-1], at[1:], missing)]
            n, form, prefix, middle, output = zip(*rows)
            fields = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                      pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
            fim = pa.StructArray.from_arrays(fields, ["n", "form", "prefix_chars", "middle_chars", "output"])
            yield pa.RecordBatch.from_arrays([*b.columns, fim], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, RESULT)]))


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text that ``output`` was made of: the parts between the sentinels in order."""
    part = F.split(output, "|".join(re.escape(m) for m in settings.sentinels), -1)
    return (F.when(form == "psm", F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2)))
            .when(form == "spm", F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1))).otherwise(output))
