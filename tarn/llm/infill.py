"""Fill-in-middle texts with a learned rank index (operator 11).

A text is cut into units (runs of ASCII letters, or one other code point).
Where unit r begins is a question to an index over the text's boundaries: a
piecewise-linear function from rank to byte offset, fitted so that no
boundary is further than ``ERROR`` bytes from it (a cone of slopes that
shrinks with every boundary; a segment ends where it closes), and one stored
residual byte per boundary. A cut is predicted by its segment and made
exact by its residual, so it takes two look-ups however long the text is,
and an index takes little more than a byte per unit.

``fill_in_middle`` gives each document's form and output text, cut at two
ranks drawn from the sha256 of its id; ``restore`` gives the text back;
``boundary_index`` gives the index itself as a table, and ``RankIndex``
reads its rows.

A document is plain (left as it is) if its text is empty or holds one of
the control strings ``<P>``, ``<S>``, ``<M>``, or by the draw of its id.
Markers never overlap each other, so an output has each exactly once.

Nulls: a null text is empty; a null id is drawn as the empty decimal. Ties:
equal ranks give empty parts. Very long texts are indexed whole. Repeated
rows give equal rows. Empty table: no rows. Extra columns are ignored. Rows
are independent: nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_bytes, text_slices

ERROR = 63
STEP = 512                 # boundaries that a segment tries at first
SEED = "1:"
PLAIN_FROM, SPM_BELOW = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class RankIndex:
    """``first``: the rank where each segment begins, ``base``: its offset,
    ``slope``: bytes per unit, ``residual``: of every boundary."""
    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @staticmethod
    def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Index of ascending offsets."""
        first, base, slope, at, n = [], [], [], 0, len(offsets)
        while at < n:
            low, high, size, step, middle = -np.inf, np.inf, 1, STEP, 0.0
            while at + size < n:                      # more boundaries while the cone is open
                k = np.arange(size, min(size + step, n - at))
                rise = offsets[at + k] - offsets[at]
                lows = np.maximum(np.maximum.accumulate((rise - error) / k), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / k), high)
                closed = lows > highs
                use = int(closed.argmax()) if closed.any() else len(k)
                if use:
                    low, high = lows[use - 1], highs[use - 1]
                    middle = (low + high) / 2
                size, step = size + use, 2 * step
                if use < len(k):
                    break
            first.append(at)
            base.append(offsets[at])
            slope.append(middle)
            at += size
        index = RankIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope), np.empty(0, np.int8))
        residual = offsets - index.predict(np.arange(n))
        return RankIndex(index.first, index.base, index.slope, residual.astype(np.int8 if error < 127 else np.int64))

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of the boundaries of these ranks."""
        return self.predict(ranks) + self.residual[ranks]


def boundaries(off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (UTF-8 bytes ``raw``, text i from off[i]):
    (where units begin, first of them of each text, code points before each
    byte)."""
    begins = (raw & 0xC0) != 0x80
    letter = ((raw | 32) - np.uint8(97)) < 26
    unit = begins.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    unit[off[:-1][off[:-1] < off[1:]]] = True
    at = np.flatnonzero(unit)
    return at, np.searchsorted(at, off), np.concatenate([[0], np.cumsum(begins)])


def _indexes(part: pa.RecordBatch, column: int):
    """(text number, its bytes, its index, code points before its bytes)."""
    off, raw = text_bytes(part.column(column))
    at, first, before = boundaries(off, raw)
    for i, (a, b) in enumerate(zip(off.tolist(), off[1:].tolist())):
        ends = np.append(at[first[i]: first[i + 1]], b) - a
        yield i, raw[a:b].tobytes(), RankIndex.fit(ends), before[a: b + 1]


_FORMED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
_FORMED_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_P, _S, _M = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()


def _form(batches):
    for batch in batches:
        for part in text_slices(batch, 1):
            draws = [part.column(c).to_pylist() for c in range(2, 6)]
            out = [[] for _ in _FORMED]
            for (i, text, index, before), h1, h2, h3, h4 in zip(_indexes(part, 1), *draws):
                n = len(index.residual) - 1
                if not text or h3 % 100 >= PLAIN_FROM or _P in text or _S in text or _M in text:
                    row = (n, "plain", None, None, text)
                else:
                    a, b = index.offset(np.sort([h1 % (n + 1), h2 % (n + 1)])).tolist()
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
                    output = _S + suffix + _P + prefix + _M + middle if form == "spm" else _P + prefix + _S + suffix + _M + middle
                    row = (n, form, int(before[a] - before[0]), int(before[b] - before[a]), output)
                for column, value in zip(out[1:], row):
                    column.append(value)
            out[5] = pa.array(out[5], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out[1:5], _FORMED.types[1:5])), out[5]], schema=_FORMED)


def draws(doc_id: Column) -> list[Column]:
    """h1 to h4 of an id."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every
    document; the sizes count code points and are null where it is plain."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       *(h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id")), 1)))
    return rows.mapInArrow(_form, _FORMED_SQL)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = lambda i: F.get(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1), F.lit(i))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
            .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))


_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("first", pa.list_(pa.int64())), ("base", pa.list_(pa.int64())), ("slope", pa.list_(pa.float64())), ("residual", pa.binary())])


def _index_rows(batches):
    for batch in batches:
        for part in text_slices(batch, 1):
            rows = [(len(x.residual) - 1, x.first, x.base, x.slope, x.residual.tobytes()) for _, _, x, _ in _indexes(part, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(_INDEX.types[1:]))], schema=_INDEX)


def boundary_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n, first, base, slope, residual): the rank index of every
    text over the byte offsets of its n + 1 boundaries."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_index_rows, "doc_id long, n long, first array<long>, base array<long>, slope array<double>, residual binary")


def read_index(row) -> RankIndex:
    """The index of a row of :func:`boundary_index`."""
    return RankIndex(np.array(row["first"], np.int64), np.array(row["base"], np.int64), np.array(row["slope"]), np.frombuffer(row["residual"], np.int8))


OP11_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM units),
ranks AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM ranks)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def op11_infill_index(spark, sf_dir: str) -> DataFrame:
    formed = fill_in_middle(read_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                         digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
