"""License scans: fuzzy search for short notices (operator 1).

Texts are reduced to words (A-Z lower-cased) joined by one space. A notice
with at most ``e`` errors is cut into ``e + 1`` seeds: by the pigeonhole
principle one of them stands unchanged in every match. Seeds are found
exactly, the stretch around each is verified by the ``regex`` library's
bounded-error matching between word boundaries, and matches are reported
as spans. The base phrases are also counted exactly, at every place.

Row per document: n_words, n_base, first_word, last_word, base_labels,
labels, score (1 for a base phrase, else the best match's 1 - errors /
length, else 0) and ``spans`` (label, errors, first_word, n_words, text).

Nulls: a null text is empty (0 words, no label, score 0); a null id is
kept. Repeated rows are scanned each on its own. Texts are scanned whole,
whatever their length. Empty table: no rows. Extra columns are ignored.
A scan never moves a text between tasks, so no key can be hot.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_bytes, text_slices


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    errors: int


#: Base phrases, looked for exactly (fixed values).
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Notices searched with bounded errors (fixed values).
NOTICES = (
    Notice("mit", "mit license", 1),
    Notice("apache", "apache license", 1),
    Notice("gpl", "general public license", 2),
    Notice("lgpl", "lesser general public license", 2),
    Notice("agpl", "affero general public license", 2),
    Notice("mpl", "mozilla public license", 2),
    Notice("bsd", "bsd license", 1),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mit", "permission is hereby granted free of charge to any person", 4),
    Notice("cc", "creative commons attribution", 2),
    Notice("proprietary", "all rights reserved", 1),
)

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,errors:int,first_word:long,n_words:int,text:string>>")
_SPAN = pa.struct([("label", pa.string()), ("errors", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int32()), ("text", pa.string())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


def seeds(phrase: str, errors: int) -> list[tuple[int, bytes]]:
    """(offset, seed): ``errors + 1`` nearly equal pieces of the phrase."""
    raw, k = phrase.encode(), errors + 1
    cuts = [len(raw) * i // k for i in range(k + 1)]
    return [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:])]


def _places(text: bytes, what: bytes):
    at = text.find(what)
    while at >= 0:
        yield at
        at = text.find(what, at + 1)


def _matches(pattern, text: bytes, windows: list[tuple[int, int]], least: int):
    """Matches of all windows that do not overlap, those with the fewest
    errors first. A window whose match was taken by a better one is searched
    again in what is left of it; windows are little longer than a notice, so
    the work grows with their number."""
    found: list[tuple[int, int, int, int, int]] = []

    def look(lo: int, hi: int) -> None:
        if hi - lo >= least and (m := pattern.search(text, lo, hi)):
            heapq.heappush(found, (sum(m.fuzzy_counts), m.start(), m.end(), lo, hi))
    for lo, hi in windows:
        look(lo, hi)
    starts: list[int] = []
    ends: list[int] = []
    while found:
        errors, start, end, lo, hi = heapq.heappop(found)
        i = bisect_right(ends, start)
        if i == len(starts) or starts[i] >= end:
            starts.insert(i, start)
            ends.insert(i, end)
            yield start, end, errors
            continue
        i = bisect_right(ends, lo)
        while i < len(starts) and starts[i] < hi:      # a match ends a word: what lies before ends at the space
            look(lo, starts[i] - 1)
            lo, i = ends[i], i + 1
        look(lo, hi)


class Scanner:
    """Searches a run of normalised documents, each between line feeds."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        import regex

        self.notices = [(n, seeds(n.phrase, n.errors),
                         regex.compile(rb"(?<![^ \n])(?:" + regex.escape(n.phrase.encode()) + rb"){e<=" + str(n.errors).encode() + rb"}(?![^ \n])", regex.BESTMATCH))
                        for n in notices]

    def base(self, text: bytes):
        """(place, label) of every base phrase."""
        for label, phrase in BASE:
            what = phrase.encode()
            for at in _places(text, what):
                if text[at - 1] in b" \n" and text[at + len(what)] in b" \n":
                    yield at, label

    def fuzzy(self, text: bytes, starts: list[int]):
        """(start, end, errors, label) of every verified stretch; ``starts``
        are the documents' places in ``text``."""
        for notice, parts, pattern in self.notices:
            size, e = len(notice.phrase), notice.errors
            windows = []
            for at, offset in sorted({(place - offset, offset) for offset, seed in parts for place in _places(text, seed)}):
                d = bisect_right(starts, at + offset) - 1
                first, last = starts[d], starts[d + 1] - 1 if d + 1 < len(starts) else len(text) - 1
                # from the first word that can begin the notice to the last that can end it
                lo, hi = max(first, at - e), min(last, at + size + e)
                if lo > first and text[lo - 1] != 32:
                    lo = text.find(b" ", lo, hi) + 1
                if hi < last and text[hi] != 32:
                    hi = text.rfind(b" ", lo, hi)
                if 0 < lo < hi and (not windows or windows[-1] != (lo, hi)):
                    windows.append((lo, hi))
            for start, end, errors in _matches(pattern, text, windows, size - e):
                yield start, end, errors, notice.label


class _WordCounter:
    """Number of the word that starts at a place; places must not fall."""

    def __init__(self, text: bytes, start: int):
        self.text, self.at, self.n = text, start, 0

    def __call__(self, at: int) -> int:
        self.n += self.text.count(b" ", self.at, at)
        self.at = at
        return self.n


def _scan(batches):
    scanner = Scanner()
    for batch in (part for b in batches for part in text_slices(b, 1, 16 << 20)):
        off, raw = text_bytes(batch.column(1))
        raw, off = raw.tobytes(), off.tolist()
        starts, parts, counts, at = [], [b"\n"], [], 1
        for a, b in zip(off, off[1:]):
            words = normal_words(raw[a:b])
            joined = b" ".join(words)
            starts.append(at)
            counts.append(len(words))
            parts += [joined, b"\n"]
            at += len(joined) + 1
        text = b"".join(parts)
        yield _report(batch.column(0), text, starts, counts, scanner)


def _report(ids, text: bytes, starts: list[int], counts: list[int], scanner: Scanner) -> pa.RecordBatch:
    base: dict[int, list] = {}
    for at, label in scanner.base(text):
        base.setdefault(bisect_right(starts, at) - 1, []).append((at, label))
    spans: dict[int, dict] = {}
    for lo, hi, errors, label in scanner.fuzzy(text, starts):
        own = spans.setdefault(bisect_right(starts, lo) - 1, {})
        own[(lo, hi, label)] = min(errors, own.get((lo, hi, label), errors))
    columns: list[list] = [[] for _ in range(8)]
    for d, start in enumerate(starts):
        hits, found = sorted(base.get(d, ())), sorted(spans.get(d, {}).items())
        word, near = _WordCounter(text, start), _WordCounter(text, start)
        own = sorted({label for _, label in hits})
        score = 1.0 if hits else max((1 - e / (hi - lo + e) for (lo, hi, _), e in found), default=0.0)
        row = (counts[d], len(hits), word(hits[0][0]) if hits else None, word(hits[-1][0]) if hits else None,
               ",".join(own), ",".join(sorted({*own, *(k[2] for k, _ in found)})), max(0.0, min(1.0, score)),
               [{"label": label, "errors": e, "first_word": near(lo), "n_words": text.count(b" ", lo, hi) + 1, "text": text[lo:hi].decode("utf-8", "replace")}
                for (lo, hi, label), e in found])
        for c, v in zip(columns, row):
            c.append(v)
    return pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(columns, list(_ARROW)[1:]))], schema=_ARROW)


def scan_licenses(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_scan, SCHEMA)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
