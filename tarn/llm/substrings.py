"""Removal of repeated byte strings with suffix arrays (operator 9).

Every byte covered by a 100-byte string that also starts earlier (smaller
id, or the same document and an earlier start) is removed; strings never
cross documents and are judged on the input.

1. Winnowing: each 100-byte string has an anchor, the smallest hashed
   32-gram in it (the first of equals), so equal strings have equal
   anchors at equal distance. The starts that share one anchor form a run;
   its context is the bytes of all its strings. Runs are keyed by the
   anchor's hash. Contexts that are equal as a whole within one batch are
   reduced to the first before the shuffle, so a line with a third of all
   rows sends one row per batch.
2. Per anchor, equal contexts are reduced to the first: the starts of the
   others all have an earlier equal string. Anchors with one context
   need no more.
3. Different contexts of one anchor may share strings in part. They go to
   shards by anchor, where a suffix array is built by induced sorting with
   its permuted common prefixes (``suffix.py``): neighbours that share 100
   bytes or more form a class, and all starts of a class but the earliest
   are repeats.
4. An anchor with more than ``hot`` different contexts would make a shard
   grow without bound. Its strings are keyed each by its own hash instead,
   with partial aggregation: an exact way of the same result.

Ties: rows with one id are ordered by their text's hash; rows with equal
id and text count as one document and share one result. Nulls: a null text
is empty; a null id comes first. Very long texts are read in slices and
kept whole. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table, splitmix, text_bytes, text_slices
from .suffix import concatenate, permuted_lcp, suffix_array

SPAN = 100
GRAM = 32
HOT = 50_000
SHARD_BYTES = 4 << 20
SLICE = 2 << 20
_B = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LEN_BITS, _OFF_BITS = 8, 31     # a run's place: number among equal ids | offset | number of starts


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_B, n, 1 << 64))


def _grams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 4-grams and all GRAM-grams."""
    h, size, four = _BYTE[raw], 1, None
    while size < GRAM:
        h = h[:-size] * _power(size) + h[size:]
        size *= 2
        if size == 4:
            four = h
    return four, h


def _string_hash(four: np.ndarray, long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the SPAN-byte strings that start at ``at``."""
    step = _power(GRAM)
    h = (long[at] * step + long[at + GRAM]) * step + long[at + 2 * GRAM]
    return splitmix(h * _power(4) + four[at + 3 * GRAM])


def _smallest(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest value of every window, the first of equals."""
    low = np.uint64((1 << 24) - 1)
    cur, size = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * size <= window:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    rest = window - size
    if rest:
        cur = np.minimum(cur[:-rest], cur[rest:])
    return (cur & low).astype(np.int64)


def runs(off: np.ndarray, raw: np.ndarray):
    """(document, offset, starts, anchor hash, context hash) of all runs."""
    total = len(raw)
    out = [[np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2]
    for a in range(0, max(0, total - SPAN + 1), SLICE):
        part = raw[a: a + SLICE + SPAN - 1]
        four, long = _grams(part)
        anchors = splitmix(long)
        place = _smallest(anchors, SPAN - GRAM + 1)
        starts = np.arange(a, a + len(place))
        doc = np.searchsorted(off, starts, side="right") - 1
        inside = starts + SPAN <= off[doc + 1]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        s = np.flatnonzero(first)
        if not len(s):
            continue
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        e = np.flatnonzero(last)
        d = doc[s]
        context = splitmix(_string_hash(four, long, s) * _power(3) + _string_hash(four, long, e) + (e - s).astype(np.uint64))
        out.append([d, a + s - off[d], e - s + 1, anchors[place[s]], context])
    return [np.concatenate(c) for c in zip(*out)]


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Union of intervals per document; touching ones join."""
    if not len(doc):
        return doc, lo, hi
    by = np.lexsort((lo, doc))
    doc, lo, hi = doc[by], lo[by], hi[by]
    # documents are kept apart by an offset larger than any place
    _, rank = np.unique(doc, return_inverse=True)
    shift = rank.astype(np.int64) * (np.int64(1) << 32)
    reach = np.maximum.accumulate(hi + shift)
    new = np.append(True, lo[1:] + shift[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return doc[at], lo[at], np.append(reach[at[1:] - 1], reach[-1]) - shift[at]


_RUN = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("rid", pa.int64()), ("place", pa.int64())])
_RUN_DDL = "anchor long, context long, rid long, place long"


def _scan(batches):
    """Runs of a batch; equal contexts are reduced to the first, and the
    others, already known to be repeats, leave as merged intervals (place
    with 0 starts, its end in ``context``)."""
    for batch in (part for b in batches for part in text_slices(b, 2, 16 << 20)):
        rid = batch.column(0).to_numpy(zero_copy_only=False)
        sub = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        d, at, n, anchor, context = runs(*text_bytes(batch.column(2)))
        if not len(d):
            continue
        place = ((sub[d] << _OFF_BITS | at) << _LEN_BITS) | n
        by = np.lexsort((place, rid[d], context, anchor))
        first = np.append(True, (anchor[by][1:] != anchor[by][:-1]) | (context[by][1:] != context[by][:-1]))
        head = by[first][np.cumsum(first) - 1]              # repeated rows hold the same place twice: no copy
        keep, copy = by[first], by[~first & ((rid[d][by] != rid[d][head]) | (place[by] != place[head]))]
        cd, lo, hi = _merged(d[copy], at[copy], at[copy] + n[copy] - 1 + SPAN)
        salt = splitmix(np.arange(len(cd), dtype=np.uint64) + np.uint64(int(at[0]) + len(d)))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([anchor[keep], salt]).view(np.int64)),
            pa.array(np.concatenate([context[keep].view(np.int64), hi])),
            pa.array(np.concatenate([rid[d][keep], rid[cd]])),
            pa.array(np.concatenate([place[keep], (sub[cd] << _OFF_BITS | lo) << _LEN_BITS]))], schema=_RUN)


_PIECE = pa.schema([("shard", pa.int64()), ("rid", pa.int64()), ("sub", pa.int64()), ("lo", pa.int64()), ("bytes", pa.binary())])
_PIECE_DDL = "shard long, rid long, sub long, lo long, bytes binary"


def _extract(batches):
    """Bytes of the contexts asked for; (text, sub, [(shard, lo, n)]) per document."""
    for batch in batches:
        cols = [[], [], [], [], []]
        for rid, sub, text, asked in zip(*(batch.column(i) for i in range(4))):
            raw = (text.as_py() or "").encode()
            for ask in asked.as_py():
                for c, v in zip(cols, (ask["shard"], rid.as_py(), sub.as_py(), ask["lo"], raw[ask["lo"]: ask["lo"] + ask["n"] - 1 + SPAN])):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECE)], schema=_PIECE)


_SPANS_DDL = "rid long, sub long, lo long, hi long"


def shard_repeats(rid: np.ndarray, sub: np.ndarray, lo: np.ndarray, strings: list[bytes], span: int = SPAN):
    """(rid, sub, lo, hi) covered by strings of ``span`` bytes that also
    start earlier among these contexts."""
    t, seps = concatenate(strings)
    sa = suffix_array(t, seps)
    plcp, _ = permuted_lcp(t, sa, seps)
    joined = plcp[sa] >= span                 # shares ``span`` bytes with the one before it
    member = joined.copy()
    member[:-1] |= joined[1:]
    sel = np.flatnonzero(member)
    if not len(sel):
        return (np.empty(0, np.int64),) * 4
    where = sa[sel].astype(np.int64)
    string = np.searchsorted(seps, where)
    begin = np.append(0, seps[:-1] + 1)
    offset = lo[string] + where - begin[string]
    _, doc = np.unique(np.stack([rid, sub]), axis=1, return_inverse=True)
    key = (doc.reshape(-1).astype(np.int64)[string] << 32) | offset      # order of places
    heads = np.flatnonzero(~joined[sel])
    least = np.minimum.reduceat(key, heads)
    later = key > np.repeat(least, np.diff(np.append(heads, len(key))))
    d, at = (key[later] >> 32), offset[later]
    names = np.full(int(doc.max()) + 1, -1)
    names[doc.reshape(-1)] = np.arange(len(rid))
    md, mlo, mhi = _merged(d, at, at + span)
    return rid[names[md]], sub[names[md]], mlo, mhi


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    out = shard_repeats(pdf["rid"].to_numpy(), pdf["sub"].to_numpy(), pdf["lo"].to_numpy(), pdf["bytes"].tolist())
    return pd.DataFrame(dict(zip(("rid", "sub", "lo", "hi"), out)))


def _each_string(batches):
    """Hash of every string of the contexts asked for."""
    schema = pa.schema([("string", pa.int64()), ("rid", pa.int64()), ("sub", pa.int64()), ("lo", pa.int64())])
    for batch in batches:
        hashes, rids, subs, los = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for rid, sub, lo, data in zip(*(batch.column(c) for c in ("rid", "sub", "lo", "bytes"))):
            raw = np.frombuffer(data.as_buffer(), np.uint8)
            four, long = _grams(raw)
            at = np.arange(len(raw) - SPAN + 1)
            hashes.append(_string_hash(four, long, at))
            rids.append(np.full(len(at), rid.as_py()))
            subs.append(np.full(len(at), sub.as_py()))
            los.append(at + lo.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), *(pa.array(np.concatenate(c)) for c in (rids, subs, los))], schema=schema)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))), ("kept", pa.binary())])
_KEPT_DDL = "doc_id long, n_bytes long, spans array<struct<lo:long,hi:long>>, kept binary"


def _cut(batches):
    for batch in (part for b in batches for part in text_slices(b, 1, 16 << 20)):
        sizes, spans, kept = [], [], []
        off, raw = text_bytes(batch.column(1))
        raw, off = raw.tobytes(), off.tolist()
        for a, b, cover in zip(off, off[1:], batch.column(2)):
            text, own, at, rest = raw[a:b], [], 0, []
            for lo, hi in sorted((c["lo"], c["hi"]) for c in cover.as_py() or ()):
                if own and lo <= own[-1]["hi"]:
                    own[-1]["hi"] = max(own[-1]["hi"], hi)
                else:
                    own.append({"lo": lo, "hi": hi})
            for s in own:
                rest.append(text[at: s["lo"]])
                at = s["hi"]
            rest.append(text[at:])
            sizes.append(len(text))
            spans.append(own)
            kept.append(b"".join(rest))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, _KEPT.field("spans").type), pa.array(kept, pa.binary())], schema=_KEPT)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed runs and the bytes left."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), lowest).alias("rid"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        rows = rows.withColumn("sub", F.lit(0).cast("long"))
    else:
        rows = rows.withColumn("sub", F.dense_rank().over(Window.partitionBy("rid").orderBy(F.xxhash64("text"))).cast("long") - 1)

    found = rows.select("rid", "sub", "text").mapInArrow(_scan, _RUN_DDL)
    n = F.col("place").bitwiseAND(F.lit((1 << _LEN_BITS) - 1).cast("long"))
    lo = F.shiftright("place", _LEN_BITS).bitwiseAND(F.lit((1 << _OFF_BITS) - 1).cast("long"))
    sub = F.shiftright("place", _LEN_BITS + _OFF_BITS)
    equal = Window.partitionBy("anchor", "context").orderBy("rid", "place")
    of_anchor = Window.partitionBy("anchor")
    judged = (found.withColumn("n", n).withColumn("nth", F.rank().over(equal))
              .withColumn("least", F.min("context").over(of_anchor)).withColumn("most", F.max("context").over(of_anchor))
              .withColumn("contexts", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(of_anchor)))
    kind = F.when(F.col("n") == 0, 0).when(F.col("nth") > 1, 1).when(F.col("least") != F.col("most"), F.when(F.col("contexts") > hot, 3).otherwise(2))
    judged = scratch.save(judged.withColumn("kind", kind).where("kind IS NOT NULL")
                          .select("kind", "anchor", "rid", sub.alias("sub"), lo.alias("lo"), "n",
                                  F.when(F.col("n") == 0, F.col("context")).otherwise(lo + F.col("n") + (SPAN - 1)).alias("hi")), "judged")
    copies = judged.where("kind <= 1").select("rid", "sub", "lo", "hi")

    # bytes of the contexts that differ under one anchor
    asked = judged.where("kind >= 2")
    size = asked.where("kind = 2").agg(F.sum(F.col("n") + SPAN)).first()[0] or 0
    shards = max(-(-size // SHARD_BYTES), min(32, -(-size // (SHARD_BYTES // 16))), 1)
    asked = (asked.groupBy(F.col("rid").alias("_rid"), F.col("sub").alias("_sub"))
             .agg(F.collect_list(F.struct(F.when(F.col("kind") == 2, F.pmod("anchor", F.lit(shards))).otherwise(F.lit(-1)).cast("long").alias("shard"), "lo", "n")).alias("asked")))
    # both joins read one and the same exchange of the texts
    texts = rows.select("rid", "sub", "text", "doc_id")
    pieces = (texts.join(asked, (F.col("rid") == F.col("_rid")) & (F.col("sub") == F.col("_sub")))
              .select("rid", "sub", "text", "asked", "doc_id").mapInArrow(_extract, _PIECE_DDL))
    spans = copies.unionByName(pieces.where("shard >= 0").groupBy("shard").applyInPandas(_shard, _SPANS_DDL))
    if not judged.where("kind = 3").isEmpty():
        # anchors with too many contexts: string by string
        strings = scratch.save(pieces.where("shard < 0").mapInArrow(_each_string, "string long, rid long, sub long, lo long"), "strings")
        earliest = strings.groupBy(F.col("string").alias("_string")).agg(F.min(F.struct("rid", "sub", "lo")).alias("first"))
        spans = spans.unionByName(
            strings.join(earliest, F.col("string") == F.col("_string"))
            .where(F.struct("rid", "sub", "lo") != F.col("first")).select("rid", "sub", "lo", (F.col("lo") + SPAN).alias("hi")))
    cover = (spans.groupBy(F.col("rid").alias("_rid"), F.col("sub").alias("_sub"))
             .agg(F.collect_list(F.struct("lo", "hi")).alias("cover")))
    return (texts.join(cover, (F.col("rid") == F.col("_rid")) & (F.col("sub") == F.col("_sub")), "left")
            .select("doc_id", "text", "cover", "rid", "sub").mapInArrow(_cut, _KEPT_DDL))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
