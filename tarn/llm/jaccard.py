"""N-gram Jaccard join by partition and pigeonhole (operator 6).

Documents whose sets of word shingles are similar enough (100 x
intersection >= 85 x union) are linked; components of links are returned.

Method. Equal sets are one class, known by a fingerprint. For the rest,
sets are put in size bands whose ends differ by the ratio 1 / 0.85, so a
partner lies in the same or the next band, and a set takes part in the
scheme of its own band (with partners of its size or larger) and of the
band below (with smaller partners). A scheme cuts the universe of hashed
shingles into ``m`` segments. Two similar sets differ in at most ``H``
shingles (the Hamming distance that the threshold allows), so segments
with allowances e_i in {-1, 0, 1}, sum(e_i + 1) > H, leave one segment
that differs by at most its allowance. Allowance 0 is an equal segment:
its fingerprint is the index key. Allowance 1 is found through the
one-deletion neighbourhood, which the first ``d`` segments are indexed
with. ``m`` and ``d`` of a band minimise an estimate of keys and chance
meetings; in each set the allowances go to the cheapest segments (most
shingles); an empty segment, which meets every other empty one, gets one
only if nothing else reaches the sum. Keys of other segments are indexed
but not probed. Every candidate is verified exactly.

Candidates come in rounds, since only components matter: a key's members
are first held against its smallest probing member, its hub; after
components of those links are known, pairs of one key that still lie in
different components are looked at: all of them in a key with few members;
larger keys of one hub, which near copies share, are one group where that
makes no more pairs, and of a group's members each outside its largest
component names those that look nearest. A group where none has more is
settled. To the others the sets themselves come, and the links that join
their components are found there, nearest first: a group gives fewer links
than it has members, however many of its pairs look near.
Parity sketches (a bit or two per shingle) rule out pairs exactly, so sets
are only brought together for pairs that are nearly similar; a group with
many members is compared block by block, blocks of its largest component
with blocks outside it only. Nothing is
capped: a group of thousands of near copies costs a star and the pairs of
what the star missed, not all pairs.

Nulls: a null or blank text has an empty set and is linked with nothing
(its component is its own id); a null id is never a component's name
unless no other id is there. Repeated rows and equal texts are one class.
Very long texts are taken whole. Empty table: no rows. Extra columns are
ignored. A class with a third of all rows sends one copy of its keys per
task, not one per row.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table, splitmix, text_bytes, text_slices
from .graph import connected_components
from .shingles import set_id, shingle_sets

SHINGLE = 4
PERCENT = 85
#: Up to so many document ids may be broadcast (8 bytes each, counted first).
BROADCAST_IDS = 500_000
#: A group with more members than this, or with more shingles in all, is
#: compared block by block.
BLOCK_ROWS = 4000
BLOCK_SHINGLES = 2_000_000
#: Up to so many members of a key, all its pairs are named before their
#: sketches are brought together; beyond, sketches go to the key.
SMALL_ROWS = 16
#: Pairs that a member of a larger key names before sets are sent to the key.
NEAREST = 4
_ONE = np.uint64(1)
_SEED = np.uint64(0xD6E8FEB86659FD93)


# -- the plan of a size band --------------------------------------------------

def bands(limit: int, percent: int = PERCENT) -> list[int]:
    """Largest set size of each band, up to one beyond ``limit``."""
    tops = [1]
    while tops[-1] < limit:
        low = tops[-1] + 1
        tops.append(max(low, low * 100 // percent))
    tops.append((tops[-1] + 1) * 100 // percent)
    return tops


def hamming(a: int, b: int, percent: int = PERCENT) -> int:
    """Most shingles in which linked sets of sizes ``a`` and ``b`` differ."""
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def plan(top: int, percent: int = PERCENT) -> tuple[int, int]:
    """(segments m, of them d with one-deletion keys) for the band that ends at ``top``."""
    need = hamming(top, top * 100 // percent, percent) + 1
    best = None
    for d in range(0, min(need, 12 + need // 64) + 1):
        m = max(d + max(0, need - 2 * d), 1)
        size = top / m
        keys = m + d * size
        empty = m * math.exp(-size)
        thin = m * size * math.exp(-size)
        # an empty segment beyond the reserve is probed at a high price
        cost = keys + 4 * thin + 200 * max(0.0, empty - d) + 2 * empty
        if best is None or cost < best[0]:
            best = (cost, m, d)
    return best[1], best[2]


# -- keys of a set ------------------------------------------------------------

def set_keys(own: np.ndarray, band: int, m: int, d: int, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, probed) of a sorted set in one scheme; ``differ``: most
    shingles in which a partner of this scheme can differ."""
    cuts = np.searchsorted(own >> np.uint64(32), (np.arange(1, m, dtype=np.uint64) << np.uint64(32)) // np.uint64(m) + _ONE, side="left")
    ends = np.append(cuts, len(own))
    starts = np.append(0, cuts)
    sizes = ends - starts
    value = splitmix(own ^ _SEED)
    upto = np.append(np.uint64(0), np.cumsum(value, dtype=np.uint64))
    sums = upto[ends] - upto[starts]
    tag = splitmix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
    exact = splitmix(sums + tag + sizes.astype(np.uint64) * _SEED)

    # allowances: 2 for a segment with one-deletion keys and two shingles or
    # more, 1 for another segment with shingles, 0 for an empty one
    gain = np.minimum(sizes, 1)
    gain[:d] = np.minimum(sizes[:d], 2)
    probe = gain > 0
    spare = int(gain.sum()) - (differ + 1)
    empties = np.zeros(d, bool)                     # one-deletion keys of single shingles: the empty key
    if spare > 0:                                   # leave out the dearest segments
        order = np.argsort(sizes, kind="stable")
        order = order[gain[order] > 0]
        drop = order[np.cumsum(gain[order]) <= spare]
        probe[drop] = False
    elif spare < 0:                                 # take in empty segments, or the empty neighbour of single shingles
        for i in np.flatnonzero((sizes == 0) | ((np.arange(m) < d) & (sizes == 1))).tolist():
            if spare >= 0:
                break
            if sizes[i] == 0:
                probe[i] = True
                spare += 2 if i < d else 1
            else:
                empties[i] = True
                spare += 1
    keys, probed = [exact], [probe]
    if d:
        upper = int(ends[d - 1])
        seg = np.repeat(np.arange(d), sizes[:d])
        keys.append(splitmix(sums[seg] - value[:upper] + tag[seg] + (sizes[seg] - 1).astype(np.uint64) * _SEED))
        probed.append(np.where(sizes[seg] >= 2, probe[seg], empties[seg]))
    return np.concatenate(keys), np.concatenate(probed)


def _band_of(n: int, tops: list[int]) -> int:
    return int(np.searchsorted(tops, n))


def _schemes(n: int, tops: list[int], percent: int):
    """(band, m, d, most that a partner differs) of a set of size n."""
    b = _band_of(n, tops)
    differ = hamming(n, n * 100 // percent, percent)
    if differ:
        yield (b, *plan(tops[b], percent), differ)
    if b > 0:
        differ = hamming(n, tops[b - 1], percent)
        if differ:
            yield (b - 1, *plan(tops[b - 1], percent), differ)


def _grown(tops: list[int], n: int, percent: int) -> list[int]:
    return tops if tops[-1] >= n else bands(2 * n, percent)


def _members(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), ("sketch", pa.binary())])

    def run(batches):
        for batch in (part for b in batches for part in text_slices(b, 3)):
            sizes, sids, sketches = [], [], []
            for own in shingle_sets(*text_bytes(batch.column(3)), k):
                sizes.append(len(own))
                sids.append(set_id(own) if len(own) else None)
                sketches.append(sketch(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()), pa.array(sketches, pa.binary())], schema=schema)
    return run, "doc_id long, rid long, text_key long, n_shingles long, sid long, sketch binary"


def _keys(k: int, percent: int):
    schema = pa.schema([("key", pa.int64()), ("member", pa.int64())])

    def run(batches):
        tops, seen = bands(1 << 15, percent), set()
        for batch in (part for b in batches for part in text_slices(b, 0)):
            keys, members = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for own in shingle_sets(*text_bytes(batch.column(0)), k):
                if not len(own) or (sid := set_id(own)) in seen:
                    continue
                seen.add(sid)
                tops = _grown(tops, len(own), percent)
                for scheme in _schemes(len(own), tops, percent):
                    own_keys, probed = set_keys(own, *scheme)
                    keys.append(own_keys)
                    members.append((sid << 1) | probed.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(members))], schema=schema)
    return run, "key long, member long"


def _sets(k: int):
    schema = pa.schema([("sid", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in (part for b in batches for part in text_slices(b, 0)):
            out = [(set_id(own), own.tobytes()) for own in shingle_sets(*text_bytes(batch.column(0)), k) if len(own)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], schema=schema)
    return run, "sid long, shingles binary"


# -- sketches: a cheap exact bound --------------------------------------------

def sketch(own: np.ndarray) -> bytes:
    """Parity bitmap of a set: every shingle flips the bit that its hash
    names, of at least one bit per shingle (a power of two). Two bitmaps
    differ in no more bits than the sets differ in shingles; a longer one
    is folded onto a shorter one first. Unrelated sets differ in half the
    bits, linked ones in no more than ``hamming``: more bits would rule out
    few more pairs, and sketches are most of what the join moves."""
    bits = max(64, 1 << (len(own) - 1).bit_length())
    parity = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").tobytes()


def sketch_distance(x: int, x_bits: int, y: int, y_bits: int) -> int:
    while x_bits > y_bits:
        x_bits >>= 1
        x = (x >> x_bits) ^ (x & ((1 << x_bits) - 1))
    while y_bits > x_bits:
        y_bits >>= 1
        y = (y >> y_bits) ^ (y & ((1 << y_bits) - 1))
    return (x ^ y).bit_count()


def far_apart(x: int, x_bits: int, n: int, y: int, y_bits: int, m: int, percent: int) -> bool:
    """True only if sets of sizes n and m with these sketches cannot link."""
    return (100 * min(n, m) < percent * max(n, m)
            or sketch_distance(x, x_bits, y, y_bits) > hamming(n, m, percent))


def _bits(raw: bytes) -> tuple[int, int]:
    return int.from_bytes(raw, "little"), 8 * len(raw)


def _near_pairs(percent: int):
    """(a, b, n_a, sketch_a, n_b, sketch_b) -> pairs that may link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("na", "xa", "nb", "xb")))
            keep = pa.array([not far_apart(*_bits(x), n, *_bits(y), m, percent) for n, x, m, y in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], schema=schema)
    return run, "a long, b long"


def _by_group(batches, key: str, columns: list[str]):
    """Lists of rows (tuples of ``columns``) of equal ``key``, from batches
    sorted by it."""
    group, rows = None, []
    for batch in batches:
        for g, *row in zip(*(batch.column(c).to_pylist() for c in (key, *columns))):
            if g != group:
                if rows:
                    yield rows
                group, rows = g, []
            rows.append(row)
    if rows:
        yield rows


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_PAIRS_DDL = "a long, b long"
_MORE = -1                           # (_MORE, key): the key left pairs for another round


def _sent(pairs, size: int = 50_000):
    """Distinct pairs of a task, as batches."""
    seen: set = set()
    for p in pairs:
        seen.add(p)
        if len(seen) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*seen)], schema=_PAIRS)
            seen = set()
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*seen)] if seen else [pa.array([], pa.int64())] * 2, schema=_PAIRS)


def _small_groups():
    """Rows (key, sid, probed, root) sorted by key -> all pairs of a key in
    different components, one of them probing."""
    def pairs(batches):
        for rows in _by_group(batches, "key", ["sid", "probed", "root"]):
            for i, (x, p, r) in enumerate(rows):
                for y, q, t in rows[:i]:
                    if r != t and (p or q):
                        yield (x, y) if x < y else (y, x)
    return (lambda batches: _sent(pairs(batches))), _PAIRS_DDL


class _Sketches:
    """Sketches of a group's members, folded to every length among them."""

    def __init__(self, raw: list[bytes], sizes, percent: int):
        self.n, self.percent = np.array(sizes, np.int64), percent
        self.words = np.array([len(r) // 8 for r in raw], np.int64)
        self.folded: dict[int, np.ndarray] = {}
        for w in np.unique(self.words).tolist():
            rows = np.zeros((len(raw), w), np.uint64)
            for v in np.unique(self.words[self.words >= w]).tolist():
                at = np.flatnonzero(self.words == v)
                own = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), np.uint64).reshape(len(at), v)
                while own.shape[1] > w:
                    half = own.shape[1] // 2
                    own = own[:, :half] ^ own[:, half:]
                rows[at] = own
            self.folded[w] = rows

    def near(self, i: int, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(members, distances) of those of ``may`` that ``i`` may link with."""
        n = self.n[i]
        at = np.flatnonzero(may & (100 * np.minimum(self.n, n) >= self.percent * np.maximum(self.n, n)))
        short, d = np.minimum(self.words[at], self.words[i]), np.empty(len(at), np.int64)
        for w in np.unique(short).tolist():
            own, here = self.folded[w], short == w
            d[here] = np.bitwise_count(own[at[here]] ^ own[i]).sum(axis=1, dtype=np.int64)
        keep = d <= hamming(self.n[at], n, self.percent)
        return at[keep], d[keep]


def _outside(roots: np.ndarray) -> list[int]:
    """Members that are not of a group's largest component."""
    names, of, sizes = np.unique(roots, return_inverse=True, return_counts=True)
    return np.flatnonzero(of != len(sizes) - 1 - np.argmax(sizes[::-1])).tolist()


def _large_groups(percent: int, nearest: int | None):
    """Rows (group, key, side, sid, probed, root, n, sketch) sorted by group
    -> pairs of a group in different components, one of them probing, that
    may link: of every member outside the group's largest component its
    ``nearest`` ones by sketch (None: all), and ``_MORE`` with the key where
    it has more. A group is a key's members or two of its blocks (sides 0
    and 1), of which pairs across are taken."""
    def of(rows):
        key = rows[0][0]
        side, sid, probed, root = (np.array([r[c] for r in rows], np.int64) for c in range(1, 5))
        sketches = _Sketches([r[6] for r in rows], [r[5] for r in rows], percent)
        two_sides = side.any()
        for i in _outside(root):
            may = root != root[i]
            if not probed[i]:
                may &= probed == 1
            if two_sides:
                may &= side != side[i]
            at, d = sketches.near(i, may)
            if nearest is not None and len(at) > nearest:
                at = at[np.lexsort((sid[at], d))[:nearest]]
                yield _MORE, key
            x = int(sid[i])
            for y in sid[at].tolist():
                yield (x, y) if x < y else (y, x)

    def pairs(batches):
        for rows in _by_group(batches, "group", ["key", "side", "sid", "probed", "root", "n", "sketch"]):
            yield from of(rows)
    return (lambda batches: _sent(pairs(batches))), _PAIRS_DDL


def _settled_groups(percent: int):
    """Rows (group, side, sid, probed, root, shingles) sorted by group ->
    pairs of a group that link, one of them probing, as few as join the
    components that all its links join: fewer than its members. Pairs are
    tested nearest first, and none whose sets are in one component by then."""
    def of(rows):
        side, sid, probed, root = (np.array([r[c] for r in rows], np.int64) for c in range(4))
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        sketches = _Sketches([sketch(own) for own in sets], [len(own) for own in sets], percent)
        two_sides, wanting = side.any(), np.ones(len(rows), bool)
        for i in _outside(root):
            wanting[i] = False                      # its pairs are all looked at now
            may = wanting & (root != root[i])
            if not probed[i]:
                may &= probed == 1
            if two_sides:
                may &= side != side[i]
            at, d = sketches.near(i, may)
            for j in at[np.argsort(d, kind="stable")].tolist():
                if root[i] != root[j] and _link(sets[i], sets[j], percent):
                    root[root == root[j]] = root[i]
                    yield (int(sid[i]), int(sid[j])) if sid[i] < sid[j] else (int(sid[j]), int(sid[i]))

    def pairs(batches):
        for rows in _by_group(batches, "group", ["side", "sid", "probed", "root", "shingles"]):
            yield from of(rows)
    return (lambda batches: _sent(pairs(batches))), _PAIRS_DDL


def _link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    """(a, b, set of a, set of b) -> pairs that link."""
    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                good[i] = _link(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], schema=_PAIRS)
    return run, _PAIRS_DDL


# -- the join -----------------------------------------------------------------

def similar_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block_rows: int = BLOCK_ROWS,
                       small_rows: int = SMALL_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return _components(docs, k, percent, block_rows, small_rows).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, k: int, percent: int, block_rows: int = BLOCK_ROWS, small_rows: int = SMALL_ROWS) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, root) of every document:
    ``text_key`` is a hash of its text, which tells rows of one id (or of
    none) apart; ``root`` is the component itself, null without words. Two
    components may have one name, where an id repeats."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    # rid: the id, or for a null id a hash of the text
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("rid"),
                       F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    members = scratch.save(rows.mapInArrow(*_members(k)), "members")

    indexed = rows.select("text").mapInArrow(*_keys(k, percent)).select("key", F.shiftright("member", 1).alias("sid"), F.col("member").bitwiseAND(F.lit(1).cast("long")).alias("probed"))
    of_key = Window.partitionBy("key")
    met = (indexed.withColumn("hub", F.min(F.when(F.col("probed") == 1, F.col("sid"))).over(of_key))
           .withColumn("low", F.min("sid").over(of_key)).withColumn("high", F.max("sid").over(of_key))
           .where("low <> high AND hub IS NOT NULL").select("key", "sid", "probed", "hub"))
    met = scratch.save(met, "met")

    reps = scratch.save(members.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("rid").alias("rid"), F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "reps")
    sketches = reps.select("sid", "n", "sketch")

    star = met.where("sid <> hub").select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()
    tested = scratch.save(_near(star, sketches, percent), "star")
    links = scratch.save(_verified(tested, rows, reps, scratch, "star", k, percent), "links")
    roots = connected_components(links, scratch, "first")
    # pairs of one key in different components: all of a small key, the nearest ones of a larger group
    mixed = scratch.save(_mixed(met, roots), "mixed")
    small = mixed.where(F.col("size") <= small_rows)
    groups = scratch.save(_merged(mixed.where(F.col("size") > small_rows), scratch).join(sketches, "sid"), "groups")
    found = scratch.save(_near(_pairs_of(small), sketches, percent).unionByName(_nearest_pairs(groups, percent, block_rows)).distinct()
                         .join(tested, ["a", "b"], "left_anti"), "cross")
    links, roots = _joined(links, roots, _verified(found.where("a >= 0"), rows, reps, scratch, "cross", k, percent), scratch, "more")
    again = found.where(F.col("a") == _MORE).select(F.col("b").alias("key"))
    if not again.isEmpty():                            # groups that left pairs: the sets come to the group
        left = scratch.save(_mixed(groups.join(again, "key", "left_semi").withColumn("hub", F.col("key")), roots, "n"), "left")
        links, roots = _joined(links, roots, _settled_pairs(left, rows, reps, scratch, k, percent, block_rows), scratch, "last")

    named = reps.select("sid", "first_id").join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid"))
    linked = scratch.save(named.where("node IS NOT NULL").select("sid", "root", "first_id"), "linked")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = (named.where("node IS NULL").select("sid", "root", F.col("first_id").alias("component_id"))
              .unionByName(linked.join(least, "root").select("sid", "root", "component_id")))
    return (members.join(by_set.withColumnRenamed("sid", "_sid"), F.col("sid") == F.col("_sid"), "left")
            .select("doc_id", "text_key", "n_shingles", "root", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def _joined(links: DataFrame, roots: DataFrame, more: DataFrame, scratch: Scratch, label: str) -> tuple[DataFrame, DataFrame]:
    """(links, roots) with more links."""
    more = scratch.save(more, label)
    if more.isEmpty():
        return links, roots
    links = links.unionByName(more)
    return links, connected_components(links, scratch, f"{label}-roots")


def _mixed(met: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """(key, hub, sid, more, root, probed, size) of keys whose members lie in different components."""
    of_key = Window.partitionBy("key")
    return (met.select("key", "hub", "sid", "probed", *more).join(roots, F.col("sid") == F.col("node"), "left")
            .groupBy("key", "hub", "sid", *more, F.coalesce("root", "sid").alias("root")).agg(F.max("probed").alias("probed"))     # a task's copies
            .withColumn("low", F.min("root").over(of_key)).withColumn("high", F.max("root").over(of_key))
            .withColumn("size", F.count(F.lit(1)).over(of_key))
            .where("low <> high").drop("low", "high"))


def _merged(large: DataFrame, scratch: Scratch) -> DataFrame:
    """Groups (key, sid, root, probed) that hold every pair of the large
    keys. Near copies share most of their keys, and those have one hub: the
    keys of a hub are one group where its members make no more pairs than
    theirs, key by key."""
    members = large.groupBy("hub", "sid", "root").agg(F.max("probed").alias("probed"), F.sum("size").alias("apart"))
    hubs = members.groupBy("hub").agg(F.sum("apart").alias("apart"), F.count(F.lit(1)).alias("n")).where("n * n <= apart").select("hub")
    hubs = scratch.save(hubs, "hubs")
    return (members.join(hubs, "hub", "left_semi").select(F.xxhash64("hub").alias("key"), "sid", "root", "probed")
            .unionByName(large.join(hubs, "hub", "left_anti").select(F.xxhash64("hub", "key").alias("key"), "sid", "root", "probed")))


def _pairs_of(small: DataFrame) -> DataFrame:
    """All pairs of keys with few members: sketches are for the distinct ones."""
    return (small.select("key", "sid", "probed", "root").repartition("key").sortWithinPartitions("key")
            .mapInArrow(*_small_groups()).distinct())


def _nearest_pairs(groups: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Of every member its nearest ones in other components, by sketch."""
    return (_cells(groups, block_rows)
            .select("group", "key", "side", "sid", "probed", "root", "n", "sketch")
            .repartition("group").sortWithinPartitions("group").mapInArrow(*_large_groups(percent, NEAREST)).distinct())


def _settled_pairs(left: DataFrame, rows: DataFrame, reps: DataFrame, scratch: Scratch, k: int, percent: int, block_rows: int) -> DataFrame:
    """Links that join the components of each group, by whole sets."""
    sets = scratch.save(_sets_of(rows, reps.select("sid", "rid"), left.select("sid").distinct(), k), "sets-left")
    return (_cells(left, block_rows).join(sets, "sid")
            .select("group", "side", "sid", "probed", "root", "shingles")
            .repartition("group").sortWithinPartitions("group").mapInArrow(*_settled_groups(percent)).distinct())


def _cells(members: DataFrame, block_rows: int) -> DataFrame:
    """Rows (key, sid, root, probed, n) with the ``group`` in which they are
    compared: the whole key, or two blocks of a large one (sides 0 and 1).
    Members of a key's largest component are cut into blocks of their own:
    they are held against the members outside it, not against each other."""
    def blocks(rows, n):
        return F.greatest(F.ceil(rows / block_rows), F.ceil(n / BLOCK_SHINGLES))

    of_root = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    of_key = of_root.groupBy("key").agg(F.max(F.struct("rows", "root", "n")).alias("top"), F.sum("rows").alias("rows"), F.sum("n").alias("all"))
    whole = blocks(F.col("rows"), F.col("all")) <= 1
    of_key = of_key.select("key", F.col("top.root").alias("largest"),
                           F.when(whole, 1).otherwise(blocks(F.col("rows") - F.col("top.rows"), F.col("all") - F.col("top.n"))).alias("outer"),
                           F.when(whole, 0).otherwise(blocks(F.col("top.rows"), F.col("top.n"))).alias("inner"))
    inside, mine, other = (F.col("root") == F.col("largest")) & (F.col("inner") > 0), F.col("mine"), F.col("other")
    one = F.lit(1).cast("long")
    return (members.join(of_key, "key")
            .withColumn("mine", F.when(inside, F.col("outer") + F.pmod(F.xxhash64("sid"), F.greatest("inner", one))).otherwise(F.pmod(F.xxhash64("sid"), F.col("outer"))))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)))
            .select(*members.columns, F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)).alias("group"), (mine > other).cast("int").alias("side")))


def _sets_of(rows: DataFrame, reps: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(sid, shingles) of the wanted sets, from their first documents' texts."""
    rids = reps.join(wanted, "sid", "left_semi").select(F.col("rid").alias("_rid")).distinct()
    if rids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        rids = F.broadcast(rids)
    texts = rows.join(rids, F.col("rid") == F.col("_rid"), "left_semi").select("text")
    return texts.mapInArrow(*_sets(k)).dropDuplicates(["sid"])


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches do not rule out."""
    both = (pairs.join(sketches.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("xa")), "a")
            .join(sketches.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("xb")), "b"))
    return both.mapInArrow(*_near_pairs(percent))


def _verified(pairs: DataFrame, rows: DataFrame, reps: DataFrame, scratch: Scratch, label: str, k: int, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets."""
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    sets = scratch.save(_sets_of(rows, reps.select("sid", "rid"), wanted, k), f"sets-{label}")
    both = (pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return both.mapInArrow(*_verify(percent))


def drop_near_copies(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, the one with the smallest id
    (null ids last; of rows with that id, the smallest hash of the text; of
    its repeated rows, one); documents without words all stay. Rows are
    known by id and text, so ids may be null or repeat with other texts."""
    scratch = Scratch(docs.sparkSession, "near-copies")
    rows = _components(docs, k, percent).groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    rows = scratch.save(rows, "rows")
    # one row per component; without a root: a text without words
    first = (rows.where("root IS NOT NULL").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "n")).alias("first")).select("first.*"))
    first = scratch.save(first.select("doc_id", "text_key", "n"), "first")
    ids = first.select("doc_id", "text_key").unionByName(rows.where("root IS NULL").select("doc_id", "text_key"))
    kept = docs.join(ids.select(F.col("doc_id").alias("_kept"), F.col("text_key").alias("_key")),
                     F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.xxhash64("text") == F.col("_key")), "left_semi")
    if first.where("n > 1").isEmpty():
        return kept
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return kept.where(worded).dropDuplicates(["doc_id", "text"]).unionByName(kept.where(~worded))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))
