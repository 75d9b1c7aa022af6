"""Vector code compression with value dictionaries (operator 12).

Components become integers, ``floor(4096 * x)``. Vectors are stored in
blocks; in a block each dimension has a dictionary of its distinct integers
and one code per vector. Vectors are cut into ``PARTS`` consecutive parts
with a codebook of ``ENTRIES`` entries each. To compare a block with a
codebook, the squared difference of every *distinct* integer of a dimension
to the entries is tabulated once; a part's distances are then gathered by
the codes and added up. The sums that move an entry are a histogram of the
codes by entry, times the dictionary. All of it is integer arithmetic, exact
in any order, so the result does not depend on how rows are dealt.

Per round one pass over the blocks; what leaves a task is one number per
entry and dimension, added up by Spark before the driver reads it.

Vectors that are null, or hold null or non-finite components, take no part.
Vectors of different length have codebooks of their own, and never meet.
Where the length is no multiple of ``PARTS`` the first parts are one longer;
an empty vector has code 0 in every part and no error. Seeds are the
``ENTRIES`` smallest distinct ids (null last; of an id with several vectors
the smallest integer vector); with fewer there are fewer entries. Distances
tie to the lower entry. Integers beyond +-2^40 stop there; where squares
could pass 64 bits Python integers are used; an error or a sum of errors
beyond a long is null. Repeated rows are coded each. Empty table: no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, read_table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELLS = 1 << 22            # components of a block
MOST = 1 << 40
FEW = 10_000
_LONG = (1 << 63) - 1

_BLOCK = "dim int, n int, vec_ids array<long>, labels array<{label}>, kind string, dictionaries binary, ends binary, codes binary"


def cuts(dim: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    size, more = divmod(dim, PARTS)
    return [p * size + min(p, more) for p in range(PARTS + 1)]


def kept_vectors(rows: DataFrame) -> DataFrame:
    e = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return rows.where(e.isNotNull() & ~F.coalesce(F.exists(e, bad), F.lit(True)))


class Block:
    """Integer vectors of one length as dictionaries and codes per dimension."""

    def __init__(self, dictionaries: list[np.ndarray], codes: np.ndarray):
        self.dictionaries, self.codes = dictionaries, codes          # codes: [dimension, vector]

    @staticmethod
    def of(vectors: np.ndarray) -> Block:
        found = [np.unique(column, return_inverse=True) for column in vectors.T]
        return Block([d for d, _ in found], np.array([c for _, c in found], np.uint32).reshape(vectors.shape[1], len(vectors)))

    def vector(self, row: int) -> tuple[int, ...]:
        return tuple(int(d[c]) for d, c in zip(self.dictionaries, self.codes[:, row].tolist()))

    def _exact(self, first: int, last: int, entries: np.ndarray):
        """The number type in which a part's distances are exact."""
        most = max([0, *(max(abs(int(d[0])), abs(int(d[-1]))) for d in self.dictionaries[first:last] if len(d))])
        most += int(np.abs(entries).max()) if entries.size else 0
        return np.int64 if (last - first) * most * most < 1 << 62 else object

    def distances(self, first: int, last: int, entries: np.ndarray) -> np.ndarray:
        """[vector, entry]: squared distances over dimensions first to last."""
        kind = self._exact(first, last, entries)
        out = np.zeros((self.codes.shape[1], len(entries)), kind)
        for j in range(first, last):
            table = (self.dictionaries[j].astype(kind)[:, None] - entries[:, j - first].astype(kind)[None, :]) ** 2
            out += table[self.codes[j]]
        return out

    def assign(self, first: int, last: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest entry, its distance) per vector; ties to the lower."""
        distances = self.distances(first, last, entries)
        nearest = distances.argmin(axis=1)
        return nearest, distances[np.arange(len(nearest)), nearest]

    def sums(self, first: int, last: int, nearest: np.ndarray, entries: int) -> np.ndarray:
        """[entry, dimension]: sums of the vectors of each entry."""
        out = np.zeros((entries, last - first), object)
        for j in range(first, last):
            values = self.dictionaries[j]
            uses = np.bincount(nearest * len(values) + self.codes[j], minlength=entries * len(values)).reshape(entries, len(values))
            most = max(abs(int(values[0])), abs(int(values[-1]))) * len(nearest)
            out[:, j - first] = uses @ values if most < 1 << 62 else uses.astype(object) @ values.astype(object)
        return out


def _encode(schema: pa.Schema):
    """Blocks of rows (vec_id, embedding, label)."""
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)
            sizes, starts = np.diff(ends), ends[:-1]
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                rows = max(1, CELLS // max(1, dim))
                for some in (own[i: i + rows] for i in range(0, len(own), rows)):
                    block = Block.of(whole[starts[some][:, None] + np.arange(dim)].reshape(len(some), dim))
                    values = np.concatenate([np.empty(0, np.int64), *block.dictionaries])
                    kind = next(k for k in ("<i2", "<i4", "<i8") if not len(values) or np.iinfo(k).min <= values.min() and values.max() <= np.iinfo(k).max)
                    code = "<u2" if len(some) <= 1 << 16 else "<u4"
                    take = pa.array(some)
                    one = lambda a, t: pa.array([a.to_pylist()], t)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([dim], pa.int32()), pa.array([len(some)], pa.int32()), one(batch.column(0).take(take), schema.field(2).type), one(batch.column(2).take(take), schema.field(3).type),
                        pa.array([kind + code]), pa.array([values.astype(kind).tobytes()], pa.binary()),
                        pa.array([np.cumsum([len(d) for d in block.dictionaries]).astype("<i4").tobytes()], pa.binary()), pa.array([block.codes.astype(code).tobytes()], pa.binary())], schema=schema)
    return run


def _blocks(batch: pa.RecordBatch):
    """(dim, vec_ids, labels, block) of a batch of block rows."""
    for i in range(batch.num_rows):
        dim, n, ids, labels, kind, values, ends, codes = (batch.column(c)[i] for c in range(8))
        dim, n, kind = dim.as_py(), n.as_py(), kind.as_py()
        values = np.frombuffer(values.as_buffer(), kind[:3]).astype(np.int64)
        yield dim, ids.values, labels.values, Block(np.split(values, np.frombuffer(ends.as_buffer(), "<i4")[:-1]) if dim else [], np.frombuffer(codes.as_buffer(), kind[3:]).reshape(dim, n))


def _smallest(batches):
    """The ``ENTRIES`` smallest ids of each length in a task, with vectors."""
    best: dict[int, dict] = {}
    for batch in batches:
        for dim, ids, _, block in _blocks(batch):
            own = best.setdefault(dim, {})
            named = ids.to_pylist()
            order = sorted(range(len(named)), key=lambda i: (named[i] is None, named[i] or 0))
            seen: set = set()
            for i in order:
                if named[i] not in seen and len(seen) == ENTRIES:
                    break
                seen.add(named[i])
                vector = block.vector(i)
                own[named[i]] = min(own.get(named[i], vector), vector)
            best[dim] = dict(sorted(own.items(), key=lambda x: (x[0] is None, x[0] or 0))[:ENTRIES])
    rows = [(dim, i, list(v)) for dim, own in best.items() for i, v in own.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["dim", "vec_id", "vector"])


_SUMS = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])


def _sum_parts(books: dict[int, list[np.ndarray]]):
    """Per task, part, entry and dimension: vectors and their sum."""
    def run(batches):
        out: dict[tuple, list] = {}
        for batch in batches:
            for dim, _, _, block in _blocks(batch):
                at = cuts(dim)
                for p, entries in enumerate(books[dim]):
                    nearest, _ = block.assign(at[p], at[p + 1], entries)
                    got = out.setdefault((dim, p), [np.zeros(len(entries), np.int64), np.zeros((len(entries), at[p + 1] - at[p]), object)])
                    got[0] += np.bincount(nearest, minlength=len(entries))
                    got[1] += block.sums(at[p], at[p + 1], nearest, len(entries))
        rows = [(dim, p, e, j, int(n[e]), int(total[e, j])) for (dim, p), (n, total) in out.items() for e in np.flatnonzero(n).tolist() for j in range(total.shape[1])]
        from decimal import Decimal
        columns = [[r[i] for r in rows] for i in range(5)] + [[Decimal(r[5]) for r in rows]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SUMS.types)], schema=_SUMS)
    return run


def _assign(books: dict[int, list[np.ndarray]], digests: dict[int, str], schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for dim, ids, labels, block in _blocks(batch):
                at, code, error = cuts(dim), np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), object)
                for p, entries in enumerate(books[dim]):
                    nearest, distance = block.assign(at[p], at[p + 1], entries)
                    code[:, p] = nearest
                    error += distance
                digits = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    ids, labels, pa.array([digits[i: i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)], pa.string()),
                    pa.array([int(e) if e <= _LONG else None for e in error], pa.int64()), pa.array([digests[dim]] * len(ids), pa.string())], schema=schema)
    return run


def encode(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks (``_BLOCK``) of the vectors that take part."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = _BLOCK.format(label=dict(rows.dtypes)["label"])
    kept = kept_vectors(rows).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").alias("label"))
    schema = to_arrow_schema(scratch.spark.createDataFrame([], out).schema)
    return scratch.save(kept.mapInArrow(_encode(schema), out), "blocks")


def seeds(blocks: DataFrame, scratch: Scratch) -> dict[int, list[np.ndarray]]:
    """First codebooks by vector length: [entry, position] per part."""
    found = scratch.save(blocks.mapInArrow(_smallest, "dim int, vec_id long, vector array<long>").groupBy("dim", "vec_id").agg(F.min("vector").alias("vector")), "seeds")
    books = {}
    for dim in sorted(r[0] for r in found.select("dim").distinct().collect()):
        own = found.where(F.col("dim") == dim).orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES).collect()
        whole = np.array([r["vector"] for r in own], np.int64).reshape(len(own), dim)
        at = cuts(dim)
        books[dim] = [whole[:, at[p]: at[p + 1]] for p in range(PARTS)]
    return books


def learn(blocks: DataFrame, books: dict[int, list[np.ndarray]], rounds: int = ROUNDS) -> dict[int, list[np.ndarray]]:
    """Codebooks after ``rounds`` rounds over all blocks."""
    for _ in range(rounds if books else 0):
        sums = (blocks.mapInArrow(_sum_parts(books), "dim int, part int, entry int, at int, n long, total decimal(38,0)")
                .groupBy("dim", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())     # entries x length rows
        books = {dim: [entries.copy() for entries in own] for dim, own in books.items()}
        for r in sums:
            books[r["dim"]][r["part"]][r["entry"], r["at"]] = int(r["total"]) // int(r["n"])
    return books


def digest(book: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for part in book for entry in part.tolist() for x in entry).encode()).hexdigest()


def codes(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of the vectors that
    take part."""
    from pyspark.sql.pandas.types import to_arrow_schema

    scratch = Scratch(rows.sparkSession, "codebooks")
    blocks = encode(rows, scratch)
    books = learn(blocks, seeds(blocks, scratch), rounds)
    out = f"vec_id long, label {dict(rows.dtypes)['label']}, code string, error long, codebooks_sha256 string"
    schema = to_arrow_schema(scratch.spark.createDataFrame([], out).schema)
    return scratch.save(blocks.mapInArrow(_assign(books, {d: digest(b) for d, b in books.items()}, schema), out), "codes")


def with_label_error(coded: DataFrame) -> DataFrame:
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.count_if(F.col("error").isNull()).alias("_beyond"))
    sums = sums.select("_label", F.when((F.col("_beyond") == 0) & (F.col("_sum") <= F.lit(_LONG)), F.col("_sum").cast("long")).alias("label_error"))
    sums = F.broadcast(sums) if sums.limit(FEW + 1).count() <= FEW else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def op12_codebook_codes(spark, sf_dir: str) -> DataFrame:
    return with_label_error(codes(read_table(spark, sf_dir, "embeddings"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql() -> str:
    """The same by plain joins, a round at a time."""
    out = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS a FROM kept, range({PARTS}) t(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, a FROM parts WHERE r <= {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT x.r, x.p, any_value(x.a) AS a, min(CAST(list_sum(list_transform(range(1, len(x.a) + 1), lambda j: (x.a[j] - c.a[j]) * (x.a[j] - c.a[j]))) AS HUGEINT) * {ENTRIES} + c.e) AS m
  FROM parts x JOIN c{i} c ON x.p = c.p GROUP BY x.r, x.p)""")
        if i < ROUNDS:
            out.append(f"""s{i} AS MATERIALIZED (
  SELECT p, e, j, sum(x) AS s, count(*) AS n FROM (SELECT p, m % {ENTRIES} AS e, unnest(a) AS x, generate_subscripts(a, 1) AS j FROM a{i}) GROUP BY p, e, j),
c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(g.a, c.a) AS a FROM c{i} c LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS a FROM s{i} GROUP BY p, e) g ON c.p = g.p AND c.e = g.e)""")
    out.append(f"""coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', CAST(m % {ENTRIES} AS INT)), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})""")
    return "WITH " + ",\n".join(out) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


OP12_SQL = _sql()
