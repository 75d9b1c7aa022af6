"""Sharding along a Hilbert curve (operator 2, DataFrame functions only).

Several metadata dimensions are quantised to ``bits`` bits each, a row's
place is the Hilbert index of its cell, and the ordered rows are cut into
runs. Rows of one shard then lie close together in every dimension, so a
reader skips files by the (min, max) bins of :func:`shard_manifest`.

Law of the cut: ``rows`` - shard counts are at most one apart.

The order is (curve index, hash of the id, id). Its exact rank needs no
global sort: cells are counted (at most 2^(bits x dimensions) of them),
a cell is split into sub-cells by the id's hash in proportion to its
count, rows are numbered inside a sub-cell, and offsets are running sums
over cells and sub-cells. A cell with a third of all rows becomes
thousands of sub-cells of the same size as any other.

Nulls: a null text has 0 bytes and the CRC of the empty text, a null
dimension falls into bin 0. Repeated rows (same id, same text) get
neighbouring slots in either order. An empty table gives no rows. Extra
columns are ignored. Equal texts with equal metadata share a cell; they
are kept apart only where a cut falls inside the cell.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

SHARDS = 24
BITS = 5
MAX_CELL_BITS = 15      # cells are broadcast: at most 2^15 rows
HASH_BITS = 30


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """Hilbert index of a point with ``bits``-bit coordinates (Skilling's
    transpose method), as one SQL expression over an array state."""
    n = len(dims)
    x = F.array(*[d.cast("long") for d in dims])
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)]) if bits > 1 else None

    def undo(state: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        p = (q - 1).cast("long")
        xi, x0 = F.get(state, i), F.get(state, F.lit(0))
        t = x0.bitwiseXOR(xi).bitwiseAND(p)
        hit = xi.bitwiseAND(q.cast("long")) != 0
        return F.transform(state, lambda v, j: F.when(hit, F.when(j == 0, v.bitwiseXOR(p)).otherwise(v))
                           .otherwise(F.when((j == 0) & (i == 0), v)
                                      .when((j == 0) | (j == i), v.bitwiseXOR(t)).otherwise(v)))

    if steps is not None:
        x = F.aggregate(steps, x, undo)
    # Gray encoding: running XOR over the dimensions
    x = F.aggregate(x, F.array().cast("array<bigint>"),
                    lambda acc, v: F.concat(acc, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long"))))))
    if bits > 1:
        qs = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
        x = F.aggregate(
            F.array(x), F.array().cast("array<bigint>"),
            lambda _acc, g: F.transform(g, lambda v: v.bitwiseXOR(F.aggregate(
                qs, F.lit(0).cast("long"),
                lambda t, q: F.when(F.element_at(g, -1).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)))))
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(places, F.struct(F.lit(0).cast("long").alias("h"), x.alias("x")),
                       lambda s, p: F.struct((s["h"] * 2 + F.floor(F.get(s["x"], p["i"]) / F.pow(F.lit(2), p["b"])).cast("long").bitwiseAND(F.lit(1).cast("long"))).alias("h"), s["x"].alias("x")),
                       lambda s: s["h"])


def text_bin(col: Column, bits: int = BITS) -> Column:
    """Bin of a categorical column; a reader computes the bin of the value
    it looks for in the same way. Null: bin 0."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(1 << bits)), F.lit(0)).cast("int")


def size_bin(size: Column, bits: int = BITS) -> Column:
    """Bin of a size: its power of two."""
    top = (1 << bits) - 1
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))), F.lit(top)).cast("int")


def hilbert_order(df: DataFrame, dims: list[str], id_col: str, scratch: Scratch, bits: int = BITS,
                  rows_per_cell: tuple[int, int, int] = (4096, 64, 200_000)) -> DataFrame:
    """``df`` (narrow, already written) with ``hilbert`` and the gapless
    ``rank`` (from 0) along the curve, and ``n_rows``.

    ``rows_per_cell`` = (k, least, most): sub-cells aim at rows / k rows,
    within those limits.
    """
    if bits * len(dims) > MAX_CELL_BITS:
        raise ValueError(f"at most {MAX_CELL_BITS} bits for all dimensions together")
    k, least, most = rows_per_cell
    rest = [c for c in df.columns if c not in (*dims, id_col)]
    by_curve = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cells = (df.groupBy(*dims).agg(F.count(F.lit(1)).alias("cell_rows"))
             .withColumn("hilbert", hilbert_index([F.col(d) for d in dims], bits))
             .withColumn("n_rows", F.sum("cell_rows").over(everything))
             .withColumn("cell_start", F.coalesce(F.sum("cell_rows").over(by_curve), F.lit(0)))
             .withColumn("n_sub", F.ceil(F.col("cell_rows") / F.least(F.greatest(F.col("n_rows") / k, F.lit(least)), F.lit(most)))))
    # all that tells rows apart: null or repeated ids spread by their text
    hashed = F.pmod(F.xxhash64(F.col(id_col), *rest), F.lit(1 << HASH_BITS))
    placed = (df.join(F.broadcast(cells), [*dims], "inner")        # at most 2^15 cells
              .withColumn("in_cell", hashed)
              .withColumn("sub", F.floor(F.col("in_cell") * F.col("n_sub") / (1 << HASH_BITS))))
    in_sub = Window.partitionBy("hilbert", "sub").orderBy("in_cell", id_col, *rest)
    numbered = scratch.save(placed.withColumn("in_sub", F.row_number().over(in_sub) - 1)
                            .drop("cell_rows", "n_sub", "in_cell"), "numbered")
    before = Window.partitionBy("hilbert").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = (numbered.groupBy("hilbert", "sub").agg(F.count(F.lit(1)).alias("sub_rows"))
              .select("hilbert", "sub", F.coalesce(F.sum("sub_rows").over(before), F.lit(0)).alias("sub_start")))
    return (numbered.join(starts, ["hilbert", "sub"])
            .withColumn("rank", F.col("cell_start") + F.col("sub_start") + F.col("in_sub"))
            .drop("cell_start", "sub_start", "in_sub", "sub"))


def cut_runs(ranked: DataFrame, shards: int) -> DataFrame:
    """Cut ranks into ``shards`` runs whose counts are at most one apart:
    adds ``shard`` and ``slot``."""
    n = F.col("n_rows")
    shard = F.expr(f"(rank * {shards}) div n_rows")
    return (ranked.withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("rank") - F.floor((F.col("shard").cast("long") * n + (shards - 1)) / F.lit(shards)).cast("long")))


def document_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Shards of documents over (language, source, size)."""
    scratch = Scratch(docs.sparkSession, "hilbert")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    rows = scratch.save(docs.select(
        "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        text_bin(F.col("lang"), bits).alias("lang_bin"), text_bin(F.col("source"), bits).alias("source_bin"),
        size_bin(size, bits).alias("size_bin")), "rows")
    ranked = hilbert_order(rows, ["lang_bin", "source_bin", "size_bin"], "doc_id", scratch, bits)
    return cut_runs(ranked, shards)


def shard_manifest(assigned: DataFrame, dims: tuple[str, ...] = ("lang_bin", "source_bin", "size_bin")) -> DataFrame:
    """One row per shard: rows, bytes and the bin range of each dimension."""
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        *[f(d).alias(f"{name}_{d}") for d in dims for name, f in (("min", F.min), ("max", F.max))])


def op2_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    return shard_digest(document_shards(read_table(spark, sf_dir, "documents")))


def shard_digest(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert", "lang_bin", "source_bin", "size_bin")
