"""Mixing sources to target weights by pivotal dependent rounding (operator 10).

Every source has a target size; a document of a source with rate
``r = target / size`` gets ``floor(r)`` or ``floor(r) + 1`` copies. The
fractional parts are rounded by the pivotal method: two undecided
documents meet, words of expected mass move from one to the other (in a
random direction, with probabilities that keep each expectation) until one
of them is integral; the other goes on. The words of a source are kept
exactly through every meeting, so the taken words differ from the target
by less than one document, the last undecided one, which is rounded to the
nearer side.

The meetings form a reduction tree: undecided documents of a source are
dealt by the hash of their id, text and number among equal rows into groups of about ``fan_in``, each group
is reduced to at most one undecided document, and those are grouped again
until a source has at most one. Each level is a written table, so reruns
of a task repeat nothing above it, and every draw is a hash of the two
ids, so reruns agree.

Nulls: a null text has size 0, a null source is a source of its own, with
the last place in the order; a null id draws as 0. Documents of size 0
take floor(r) copies and do not meet. Repeated rows are documents of their
own. Empty table: no rows. Extra columns are ignored (``document_mix``
returns them unchanged).
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
FAN_IN = 1000
BROADCAST_SOURCES = 100_000
SEED = 20240
WORD = "[^\\x20\\x09-\\x0D]+"
EPS = 1e-9
#: Repeated rows are numbered in runs of this many.
RUN = 65_536
#: What sets the draws of a repeated row apart from those of its id alone.
REPEAT_STEP = 0x5851F42D4C957F2D


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, n_docs, target) of one row per source.

    Targets are shares of the whole by weight, stopped at ``max_repeat``
    times the source; the excess goes to the others by weight until none
    is above. That is one water level: target = min(cap, weight x level),
    found from running sums over sources sorted by cap / weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    total = Window.partitionBy()
    rows = (sizes.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size").cast("double") * max_repeat)
            .withColumn("all_size", F.sum("source_size").over(total).cast("double"))
            .withColumn("all_weight", F.sum("weight").over(total)))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("all_size") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    rows = rows.withColumn("level", level)
    # the first source (in that order) that stays below its cap sets the level
    rows = rows.withColumn("water", F.min(F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(total)["level"])
    return rows.select("source", "source_size", "n_docs",
                       F.least(F.col("cap"), F.col("weight") * F.coalesce("water", F.lit(float(max_repeat)) * F.col("cap"))).alias("target"))


def _draw(a: int, b: int, seed: int) -> float:
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / float(1 << 53)


def pivot(ids: list[int], sizes: list[int], probs: list[float], seed: int = SEED) -> list[float]:
    """Pivotal rounding of one group, in the given order: all returned
    values are 0 or 1 but at most one; sum(size x value) is kept."""
    out = list(probs)
    cur = -1
    for i in range(len(out)):
        if out[i] <= EPS or out[i] >= 1 - EPS:
            out[i] = float(round(out[i]))
            continue
        if cur < 0:
            cur = i
            continue
        a, b, sa, sb = out[cur], out[i], sizes[cur], sizes[i]
        up = min((1 - a) * sa, b * sb)            # words that can move from i to cur
        down = min(a * sa, (1 - b) * sb)          # and from cur to i
        if _draw(ids[cur], ids[i], seed) * (up + down) < down:
            a, b = a + up / sa, b - up / sb
        else:
            a, b = a - down / sa, b + down / sb
        out[cur], out[i] = a, b
        done_a, done_b = a <= EPS or a >= 1 - EPS, b <= EPS or b >= 1 - EPS
        if done_a:
            out[cur] = float(round(a))
        if done_b:
            out[i] = float(round(b))
        cur = -1 if done_a and done_b else i if done_a else cur
    return out


def _reduce(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "row_key", "number"], ascending=[False, True, True, True], kind="stable")
        ids = [d + n * REPEAT_STEP for d, n in zip(pdf["doc_id"].fillna(0).astype("int64").tolist(), pdf["number"].tolist())]
        return pdf.assign(p=pivot(ids, pdf["size"].tolist(), pdf["p"].tolist(), seed))
    return run


def dependent_rounding(rows: DataFrame, scratch: Scratch, fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """``rows`` (doc_id, row_key, number, source, size > 0, p) with every ``p`` 0 or 1."""
    undecided, done, level = rows, [], 0
    integral = (F.col("p") == 0) | (F.col("p") == 1)
    while True:
        undecided = scratch.save(undecided, f"undecided{level}")
        counts = undecided.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return union_all([*done, undecided.withColumn("p", F.round("p"))])
        groups = counts.select(F.col("source").alias("_s"), F.ceil(F.col("n") / fan_in).alias("_g"))
        dealt = (undecided.join(maybe_small(groups), F.col("source").eqNullSafe(F.col("_s")))
                 .withColumn("_g", F.pmod(F.xxhash64("doc_id", "row_key", "number", F.lit(level)), F.col("_g"))).drop("_s"))
        met = scratch.save(dealt.groupBy("source", "_g").applyInPandas(_reduce(seed + level), dealt.schema).drop("_g"), f"met{level}")
        done.append(met.where(integral))
        undecided, level = met.where(~integral), level + 1


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def maybe_small(sources: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source only when it is counted to
    be small; otherwise Spark joins it by shuffle and splits hot sources."""
    return F.broadcast(sources) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else sources


def number_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``number`` (from 0) among equal ones, so that a row
    repeated any number of times falls into many groups. Equal rows are
    counted, then dealt again in runs of ``RUN``: no task holds them all."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN))))
    dealt = runs.repartition(*rows.columns, "_run")
    within = F.sequence(F.lit(0).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("_n") - F.col("_run") * RUN) - 1)
    return dealt.select(*rows.columns, "_run", F.explode(within).alias("_at")).select(*rows.columns, (F.col("_run") * RUN + F.col("_at")).alias("number"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """(doc_id, row_key, source, size, source_size, target, copies)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.save(number_repeats(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                                   F.xxhash64("text").alias("row_key"))), "rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = scratch.save(source_targets(sizes, weights, max_repeat), "targets")
    joined = (rows.join(maybe_small(targets.withColumnRenamed("source", "_s").drop("n_docs")), F.col("source").eqNullSafe(F.col("_s")))
              .drop("_s")
              .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))
    whole = F.floor(F.col("rate") + EPS)
    joined = scratch.save(joined.withColumn("whole", whole).withColumn("p", F.greatest(F.col("rate") - whole, F.lit(0.0))).drop("rate"), "rated")
    meets = (F.col("size") > 0) & (F.col("p") > EPS)
    rounded = dependent_rounding(joined.where(meets), scratch, fan_in, seed)
    return (rounded.unionByName(joined.where(~meets).withColumn("p", F.lit(0.0)))
            .withColumn("copies", (F.col("whole") + F.col("p")).cast("long")).drop("whole", "p", "number"))


def document_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it.

    Repeated rows (same id and text) are told apart by a number among
    them, so that each gets copies of its own."""
    spark = docs.sparkSession
    taken = mix(docs, **options)
    key = ["_id", "_key", "_src"]
    counted = (taken.where("copies > 0")
               .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), F.col("source").alias("_src"))
               .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_n")))
    rows = docs.select("*", F.col("doc_id").alias("_id0"), F.xxhash64("text").alias("_key0"))
    one = F.struct(*[F.col(c) for c in docs.columns]).alias("_doc")
    # equal ids are told apart by text and source; of equal rows one stands for all
    one_each = rows.groupBy("_id0", "_key0", F.col("source").alias("_src0")).agg(F.first(one).alias("_doc")) if _has_repeats(docs) else rows.select("_id0", "_key0", F.col("source").alias("_src0"), one)
    joined = one_each.join(counted, F.col("_id0").eqNullSafe(F.col("_id")) & F.col("_key0").eqNullSafe(F.col("_key")) & F.col("_src0").eqNullSafe(F.col("_src")))
    return joined.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))).alias("_one")).select("_doc.*")


def _has_repeats(docs: DataFrame) -> bool:
    return not docs.select("doc_id").groupBy("doc_id").count().where("count > 1").isEmpty()


def op10_pivotal_mix(spark, sf_dir: str) -> DataFrame:
    return (mix(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"))
