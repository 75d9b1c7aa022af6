"""Benchmark decontamination (operator 4, DataFrame and SQL functions only).

Finds documents that hold a passage of a benchmark item.

1. Windows. An item of n words is looked for in windows of n words. A
   window that shares no shingle with any item cannot be similar to one,
   so windows are laid only where a document has a shingle of the
   benchmark, in every position and size that an item with this shingle
   asks for (moved inwards at a document's end). This loses nothing.
2. SimHash. Windows and items get ``FINGERPRINTS`` 64-bit fingerprints of
   what step 4 compares: the benchmark's shingles (five words, or the whole
   item where it is shorter), each with the square root of its weight in
   the similarity, so that a template's shingles count next to nothing. The
   cosine of two such vectors is then at least the root of the similarity
   (less where a window holds shingles of other items besides). A window's
   text is fingerprinted once, however many documents hold it; a passage
   that stands unchanged has distance 0.
3. Multi-index Hamming blocks. Fingerprints are cut into ``BLOCKS``
   blocks; items are indexed with every value that differs in at most one
   bit from theirs. Two fingerprints within ``RADIUS`` = 2 x BLOCKS - 1
   agree in some block up to one bit, so all pairs within the radius meet.
   A pair is a candidate if one of its fingerprints is within the radius.
   At the threshold itself (cosine 0.894, 26.6 degrees) a fingerprint
   differs in 9.4 bits on average and in more than 15 for one pair in 46,
   both for one pair in 2,100 (binomial estimate); a test over 500 items
   asks for 99 % of them.
4. Candidates are verified exactly: the weight of the item's shingles
   found in the window, over the item's weight, must be ``THRESHOLD`` or
   more. A shingle weighs its count in the item over the number of items
   that have it.

Words are runs of letters and digits, lower-cased. Result: one row per
document and item with the best window. Nulls: a null text has no words,
an item without words is never found, a null id is kept. Repeated rows
give one result. Very long texts are searched whole. Empty tables: no
rows. Extra columns are ignored. A passage that a third of all documents
share is one window text; it is joined back by key, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, read_table

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS
RADIUS = 2 * BLOCKS - 1
#: Up to so many benchmark shingles are tested inside the scan, as a
#: literal set; a larger benchmark is joined.
LITERALS = 50_000
#: Independent fingerprints of each window and item.
FINGERPRINTS = 2
#: Weights are added as whole numbers of this unit, so that no order of
#: adding them changes a bit.
UNIT = 1 << 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all runs of k words (array, by place)."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def _shingles_of(k: int):
    return lambda words: _shingles(words, k)


def _bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def simhash(features: Column, seed: int = 0) -> Column:
    """64-bit SimHash of an array of (shingle, w), both whole numbers."""
    one = F.lit(1).cast("long")
    hashed = F.transform(features, lambda f: F.struct(F.xxhash64(f["shingle"], F.lit(seed)).alias("h"), f["w"].alias("w")))
    return _bound(hashed, lambda fs: F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
        lambda acc, b: acc.bitwiseOR(F.when(
            F.aggregate(fs, F.lit(0).cast("long"), lambda s, f: s + F.when(
                F.call_function("shiftright", f["h"], b).bitwiseAND(one) == 1, f["w"]).otherwise(-f["w"])) > 0,
            F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long")))))


def _fingerprints(features: Column) -> Column:
    return F.array(*[simhash(features, seed) for seed in range(FINGERPRINTS)])


def _amount(w: Column) -> Column:
    """What one occurrence of a shingle of weight ``w`` adds to a fingerprint."""
    return F.round(F.sqrt(w) * UNIT).cast("long")


def _blocks(fp: Column) -> Column:
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("long")
    return F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(mask).alias("value")) for b in range(BLOCKS)])


def benchmark_items(bench: DataFrame) -> DataFrame:
    """(item_id, words, n, k) of the items that have words."""
    items = bench.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    return items.select("item_id", "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE)).alias("k"))


def _item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, n, k, at, shingle)."""
    by_k = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("words"), k)) for k in range(1, SHINGLE + 1)])
    return items.select("item_id", "n", "k", F.posexplode(by_k).alias("at", "shingle"))


def _weights(item_shingles: DataFrame) -> DataFrame:
    """(shingle, w): one over the number of items that have it."""
    return (item_shingles.select("item_id", "shingle").distinct()
            .groupBy("shingle").agg((1.0 / F.count(F.lit(1))).alias("w")))


def _weighted(item_shingles: DataFrame, weights: DataFrame) -> DataFrame:
    """(item_id, sizes, entries, weight, fps): the weighted shingles of every
    item, their weight together and their fingerprints."""
    counted = item_shingles.groupBy("item_id", "shingle").agg(F.count(F.lit(1)).alias("n"), F.collect_set("n").alias("sizes"))
    grouped = counted.join(weights, "shingle").groupBy(F.col("item_id").alias("_item")).agg(
        F.sort_array(F.collect_list(F.struct("shingle", "n", "w"))).alias("entries"),
        F.sum(F.col("n") * F.col("w")).alias("weight"), F.array_distinct(F.flatten(F.collect_list("sizes"))).alias("sizes"))
    return grouped.withColumn("fps", _fingerprints(F.transform(
        "entries", lambda e: F.struct(e["shingle"].alias("shingle"), (e["n"] * _amount(e["w"])).alias("w")))))


def _prints(windows: DataFrame, weights: DataFrame, ks: list[int], small: bool) -> DataFrame:
    """(w1, w2, shingles, fps) of every distinct window text: its benchmark
    shingles, repeats included, and their fingerprints. A text is known by
    128 bits of hashes; the second step groups where the first one put it."""
    texts = windows.groupBy("w1", "w2").agg(F.first("window").alias("window"))
    words = F.split("window", " ")
    own = _bound(words, lambda ws: F.coalesce(*[F.when(F.least(F.size(ws), F.lit(SHINGLE)) == k, _shingles(ws, k)) for k in ks]))
    known = weights.select("shingle", _amount(F.col("w")).alias("w"))
    features = (texts.select("w1", "w2", F.explode(own).alias("shingle")).join(F.broadcast(known) if small else known, "shingle")
                .groupBy("w1", "w2").agg(F.collect_list(F.struct("shingle", "w")).alias("features")))
    return features.select("w1", "w2", F.col("features.shingle").alias("shingles"), _fingerprints(F.col("features")).alias("fps"))


def _anchored(docs: DataFrame, known: DataFrame, ks: list[int], scratch: Scratch, literals: bool) -> DataFrame:
    """Documents with a benchmark shingle: (doc_id, text_key, words, anchors,
    row). A row is known by its id and its text: ids may be null or repeat."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    if literals:
        values = [r[0] for r in known.select("shingle").distinct().collect()]
        found = _bound(words_of(F.col("text")), lambda words: F.struct(words.alias("words"), F.concat(*[
            F.filter(F.transform(_shingles(words, k), lambda h, i: F.struct(i.alias("at"), h.alias("shingle"))), lambda s: s["shingle"].isin(values)) for k in ks]).alias("anchors")))
        hits = rows.select("doc_id", "text_key", "row", found.alias("f")).select("doc_id", "text_key", "row", "f.words", "f.anchors").where(F.size("anchors") > 0)
    else:
        each = rows.select("row", _bound(words_of(F.col("text")), lambda words: F.concat(*[
            F.transform(_shingles(words, k), lambda h, i: F.struct(i.alias("at"), h.alias("shingle"))) for k in ks])).alias("s")).select("row", F.explode("s").alias("s"))
        anchors = (each.select("row", "s.at", "s.shingle").join(known.select("shingle").distinct(), "shingle", "left_semi")
                   .groupBy(F.col("row").alias("_row")).agg(F.collect_set(F.struct("at", "shingle")).alias("anchors")))
        hits = rows.join(anchors, F.col("row") == F.col("_row")).select("doc_id", "text_key", "row", words_of(F.col("text")).alias("words"), "anchors")
    return scratch.save(hits, "anchored")


def find_passages(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD, literals: int = LITERALS) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words, distance)."""
    return _passages(docs, bench, ["doc_id"], threshold, literals)


def _passages(docs: DataFrame, bench: DataFrame, by: list[str], threshold: float = THRESHOLD, literals: int = LITERALS) -> DataFrame:
    """Best window of each item and each ``by`` (of doc_id, text_key)."""
    scratch = Scratch(docs.sparkSession, "passages")
    items = scratch.save(benchmark_items(bench), "items")
    shingles = scratch.save(_item_shingles(items), "shingles")
    ks = sorted(r[0] for r in items.select("k").distinct().collect()) or [SHINGLE]
    small = shingles.limit(literals + 1).count() <= literals
    hits = _anchored(docs, shingles, ks, scratch, small)

    # where windows are laid: an item with the anchor at place ``at`` starts that much earlier
    laid = shingles.select("shingle", F.col("at").alias("back"), F.col("n").alias("n_words")).distinct()
    places = (hits.select("row", F.size("words").alias("len"), F.explode("anchors").alias("a")).select("row", "len", "a.at", "a.shingle")
              .join(laid, "shingle")
              .select("row", F.least("n_words", "len").alias("n_words"),
                      F.greatest(F.lit(0), F.least(F.col("at") - F.col("back"), F.col("len") - F.col("n_words"))).alias("start"))
              .groupBy(F.col("row").alias("_row")).agg(F.collect_set(F.struct("start", "n_words")).alias("places")))
    text = F.array_join(F.slice("words", F.col("p.start") + 1, F.col("p.n_words")), " ")
    windows = (hits.dropDuplicates(["row"]).join(places, F.col("row") == F.col("_row"))
               .select("doc_id", "text_key", F.size("words").alias("len"), "words", F.explode("places").alias("p"))
               .select("doc_id", "text_key", "len", "p.start", "p.n_words", text.alias("window"))
               .withColumns({"w1": F.xxhash64("window"), "w2": F.xxhash64("window", F.lit(1))}))
    windows = scratch.save(windows, "windows")

    # fingerprints and Hamming blocks, once per window text
    weights = scratch.save(_weights(shingles), "weights")
    weighted = scratch.save(_weighted(shingles, weights), "weighted")
    prints = scratch.save(_prints(windows, weights, ks, small), "prints")
    near = F.transform(F.sequence(F.lit(-1), F.lit(BLOCK_BITS - 1)), lambda b: F.when(b < 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    index = (weighted.select(F.col("_item").alias("item_id"), F.posexplode("fps").alias("seed", "item_fp"))
             .select("item_id", "seed", "item_fp", F.explode(_blocks(F.col("item_fp"))).alias("b"), near.alias("near"))
             .select("item_id", "seed", "item_fp", "b.block", "b.value", F.explode("near").alias("flip"))
             .select("item_id", "seed", "item_fp", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value")))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    candidates = (prints.select("w1", "w2", F.posexplode("fps").alias("seed", "fp"))
                  .select("w1", "w2", "seed", "fp", F.explode(_blocks(F.col("fp"))).alias("b")).select("w1", "w2", "seed", "fp", "b.block", "b.value")
                  .join(index, ["seed", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
                  .groupBy("w1", "w2", "item_id").agg(F.min("distance").alias("distance")))

    # exact similarity of the candidates
    found = F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["w"] * F.least(
        e["n"].cast("long"), F.size(F.filter("shingles", lambda x: x == e["shingle"])).cast("long")))
    good = (candidates.join(weighted.drop("fps"), F.col("item_id").eqNullSafe(F.col("_item"))).join(prints.drop("fps"), ["w1", "w2"])
            .withColumn("similarity", F.round(found / F.col("weight"), 9)).where(F.col("similarity") >= threshold)
            .select("w1", "w2", "item_id", "sizes", "similarity", "distance"))
    best = F.max_by(F.struct("similarity", "start", "n_words", "distance"), F.struct("similarity", -F.col("start"), -F.col("n_words")))
    # an item's windows are those of its own size
    return (windows.join(good, ["w1", "w2"]).where(F.exists("sizes", lambda n: F.least(n, F.col("len")) == F.col("n_words")))
            .groupBy(*by, "item_id").agg(best.alias("best"))
            .select(*by, "item_id", "best.similarity", F.col("best.start").alias("start_word"), "best.n_words", "best.distance"))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Documents without a benchmark passage. A row goes for its own text,
    never for that of another row with its id (or, as it, without one)."""
    found = _passages(docs, bench, ["doc_id", "text_key"]).select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_key")).distinct()
    found = Scratch(docs.sparkSession, "contaminated").save(found, "rows")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.xxhash64("text") == F.col("_key")), "left_anti")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity")
