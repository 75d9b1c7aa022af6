"""Marts kept up to date from a table's changes, without the old facts.

``changes`` are the records that batches wrote between two versions of a
:class:`tarn.operators.snapshots.SnapshotTable`, before and after. Each mart
has a mergeable state:

* **A1** keeps count, exact (decimal) sum, extrema and load times per site
  and variable. A corrected record takes its old value back and adds its
  new one. A maximum or minimum that was taken back, and not reached again
  by what was added, is unknown: those groups, and no others, are computed
  again from the facts.
* **A2** keeps per day, council, error and block of sites a count, the set
  of variables and a bitmap of site numbers, so distinct sites merge exactly
  by ``bitmap_or_agg``. Records that are new are merged; a correction that
  moves a record between groups has its groups computed again.

Sites are numbered once (:func:`number_sites`) and keep their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.joins import dim_join, few_rows
from tarn.plans.marts import SUMMARY_KEYS
from tarn.session import written

DAILY_KEYS = ["created_at_date", "council", "error"]
SUM_TYPE = "decimal(38,10)"
SHARDS = 64


def fact_changes(changes: DataFrame, facts) -> tuple[DataFrame, DataFrame]:
    """(old, new) facts of changed records; ``facts`` makes facts of records."""
    side = lambda name: facts(changes.where(F.col(name).isNotNull()).select(f"{name}.*"))
    return side("old"), side("new")


# -- A1: summaries ---------------------------------------------------------------

def _published(facts: DataFrame, sites: DataFrame) -> DataFrame:
    pub = sites.select("siteid", "lawasiteid", "councilsiteid", "council")
    return dim_join(facts.filter(F.col("value_numeric").isNotNull()), pub, [facts[c] == pub[c] for c in pub.columns], "left_semi")


def summary_state(facts: DataFrame, sites: DataFrame) -> DataFrame:
    """The mergeable state of A1, one row per group."""
    value = F.col("value_numeric")
    return _published(facts, sites).groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value.cast(SUM_TYPE)).alias("total"), F.max(value).alias("max"), F.min(value).alias("min"),
        F.max("data_created_at").alias("last"), F.min("data_created_at").alias("first"))


def summary_of(state: DataFrame) -> DataFrame:
    """A1's rows of a state."""
    return state.select(*SUMMARY_KEYS, F.col("n").alias("total_records"), (F.col("total").cast("double") / F.col("n")).alias("average_value"),
                        F.col("max").alias("max_value"), F.col("min").alias("min_value"),
                        F.col("last").alias("last_updated_at"), F.col("first").alias("first_updated_at"))


_HIGH, _LOW = ("max", "last"), ("min", "first")


def update_summary(state: DataFrame, old: DataFrame, new: DataFrame, sites: DataFrame, facts_now: DataFrame) -> DataFrame:
    """The state after the ``old`` facts of changed records were replaced by
    the ``new`` ones. ``facts_now`` is read for groups whose extremum went
    away, and not at all where there is none."""
    values = ("n", "total", *_HIGH, *_LOW)
    part = lambda df, role: df.select(*SUMMARY_KEYS, F.lit(role).alias("__role"), *values)
    # written one by one: a union would sort for all their joins in one task
    state, added, gone = (written(s, "summary") for s in (state, summary_state(new, sites), summary_state(old, sites)))
    parts = part(state, 0).unionByName(part(added, 1)).unionByName(part(gone, -1))
    of = lambda role, c: F.max(F.when(F.col("__role") == role, F.col(c)))
    merged = parts.groupBy(*SUMMARY_KEYS).agg(
        F.sum(F.when(F.col("__role") < 0, -F.col("n")).otherwise(F.col("n"))).alias("n"),
        F.sum(F.when(F.col("__role") < 0, -F.col("total")).otherwise(F.col("total"))).cast(SUM_TYPE).alias("total"),
        *[of(role, c).alias(f"__{c}{name}") for c in (*_HIGH, *_LOW) for role, name in ((0, ""), (1, "_in"), (-1, "_out"))])
    lost = F.lit(False)
    columns = []
    for c in (*_HIGH, *_LOW):
        kept, added, taken = (F.col(f"__{c}{x}") for x in ("", "_in", "_out"))
        high = c in _HIGH
        reached = F.coalesce(added >= taken if high else added <= taken, F.lit(False))
        lost = lost | (F.coalesce(taken >= kept if high else taken <= kept, F.lit(False)) & ~reached)
        columns.append((F.greatest if high else F.least)(kept, added).alias(c))
    merged = written(merged.where("n > 0"), "summary")
    lost_groups = merged.where(lost).select(*SUMMARY_KEYS)
    if lost_groups.isEmpty():
        return merged.select(*SUMMARY_KEYS, "n", "total", *columns)
    lost_groups = few_rows(lost_groups.select(*[F.col(c).alias(f"__g_{c}") for c in SUMMARY_KEYS]))
    again = facts_now.join(lost_groups, [facts_now[c].eqNullSafe(F.col(f"__g_{c}")) for c in SUMMARY_KEYS], "left_semi")
    return merged.where(~lost).select(*SUMMARY_KEYS, "n", "total", *columns).unionByName(written(summary_state(again, sites), "summary"))


# -- A2: daily diagnostics -------------------------------------------------------

def number_sites(sites: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(councilsiteid, site_no): a number for every site, those of ``known``
    kept. Numbers are dealt in shards, so no task orders all sites."""
    ids = sites.select("councilsiteid").where(F.col("councilsiteid").isNotNull()).distinct()
    if known is not None:
        ids = ids.join(known.select("councilsiteid"), "councilsiteid", "left_anti")
    shard = F.pmod(F.xxhash64("councilsiteid"), F.lit(SHARDS)).alias("__shard")
    order = Window.partitionBy("__shard").orderBy("councilsiteid")
    new = ids.select("councilsiteid", shard).withColumn("__nth", F.row_number().over(order).cast("long") - 1)
    if known is None:
        return new.select("councilsiteid", (F.col("__nth") * SHARDS + F.col("__shard")).alias("site_no"))
    used = F.broadcast(known.groupBy(F.pmod("site_no", F.lit(SHARDS)).alias("__s")).agg((F.max(F.floor(F.col("site_no") / SHARDS)) + 1).alias("__used")))   # SHARDS rows
    dealt = new.join(used, F.col("__shard") == F.col("__s"), "left")
    return known.select("councilsiteid", "site_no").unionByName(
        dealt.select("councilsiteid", ((F.col("__nth") + F.coalesce("__used", F.lit(0))) * SHARDS + F.col("__shard")).alias("site_no")))


def _daily_facts(facts: DataFrame) -> DataFrame:
    return facts.select("id", F.to_date("data_created_at").alias("created_at_date"), "council", F.coalesce("error", F.lit("None")).alias("error"),
                        "variable", "councilsiteid", "datetime_var")


def daily_aggregates() -> list:
    """What a group of A2 keeps; every part merges."""
    return [F.count(F.lit(1)).alias("n"), F.collect_set("variable").alias("variables"),
            F.bitmap_construct_agg(F.bitmap_bit_position("site_no")).alias("sites"),
            F.min("datetime_var").alias("min_datetime_var"), F.max("datetime_var").alias("max_datetime_var")]


def with_site_numbers(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows with the number of their site and the block of the bitmap."""
    numbers = numbers.select(F.col("councilsiteid").alias("__site"), "site_no")
    joined = dim_join(rows, numbers, F.col("councilsiteid") == F.col("__site"), "left")
    return joined.withColumn("block", F.coalesce(F.bitmap_bucket_number("site_no"), F.lit(0)))


def _daily_state(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    return with_site_numbers(rows, numbers).groupBy(*DAILY_KEYS, "block").agg(*daily_aggregates())


def daily_state(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """The mergeable state of A2: a row per day, council, error and block of
    site numbers."""
    return _daily_state(_daily_facts(facts), numbers)


def merge_daily(*states: DataFrame) -> DataFrame:
    """States of different records as one."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*DAILY_KEYS, "block").agg(
        F.sum("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("variables"))).alias("variables"), F.bitmap_or_agg("sites").alias("sites"),
        F.min("min_datetime_var").alias("min_datetime_var"), F.max("max_datetime_var").alias("max_datetime_var"))


def daily_of(state: DataFrame) -> DataFrame:
    """A2's rows of a state."""
    return state.groupBy(*DAILY_KEYS).agg(
        F.sum("n").alias("error_count"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("variables")))).alias("variables"),
        F.sum(F.bitmap_count("sites")).alias("council_count"),
        F.min("min_datetime_var").alias("min_datetime_var"), F.max("max_datetime_var").alias("max_datetime_var"))


def update_daily(state: DataFrame, old: DataFrame, new: DataFrame, numbers: DataFrame, facts_now: DataFrame) -> DataFrame:
    """The state after the ``old`` facts of changed records were replaced by
    the ``new`` ones. Records that are new, and corrections that leave a
    record's group and its columns of A2 alone, need no old fact."""
    before, after = _daily_facts(old), _daily_facts(new)
    same = before.select(F.col("id").alias("__id"), F.struct(*[c for c in before.columns if c != "id"]).alias("__row"))
    after = after.withColumn("__now", F.struct(*[c for c in after.columns if c != "id"]))
    joined = after.join(same, F.col("id") == F.col("__id"), "left")
    added = joined.where(F.col("__id").isNull()).drop("__now", "__id", "__row")
    moved = joined.where(F.col("__id").isNotNull() & ~F.col("__now").eqNullSafe(F.col("__row")))
    gone = before.join(new.select(F.col("id").alias("__id")), F.col("id") == F.col("__id"), "left_anti").select(*DAILY_KEYS)
    groups = moved.select(*DAILY_KEYS).unionByName(moved.select(*[F.col(f"__row.{c}").alias(c) for c in DAILY_KEYS])).unionByName(gone).distinct()
    if groups.isEmpty():
        return merge_daily(state, _daily_state(added, numbers))
    groups = few_rows(groups.select(*[F.col(c).alias(f"__g_{c}") for c in DAILY_KEYS]))
    on = lambda df: [df[c].eqNullSafe(F.col(f"__g_{c}")) for c in DAILY_KEYS]
    now = _daily_facts(facts_now)
    return merge_daily(state.join(groups, on(state), "left_anti"), _daily_state(added.join(groups, on(added), "left_anti"), numbers)).unionByName(
        _daily_state(now.join(groups, on(now), "left_semi"), numbers))
