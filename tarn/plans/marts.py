"""Star-schema marts over the raw tables (plain DataFrame functions).

``compat=True`` reproduces the literal SQL of the reference (site joined
on its council site id only, variable on call name only, dates taken from
the site load); the default joins on (site, council) / (variable, agency)
and dates records by their own load time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.functions.values import (adjusted_value, censor_marker, numeric_value,
                                   obs_time)
from tarn.operators.joins import dim_join, few_rows

SUMMARY_KEYS = ["siteid", "lawasiteid", "councilsiteid", "variable",
                "latitude", "longitude", "council"]
SITE_COLUMNS = S.SITE_VARS + ["lawa_site", "created_at"]


def _site_cond(compat: bool):
    """Join of records (alias ``rec``) and sites (alias ``site``); aliases
    keep it unambiguous when both come from one table."""
    cond = F.col("rec.site") == F.col("site.councilsiteid")
    if not compat:
        cond = cond & (F.col("rec.__rec_council") == F.col("site.council"))
    return cond


def fact_records(records: DataFrame, sites: DataFrame, compat: bool = False,
                 with_clock: bool = True) -> DataFrame:
    """Typed, censor-adjusted records with their site."""
    rec = records.select(
        "id", "t", "site", "lawaname", "value", "error", "url",
        F.col("council").alias("__rec_council"), "created_at",
        *(["updated_at"] if "updated_at" in records.columns else []))
    site = sites.select(*SITE_COLUMNS).alias("site")
    j = dim_join(rec.alias("rec"), site, _site_cond(compat), "left")
    r = lambda c: F.col(f"rec.{c}")
    value_numeric = numeric_value(r("value"))
    censored = censor_marker(r("value"))
    cols = [
        r("id").alias("id"),
        obs_time(r("t")).alias("datetime_var"),
        r("error").alias("error"),
        r("site").alias("site_id"),
        r("lawaname").alias("variable"),
        r("value").alias("raw_value"),
        value_numeric.alias("value_numeric"),
        censored.alias("censored"),
        r("url").alias("data_url"),
        r("created_at").alias("data_created_at"),
    ]
    if "updated_at" in records.columns:                                  # X2: when it was corrected
        cols.append(r("updated_at").alias("data_updated_at"))
    if with_clock:
        cols.append(F.current_timestamp().cast("timestamp_ntz").alias("last_updated"))
    cols += [F.col(f"site.{c}").alias(c) for c in SITE_COLUMNS]
    cols.append(adjusted_value(censored, value_numeric).alias("adjusted_value"))
    return j.select(*cols)


def fact_summary(facts: DataFrame, sites: DataFrame, compat: bool = False) -> DataFrame:
    """A1 + J6 + P16: per site x variable counts and value statistics, over
    records whose site is in the published catalog."""
    pub = sites.select("siteid", "lawasiteid", "councilsiteid", "council")
    cond = [facts[c] == pub[c] for c in pub.columns]      # plain '=': NULL never matches
    kept = dim_join(facts.filter(F.col("value_numeric").isNotNull()), pub, cond, "left_semi")
    when = "created_at" if compat else "data_created_at"   # X4
    return kept.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg("value_numeric").alias("average_value"),
        F.max("value_numeric").alias("max_value"),
        F.min("value_numeric").alias("min_value"),
        F.max(when).alias("last_updated_at"),
        F.min(when).alias("first_updated_at"),
    )


def fact_summary_errors(facts: DataFrame, compat: bool = False) -> DataFrame:
    """A2: per load date x council x error: counts, distinct variables (sorted
    array), distinct council sites, time span. No error reads 'None'."""
    when = "created_at" if compat else "data_created_at"
    src = facts.select(
        F.to_date(when).alias("created_at_date"), "council",
        F.coalesce("error", F.lit("None")).alias("error"),
        "variable", "councilsiteid", "datetime_var")
    return src.groupBy("created_at_date", "council", "error").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.sort_array(F.collect_set("variable")).alias("variables"),
        F.count_distinct("councilsiteid").alias("council_count"),
        F.min("datetime_var").alias("min_datetime_var"),
        F.max("datetime_var").alias("max_datetime_var"),
    )


def dim_sites(records: DataFrame, sites: DataFrame, compat: bool = False) -> DataFrame:
    """Each record id with its site's catalog row."""
    rec = records.select("id", "variable", "site", F.col("council").alias("__rec_council"))
    site = sites.select(*SITE_COLUMNS).alias("site")
    j = dim_join(rec.alias("rec"), site, _site_cond(compat), "left")
    return j.select(F.col("rec.id").alias("id"), F.col("rec.variable").alias("variable"), *[F.col(f"site.{c}").alias(c) for c in SITE_COLUMNS])


def dim_variables(records: DataFrame, transfer: DataFrame, compat: bool = False) -> DataFrame:
    """J5 + A5: each record id with its variable's transfer row, distinct.
    On the call name alone a record meets the rows of all councils: there
    both sides are made distinct before the join, whose rows differ then,
    and not its many rows after it."""
    rec = records.select("id", "variable", "created_at", F.col("council").alias("__rec_council"))
    tr = transfer.select("agency", "callname")
    if compat:
        rec, tr = rec.drop("__rec_council").distinct(), tr.distinct()
    cond = rec["variable"] == tr["callname"]
    if not compat:
        cond = cond & (rec["__rec_council"] == tr["agency"])
    j = dim_join(rec, tr, cond, "left")
    out = j.select(rec["id"], rec["variable"], rec["created_at"], tr["agency"], tr["callname"])
    return out if compat else out.distinct()


def dim_error(records: DataFrame, with_clock: bool = True) -> DataFrame:
    """A5: distinct error facts per record."""
    cols = [F.col("id"), F.col("site").alias("site_id"), F.col("variable").alias("variable_id"),
            F.col("error"), F.col("status_code"), F.col("created_at")]
    if with_clock:
        cols.append(F.current_timestamp().cast("timestamp_ntz").alias("last_updated"))
    return records.select(*cols).distinct()


def star(facts: DataFrame, dim_vars: DataFrame, dim_site: DataFrame, dim_err: DataFrame) -> DataFrame:
    """Adjusted records joined to the three dimensions on id (the
    retired star assembly, kept as a view)."""
    dv = dim_vars.select("id", F.col("agency").alias("dim_agency"), F.col("callname").alias("dim_callname"))
    ds = dim_site.select("id", F.col("lawasiteid").alias("dim_lawasiteid"))
    de = dim_err.select("id", F.col("status_code").alias("dim_status_code"))
    return facts.join(dv, "id").join(ds, "id").join(de, "id")


def unpivot_metadata(meta: DataFrame, ids=("id",), exclude=("created_at",)) -> DataFrame:
    """Wide metadata -> (variable, value) with every value cast to text."""
    ids = list(ids)
    cols = [c for c in meta.columns if c not in ids and c not in exclude]
    cast = meta.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return cast.unpivot(ids, cols, "variable", "value")


def _changed(df: DataFrame, columns):
    """When a row last changed: the first of ``columns`` that is set."""
    return F.coalesce(*[F.col(c) for c in columns if c in df.columns])


def new_since(records: DataFrame, mart: DataFrame | None, full_refresh: bool = False,
              mart_time=("data_updated_at", "data_created_at"),
              record_time=("updated_at", "created_at")) -> DataFrame:
    """Records loaded or corrected since the mart's high-water mark
    (all of them when the mart is absent or empty, or on ``full_refresh``).
    Rows of the mark's own time are taken again: another load may carry the
    same time, and :func:`merge_mart` makes taking a row twice harmless."""
    if mart is None or full_refresh:
        return records
    # Scalar subquery: Catalyst runs the max once and folds it into the
    # filter; no join, and no value passes through the driver.
    mark = mart.select(F.max(_changed(mart, mart_time))).scalar()
    return records.filter(mark.isNull() | (_changed(records, record_time) >= mark))


def merge_mart(mart: DataFrame, increment: DataFrame, key: str = "id") -> DataFrame:
    """The mart with the increment's rows replacing those of their key."""
    kept = mart.join(increment.select(key).distinct(), key, "left_anti")
    return kept.unionByName(increment, allowMissingColumns=True)


def accumulate_daily(existing: DataFrame, fresh: DataFrame, day: str = "created_at_date") -> DataFrame:
    """The daily diagnostics with the days of ``fresh`` replaced,
    all other days kept (they accumulate)."""
    days = few_rows(fresh.select(F.col(day).alias("__day")).distinct())
    kept = existing.join(days, existing[day].eqNullSafe(days["__day"]), "left_anti")
    return kept.unionByName(fresh)
