"""Measurement records: enrich, key, normalise, dedup (the daily load).

Input is the observation frame produced by landing (S1/S2) or by an
adaptor: ``url, status_code, error, site, variable, council, t, value,
params, date_start, date_end[, created_at]``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.functions.values import (censor_symbols, is_rejected_value, record_key, sanitise_name,
                                   sanitise_name_col, strip_specials, truncate_cell)
from tarn.operators.dedup import keep_first
from tarn.operators.joins import dim_join

def dedup_order():
    """Deterministic keep-first order (successes first, then by text)."""
    return [F.col("error").isNotNull(), "url", "t", "value"]


def enrich(obs: DataFrame, sites: DataFrame, transfer: DataFrame) -> DataFrame:
    """J3 + J3b: attach the site's national id and the variable's national
    name. Sites are matched per council (X6), variables on (callname,
    agency), both left joins against dimension-sized lookups."""
    site_ids = sites.select(F.col("councilsiteid"), F.col("lawasiteid"),
                            F.col("council").alias("__site_council"))
    j = dim_join(obs, site_ids,
                 (obs.site == site_ids.councilsiteid) & (obs.council == site_ids["__site_council"]),
                 "left").drop("__site_council")
    tr = transfer.select(F.col("agency").alias("__agency"), F.col("callname").alias("__callname"),
                         "lawaname")
    j = dim_join(j, tr, (j.variable == tr["__callname"]) & (j.council == tr["__agency"]), "left")
    return j.drop("__agency", "__callname")


def keyed_records(obs: DataFrame, sites: DataFrame, transfer: DataFrame,
                  keep_params: bool = False, cell_width: int | None = None) -> DataFrame:
    """Observations -> keyed records, repeats of a key included (no shuffle
    where the lookups are broadcast, so it also runs on a stream). Cells are
    whole unless a ``cell_width`` is given (the reference's is
    ``S.CELL_WIDTH``); core columns plus ``council``, ``created_at`` when
    present, and ``params`` when ``keep_params``."""
    j = enrich(obs, sites, transfer)
    t = F.coalesce(F.col("t"), F.lit(S.MISSING_TIME))                      # P11
    # A part missing from the lookups falls back to the raw id instead
    # of nulling the key (which would collapse a batch onto one row), with
    # the council, as site ids are unique within a council only.
    key = record_key(F.coalesce(F.col("lawasiteid"), F.concat(F.lit("unknown-"), F.coalesce("council", F.lit("")))),
                     F.coalesce("councilsiteid", "site"),
                     F.coalesce("lawaname", "variable"),
                     t, "date_start", "date_end")                          # P6
    out = [key.alias("id"), t.alias("t")]
    for c in ["site", "lawasiteid", "lawaname", "variable", "value", "error"]:
        out.append(truncate_cell(c, cell_width).alias(c))                              # P10
    out += [F.col("status_code"), truncate_cell("url", cell_width).alias("url"), F.col("council")]
    extra = [c for c in ("created_at", "params") if c in j.columns
             and (c != "params" or keep_params)]
    return j.select(*out, *extra)


def build_records(obs: DataFrame, sites: DataFrame, transfer: DataFrame,
                  keep_params: bool = False, cell_width: int | None = None) -> DataFrame:
    """Observations -> keyed, deduplicated records. Catalyst cannot prune
    fields inside the dedup aggregate, so the open attribute map only
    travels when asked for."""
    return keep_first(keyed_records(obs, sites, transfer, keep_params, cell_width), ["id"], dedup_order())   # A6


def prepare_for_load(records: DataFrame) -> DataFrame:
    """F9 on ``value`` and the raw table's column set (core + council +
    created_at)."""
    cols = [censor_symbols("value").alias("value") if c == "value" else F.col(c)
            for c in S.CORE_COLUMNS]
    created = [F.col("created_at")] if "created_at" in records.columns else []
    return records.select(*cols, F.col("council"), *created)


def unmatched_counts(enriched: DataFrame) -> DataFrame:
    """Rows whose site or variable is in no lookup, and rows whose
    value is rejected as a number; one pass, one row."""
    return enriched.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("lawasiteid").isNull()).alias("unmatched_sites"),
        F.count_if(F.col("lawaname").isNull()).alias("unmatched_variables"),
        F.count_if(is_rejected_value(censor_symbols("value"))).alias("rejected_values"))


def metadata(records: DataFrame, cell_width: int | None = None) -> DataFrame:
    """The non-core attributes of each record (the ``params`` map),
    one row per (id, name, value); values cleaned of specials, names made
    column-safe. Long form instead of one column per attribute: the
    attribute set is open and grows with the councils."""
    kv = records.select("id", F.explode("params").alias("name", "value"))
    return kv.select(
        "id",
        sanitise_name_col("name").alias("name"),
        strip_specials(truncate_cell("value", cell_width)).alias("value"))


def request_counts(observations: DataFrame) -> DataFrame:
    """A4: number of requests (distinct URLs) and of failed rows, of the
    observations as landed (before enrichment and dedup)."""
    return observations.agg(
        F.count_distinct("url").alias("n_requests"),
        F.count_if(F.col("error").isNotNull()).alias("n_failed"))


def column_widths(df: DataFrame, max_length: int) -> DataFrame:
    """Columns whose longest text exceeds ``max_length``; one pass."""
    cols = df.columns
    widths = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in cols])
    long = widths.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("max_length")) for c in cols
    ])).alias("w")).select("w.*")
    return long.filter(F.col("max_length") > max_length)


__all__ = ["enrich", "keyed_records", "build_records", "prepare_for_load", "metadata",
           "request_counts", "unmatched_counts", "column_widths", "sanitise_name"]
