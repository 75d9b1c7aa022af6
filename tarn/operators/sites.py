"""Site-catalog wrangling: conform, route by module, keep-first, stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.functions.values import is_true_flag
from tarn.operators.dedup import keep_first

SITE_KEY = ["siteid", "councilsiteid", "lawasiteid"]


def lower_columns(df: DataFrame) -> DataFrame:
    """P5: lower-case every column name; duplicate names are an error."""
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"columns collide when lower-cased: {dupes}")
    return df.toDF(*lowered)


def conform(df: DataFrame, wanted=S.SITE_VARS, dtype: str = "string") -> DataFrame:
    """Keep the wanted columns, add the missing ones as NULL, in order."""
    have = set(df.columns)
    return df.select([F.col(c) if c in have else F.lit(None).cast(dtype).alias(c)
                      for c in wanted])


def in_councils(df: DataFrame, councils, column: str = "council") -> DataFrame:
    """Case-insensitive membership of ``column`` in ``councils``."""
    return df.filter(F.lower(F.col(column)).isin([c.lower() for c in councils]))


def flag_column(module: str) -> str:
    """Module code -> catalog flag column; unknown modules raise."""
    try:
        return S.MODULE_FLAGS[module]
    except KeyError:
        raise ValueError(f"unknown module: {module}") from None


def route_module(catalog: DataFrame, module: str, loaded_at: Column | None = None) -> DataFrame:
    """P2 + A6 + P15: the module's sites, first per (siteid, councilsiteid,
    lawasiteid), stamped ``lawa_site='yes'`` and the load time."""
    flag = flag_column(module)
    if flag not in catalog.columns:
        raise ValueError(f"column {flag} not in the catalog")
    routed = catalog.filter(is_true_flag(flag))
    # Order: the catalog's own row order is not defined in Spark; take the
    # smallest full row, which is deterministic.
    first = keep_first(routed.select(*S.SITE_VARS), SITE_KEY,
                       [c for c in S.SITE_VARS if c not in SITE_KEY])
    return first.select(
        *S.SITE_VARS, F.lit("yes").alias("lawa_site"),
        (loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")).alias("created_at"))


def route_all_modules(catalog: DataFrame) -> DataFrame:
    """P3 as one plan: unpivot the three flags to (module, flag), keep the
    true ones, then keep-first per (module, site key). One pass over the
    catalog instead of one per module; output carries a ``module`` column."""
    mods = list(S.MODULE_FLAGS.items())
    stacked = catalog.select(
        *S.SITE_VARS,
        F.explode(F.array(*[F.struct(F.lit(m).alias("module"), F.col(c).alias("flag"))
                            for m, c in mods])).alias("mf"))
    routed = stacked.filter(is_true_flag(F.col("mf.flag"))).select(
        F.col("mf.module").alias("module"), *S.SITE_VARS)
    first = keep_first(routed, ["module", *SITE_KEY],
                       [c for c in S.SITE_VARS if c not in SITE_KEY])
    return first.withColumn("lawa_site", F.lit("yes"))
