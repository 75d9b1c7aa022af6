"""Request manifest: sites x variables per council, with the council's
service root (J1, J2, P13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.operators.dedup import keep_first
from tarn.operators.joins import dim_join


def cap_sites(sites: DataFrame, limit: int | None) -> DataFrame:
    """At most ``limit`` sites per council, lowest site ids first
    (other columns break ties). No cap (the reference's default is
    effectively none) skips the window. Spark limits each map task's share
    of a council before the shuffle (window group limit)."""
    if limit is None:
        return sites
    w = Window.partitionBy("council").orderBy("councilsiteid", *[c for c in sites.columns if c not in ("council", "councilsiteid")])
    return sites.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= limit).drop("__n")


def build_manifest(sites: DataFrame, transfer: DataFrame, urls: DataFrame,
                   date_start: str, date_end: str = S.DEFAULT_DATE_END,
                   limit: int | None = None) -> DataFrame:
    """J1 + J2: one request per (council, site, variable the council
    measures). The product is per council (an equi-join on the council), so
    its size is sites x variables-per-council, never sites x all variables.
    Councils without a service root drop out (inner join) instead of
    raising as the reference does."""
    roots = urls.select(F.col("agency").alias("council"), F.col("soslwq").alias("root"))
    roots = keep_first(roots, ["council"], ["root"])          # an agency with several: the first by text
    s = cap_sites(sites.select("council", "councilsiteid"), limit)
    s = dim_join(s, roots, "council", "inner")
    v = transfer.select(F.col("agency").alias("council"), F.col("callname").alias("variable")).distinct()
    m = dim_join(s, v, "council", "inner")
    url = F.concat(F.col("root"), F.lit("&From="), F.lit(date_start), F.lit("&To="), F.lit(date_end),
                   F.lit("&Site="), F.col("councilsiteid"), F.lit("&Measurement="), F.col("variable"))
    return m.select("council", F.col("councilsiteid").alias("site"), "variable", url.alias("url"))
