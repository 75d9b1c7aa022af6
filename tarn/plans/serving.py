"""Dashboard read path: filtered views with bound values (never SQL text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.values import tolerant_double

SITE_KEY = ["siteid", "lawasiteid", "councilsiteid"]


def site_list(sites: DataFrame, council: str) -> DataFrame:
    """The council's published sites (filter reaches the scan)."""
    return sites.filter(F.col("council") == F.lit(council))


def load_log(diagnostics: DataFrame, council: str) -> DataFrame:
    """V2/O1: the council's load diagnostics, newest load date first
    (NULL dates last; council and error break ties)."""
    return (diagnostics.filter(F.col("council") == F.lit(council))
            .orderBy(F.col("created_at_date").desc_nulls_last(), "council", "error"))


def parameter_view(summary: DataFrame, council: str, variable: str) -> DataFrame:
    """The summary rows of one council and variable."""
    return summary.filter((F.col("council") == F.lit(council)) & (F.col("variable") == F.lit(variable)))


def distinct_rows(df: DataFrame, cols=SITE_KEY) -> DataFrame:
    """A3: distinct combinations of ``cols``, a NULL counted as a value
    (unlike ``count(distinct a, b, c)``, which skips rows with a NULL)."""
    return df.select(*cols).dropDuplicates(cols)


def site_metrics(sites: DataFrame, summary_view: DataFrame) -> DataFrame:
    """V3 metrics: sites published, sites with data for the parameter.
    Both counts are aggregates of distributed distincts, one row out."""
    both = (distinct_rows(sites).withColumn("published", F.lit(1))
            .unionByName(distinct_rows(summary_view).withColumn("published", F.lit(0))))
    return both.agg(F.count_if(F.col("published") == 1).alias("sites_published"),
                    F.count_if(F.col("published") == 0).alias("sites_with_data"))


def map_points(summary_view: DataFrame) -> DataFrame:
    """Numeric position, non-null average, marker size."""
    return (summary_view
            .withColumn("latitude", tolerant_double("latitude"))
            .withColumn("longitude", tolerant_double("longitude"))
            .filter(F.col("average_value").isNotNull())
            .withColumn("average_size", F.col("average_value") * F.lit(10)))


def map_centre(points: DataFrame, order=("councilsiteid", "siteid", "lawasiteid")) -> DataFrame:
    """The first point's position (empty in, empty out)."""
    return points.orderBy(*order).limit(1).select("latitude", "longitude")
