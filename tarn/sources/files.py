"""File sources other than Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One text column of a headed CSV. The header names the columns
    (only its line is read ahead; nothing is inferred, all is text), and the
    scan parses the wanted one."""
    return spark.read.option("header", True).csv(path).select(column)
