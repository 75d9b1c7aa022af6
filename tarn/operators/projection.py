"""Keep and rename fields of API records, dropping the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``mapping`` is source name -> output name, in output order. Names
    with dots (``main.temp``) are column names, not struct paths."""
    return df.select([F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


# The two record shapes the reference's tests specify.
WEATHER_FIELDS = {"id": "id", "dt": "datetime", "name": "name", "main.temp": "temperature"}
TRADE_FIELDS = {"stock_ticker": "stock_ticker", "i": "id", "t": "timestamp", "x": "exchange",
                "p": "price", "s": "size"}
