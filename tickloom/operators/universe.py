"""The most traded symbols and the restriction of ticks to them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_volume(ticks: DataFrame) -> DataFrame:
    """Volume per day and symbol, as the table ``scan_daily_volume`` reads."""
    return (
        ticks.groupBy(F.to_date("Trade_Time").alias("date"), F.col("Symbol").alias("T"))
        .agg(F.sum("Volume").alias("v"))
    )


def scan_daily_volume(df: DataFrame, today: date) -> DataFrame:
    """The rows of the day before ``today``."""
    return df.filter(F.col("date") == F.lit(today - timedelta(days=1)))


def top_symbols(daily: DataFrame, n: int = 50) -> DataFrame:
    """The n symbols with the largest volume, ties by symbol."""
    return daily.orderBy(F.desc("v"), "T").limit(n).select(F.col("T").alias("Symbol"), "v")


def in_universe(ticks: DataFrame, top: DataFrame) -> DataFrame:
    """Ticks of the given symbols. Adaptive execution broadcasts the list if its bytes are few."""
    return ticks.join(top.select("Symbol"), "Symbol", "left_semi")
