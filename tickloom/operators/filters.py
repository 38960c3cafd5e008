"""Time filters. The moment is a driver-side value, so the bound is a literal that reaches the scan."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import lookback_start, moment_literal, span


def recent(df: DataFrame, interval: str | timedelta, now: datetime | None = None,
           ts: str = "Trade_Time") -> DataFrame:
    """Rows of the last ``interval``; without ``now``, of processing time."""
    if now is None:
        seconds = F.lit(span(interval).total_seconds())
        return df.filter(F.col(ts) >= F.current_timestamp() - F.make_dt_interval(secs=seconds))
    return lookback(df, interval, now, ts=ts)


def lookback(df: DataFrame, interval: str | timedelta, now: datetime, ts: str = "Trade_Time",
             align: str | timedelta | None = None) -> DataFrame:
    """Rows since ``now - interval``; ``align`` floors the start to a whole bucket."""
    return df.filter(F.col(ts) >= moment_literal(lookback_start(now, interval, align)))


def latest_moment(df: DataFrame, ts: str = "Trade_Time") -> datetime | None:
    """Newest event time: one row of one column comes back."""
    micros = df.agg(F.max(F.unix_micros(ts)).alias("m")).first()["m"]
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
