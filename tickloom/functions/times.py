"""Time columns: buckets, epoch forms, zone shifts and text forms. All are built-in expressions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_ZONE = "Asia/Seoul"
MARKET_OFFSET = "+09:00"

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def span(interval: str | timedelta) -> timedelta:
    """``"5 seconds"``, ``"1 hour"``... as a timedelta."""
    if isinstance(interval, timedelta):
        return interval
    count, unit = interval.split()
    return timedelta(seconds=int(count) * _UNIT_SECONDS[unit.rstrip("s")])


def span_micros(interval: str | timedelta) -> int:
    return span(interval) // timedelta(microseconds=1)


def _as_column(ts: Column | str) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def bucket_micros(ts: Column | str, interval: str | timedelta) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts``, as epoch microseconds."""
    micros = F.unix_micros(_as_column(ts))
    return micros - F.pmod(micros, F.lit(span_micros(interval)).cast("bigint"))


def bucket_start(ts: Column | str, interval: str | timedelta) -> Column:
    return F.timestamp_micros(bucket_micros(ts, interval))


def previous_bucket(ts: Column | str, interval: str | timedelta) -> Column:
    """The bucket before the one that holds ``ts``: the label of a bar closed at ``ts``."""
    return F.timestamp_micros(bucket_micros(ts, interval) - F.lit(span_micros(interval)))


def from_epoch_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(_as_column(millis))


def epoch_ns(ts: Column | str) -> Column:
    return F.unix_micros(_as_column(ts)) * F.lit(1000).cast("bigint")


def to_market_clock(ts: Column | str, zone: str = MARKET_ZONE) -> Column:
    """UTC instant shifted to the market's wall clock."""
    return F.from_utc_timestamp(_as_column(ts), zone)


def from_market_clock(ts: Column | str, zone: str = MARKET_ZONE) -> Column:
    return F.to_utc_timestamp(_as_column(ts), zone)


def parse_time(text: Column | str) -> Column:
    """Timestamp text with or without a fraction; null for anything else."""
    return F.try_to_timestamp(_as_column(text))


def _market_wall(ts: Column | str) -> Column:
    return F.convert_timezone(None, F.lit(MARKET_ZONE), _as_column(ts))


def clock_text(ts: Column | str) -> Column:
    """Market wall clock as ``yyyy-MM-dd HH:mm:ss.SSS``."""
    return F.date_format(_market_wall(ts), "yyyy-MM-dd HH:mm:ss.SSS")


def iso_millis(ts: Column | str) -> Column:
    """ISO-8601 with milliseconds and the market's offset."""
    wall = F.date_format(_market_wall(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.concat(wall, F.lit(MARKET_OFFSET))


def utc(moment: datetime) -> datetime:
    """An aware UTC datetime; a naive one is taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def floor_moment(moment: datetime, interval: str | timedelta) -> datetime:
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    since = utc(moment) - epoch
    return epoch + since - since % span(interval)


def moment_literal(moment: datetime) -> Column:
    """A timestamp literal for a driver-side moment, whatever the session zone."""
    return F.lit(utc(moment))


def lookback_start(now: datetime, interval: str | timedelta,
                   align: str | timedelta | None = None) -> datetime:
    """``now - interval``, floored to a bucket of ``align`` so the oldest bucket is read whole."""
    start = utc(now) - span(interval)
    return floor_moment(start, align) if align else start
