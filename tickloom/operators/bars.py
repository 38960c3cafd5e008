"""Open/high/low/close/volume bars from ticks, and rollups of bars into coarser bars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import (
    bucket_micros,
    clock_text,
    iso_millis,
    moment_literal,
    parse_time,
    previous_bucket,
    span,
    span_micros,
)
from tickloom.schema import BAR_FIELDS

CASCADE = ("5 seconds", "1 minute", "5 minutes", "15 minutes", "1 hour")
# A rank of Seq lies in 0..2**64: 0 for a missing one, else Seq shifted to 1 and above.
_SEQ_SHIFT, _SEQ_RANKS = 2 ** 63 + 1, 2 ** 65


def _tick_key() -> Column:
    """Order of ticks: trade time, then ``Seq``, a missing one first.

    Both share one decimal, which a hash aggregate can update in place (a struct it cannot: Spark would
    sort all ticks).
    """
    whole = lambda n: F.lit(str(n)).cast("decimal(20,0)")
    rank = F.coalesce(F.col("Seq").cast("decimal(20,0)") + whole(_SEQ_SHIFT), whole(0))
    return F.unix_micros("Trade_Time").cast("decimal(18,0)") * whole(_SEQ_RANKS) + rank


def _clean(number: str) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(number), F.col(number))


def _ohlcv(price: Column, volume: Column, key: Column) -> list[Column]:
    """Missing prices never become Open or Close; a bar without volume has volume 0."""
    known = F.when(price.isNotNull(), key)
    return [
        F.min_by(price, known).alias("Open"),
        F.max(price).alias("High"),
        F.min(price).alias("Low"),
        F.max_by(price, known).alias("Close"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("Total_Volume"),
    ]


def _rolled() -> list[Column]:
    """Aggregates of finer bars; ``time`` is unique per symbol, so it orders them alone."""
    return [
        F.min_by("Open", F.when(F.col("Open").isNotNull(), F.col("time"))).alias("Open"),
        F.max("High").alias("High"),
        F.min("Low").alias("Low"),
        F.max_by("Close", F.when(F.col("Close").isNotNull(), F.col("time"))).alias("Close"),
        F.coalesce(F.sum("Total_Volume"), F.lit(0.0)).alias("Total_Volume"),
    ]


def tick_bars(ticks: DataFrame, interval: str, ingest_times: bool = False) -> DataFrame:
    """Event-time tumbling bars per symbol, left-closed, labelled by the bucket start.

    Only buckets that hold a tick appear. Ticks are combined before the shuffle, so a hot symbol
    costs one row per bucket and task. ``ingest_times`` adds first and last ingest time, which are
    compared as instants and written back as ISO text. On a stream the same call is stateful; give
    the stream a watermark on ``Trade_Time`` first.
    """
    if ticks.isStreaming:
        bucket = F.window("Trade_Time", interval)
        label = F.col("bucket.start")
    else:
        ticks = ticks.filter(F.col("Trade_Time").isNotNull())
        bucket = bucket_micros("Trade_Time", interval)
        label = F.timestamp_micros("bucket")
    aggregates = _ohlcv(_clean("Price"), _clean("Volume"), _tick_key())
    extra = []
    if ingest_times:
        ingest = parse_time("Timestamp_Web")
        aggregates += [F.min(ingest).alias("first_in"), F.max(ingest).alias("last_in")]
        extra = [iso_millis("first_in").alias("Start_Time"), iso_millis("last_in").alias("End_Time")]
    return (
        ticks.groupBy("Symbol", bucket.alias("bucket")).agg(*aggregates)
        .select("Symbol", label.alias("time"), *BAR_FIELDS, *extra)
    )


def rollup_bars(bars: DataFrame, interval: str, within: Sequence[str] = ()) -> DataFrame:
    """Finer bars to coarser ones: first open, highest high, lowest low, last close, summed volume.

    ``within`` names extra grouping columns that are functions of (Symbol, bucket). When the input
    is already partitioned by Symbol and those, the rollup needs no shuffle.
    """
    return (
        bars.groupBy("Symbol", *within, bucket_micros("time", interval).alias("bucket"))
        .agg(*_rolled())
        .select("Symbol", *within, F.timestamp_micros("bucket").alias("time"), *BAR_FIELDS)
    )


def bar_cascade(ticks: DataFrame, intervals: Sequence[str] = CASCADE) -> dict[str, DataFrame]:
    """Each interval's bars, rolled up from the one before, lazily.

    Ticks are aggregated once; the finest bars are then laid out by (Symbol, coarsest bucket) and
    every further level is aggregated inside those partitions without another shuffle. Such a group
    holds at most coarsest/finest bars. To write all levels, write the finest table first and
    start from it (``store.write_cascade``), or each level scans the ticks again.
    """
    return rollup_cascade(tick_bars(ticks, intervals[0]), intervals)


def rollup_cascade(finest: DataFrame, intervals: Sequence[str] = CASCADE) -> dict[str, DataFrame]:
    """The coarser levels of ``bar_cascade`` from the finest bars."""
    levels = {intervals[0]: finest}
    current = (
        finest.withColumn("_span", bucket_micros("time", intervals[-1]))
        .repartition("Symbol", "_span")
    )
    for interval in intervals[1:]:
        current = rollup_bars(current, interval, within=["_span"])
        levels[interval] = current.drop("_span")
    return levels


def bar_pyramid(finest: DataFrame, intervals: Sequence[str] = CASCADE[1:]) -> DataFrame:
    """All coarser intervals in one table with an ``interval`` column: one pass, one shuffle.

    Each fine bar is counted towards every interval and combined before the shuffle.
    """
    spans = F.array(*[
        F.struct(F.lit(i).alias("interval"), F.lit(span_micros(i)).cast("bigint").alias("micros"))
        for i in intervals
    ])
    fanned = finest.withColumn("level", F.explode(spans))
    micros = F.unix_micros("time")
    bucket = micros - F.pmod(micros, F.col("level.micros"))
    return (
        fanned.groupBy(F.col("level.interval").alias("interval"), "Symbol", bucket.alias("bucket"))
        .agg(*_rolled())
        .select("interval", "Symbol", F.timestamp_micros("bucket").alias("time"), *BAR_FIELDS)
    )


def microbatch_bars(ticks: DataFrame, now: datetime | Column, interval: str = "5 seconds") -> DataFrame:
    """One bar per symbol over all ticks given, labelled by processing time.

    The label is the bucket before the one that holds ``now``. Start and end are the smallest and
    largest ingest texts. To look at the newest ticks only, filter with ``filters.recent`` first: in a
    stream that would lose the older ticks of a late batch.
    """
    at = now if isinstance(now, Column) else moment_literal(now)
    return (
        ticks.groupBy("Symbol")
        .agg(
            *_ohlcv(_clean("Price"), _clean("Volume"), _tick_key()),
            F.min("Timestamp_Web").alias("Start_Time"),
            F.max("Timestamp_Web").alias("End_Time"),
            F.max(at).alias("now"),
        )
        .select("Symbol", previous_bucket("now", interval).alias("time"), *BAR_FIELDS,
                clock_text("now").alias("Spark_Time"), "Start_Time", "End_Time")
    )


def next_level(bars: DataFrame, finer: str, interval: str) -> DataFrame:
    """Coarser bars of a stream of finished finer bars, append output.

    A finer bar counts at its last instant, so a coarse bar appears once a later fine bar has closed.
    """
    closing = F.col("time") + F.make_dt_interval(secs=F.lit(span(finer).total_seconds() - 1e-6))
    timed = bars.withColumn("closing", closing).withWatermark("closing", "0 seconds")
    rolled = timed.groupBy("Symbol", F.window("closing", interval).alias("bucket")).agg(*_rolled())
    return rolled.select("Symbol", F.col("bucket.start").alias("time"), *BAR_FIELDS)
