"""Feed health: fingerprint mismatches, lost ticks, silent spells, latency, processed offsets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.times import (
    bucket_micros,
    moment_literal,
    parse_time,
    span,
    span_micros,
)
from tickloom.operators.ordered import over_segments, range_segments


def hash_mismatch(ticks: DataFrame) -> DataFrame:
    """Ticks whose two fingerprints differ; a missing one differs from a present one."""
    return ticks.filter(~F.col("Hash_Web").eqNullSafe(F.col("Hash_Spark")))


def seq_gaps(ticks: DataFrame, feed: Sequence[str] = (), order: str = "Timestamp_Web") -> DataFrame:
    """Jumps in ``Seq`` along arrival: (feed, after_seq, next_seq, missing).

    A fall in ``Seq`` is a restarted counter, not a gap. Only the compared columns are moved.
    """
    slim = ticks.select(*feed, order, "Seq").filter(F.col("Seq").isNotNull())
    placed = range_segments(slim, [*feed, order, "Seq"])

    def previous(df: DataFrame, window: WindowSpec) -> DataFrame:
        return df.withColumn("after_seq", F.lag("Seq", 1).over(window))

    paired = over_segments(placed, feed, ["_id"], F.col("_segment"), 1, ["after_seq"], previous)
    missing = F.col("Seq") - F.col("after_seq") - 1
    return (
        paired.filter(missing > 0)
        .select(*feed, "after_seq", F.col("Seq").alias("next_seq"), missing.alias("missing"))
    )


def stale_intervals(df: DataFrame, threshold: str = "60 seconds", ts: str = "Trade_Time",
                    feed: Sequence[str] = (), now: datetime | None = None,
                    segment: str = "30 days") -> DataFrame:
    """Spells longer than ``threshold`` without a row: (feed, gap_start, gap_end, gap_micros).

    Rows are first folded into buckets of ``threshold``: no two rows of one bucket can be further
    apart than that, so first and last time per bucket say everything. Buckets are walked newest
    first, each looking at the one after it. With ``now``, a spell that is still open ends there.
    """
    buckets = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*feed, bucket_micros(ts, threshold).alias("_bucket"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("gap_start"))
        .withColumn("_back", -F.col("_bucket"))
    )
    end = F.lit(None).cast("timestamp") if now is None else moment_literal(now)

    def following(df: DataFrame, window: WindowSpec) -> DataFrame:
        return df.withColumn("gap_end", F.coalesce(F.lag("_first", 1).over(window), end))

    segments = F.floor(F.col("_back") / F.lit(span_micros(segment)))
    paired = over_segments(buckets, feed, ["_back"], segments, 1, ["gap_end"], following)
    micros = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return (
        paired.filter(micros > span_micros(threshold))
        .select(*feed, "gap_start", "gap_end", micros.alias("gap_micros"))
    )


def latency(ticks: DataFrame, spark_time: Column | None = None,
            percentiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Milliseconds from trade to ingest (and to ``spark_time``) per symbol, exact percentiles.

    Latencies are counted per whole millisecond before the shuffle; percentiles are read off the
    cumulated counts: the smallest value that covers the share. No list of values is held. Ticks
    without a readable ingest time count in no figure.
    """
    ingest = parse_time("Timestamp_Web")
    millis = F.floor((F.unix_micros(ingest) - F.unix_micros("Trade_Time")) / 1000)
    slim = ticks.select("Symbol", millis.cast("bigint").alias("ms"), *(
        [F.floor((F.unix_micros(spark_time) - F.unix_micros(ingest)) / 1000).alias("spark_ms")]
        if spark_time is not None else []))
    sums = [F.count("ms").alias("n")]
    if spark_time is not None:
        sums.append(F.sum("spark_ms").alias("spark_sum"))
    counts = slim.groupBy("Symbol", "ms").agg(*sums)
    by_symbol = Window.partitionBy("Symbol")
    ranked = counts.withColumns({
        "_upto": F.sum("n").over(by_symbol.orderBy(F.asc_nulls_last("ms"))),
        "_all": F.sum("n").over(by_symbol),
    })
    shares = [
        F.min(F.when(F.col("_upto") >= F.ceil(F.lit(p) * F.col("_all")), F.col("ms")))
        .alias(f"p{round(p * 100)}_ms")
        for p in percentiles
    ]
    total = F.sum("n")
    spark_mean = [F.try_divide(F.sum("spark_sum"), total).alias("spark_mean_ms")] if spark_time is not None else []
    return ranked.groupBy("Symbol").agg(
        total.alias("n"),
        F.min("ms").alias("min_ms"),
        F.try_divide(F.sum(F.col("ms") * F.col("n")), total).alias("mean_ms"),
        F.max("ms").alias("max_ms"),
        *shares,
        *spark_mean,
    )


def progress_offsets(progress: DataFrame) -> DataFrame:
    """End offset per query, topic and partition of every progress report.

    Sources whose position is not a map of topics to partitions contribute nothing.
    """
    by_topic = F.from_json("source.endOffset", "map<string,map<string,bigint>>")
    return (
        progress.select(F.col("name").alias("query"), "timestamp", F.explode("sources").alias("source"))
        .select("query", "timestamp", F.explode(by_topic).alias("topic", "partitions"))
        .select("query", "timestamp", "topic", F.explode("partitions").alias("partition", "offset"))
    )


def latest_offsets(progress: DataFrame) -> DataFrame:
    """The newest reported end offset per query, topic and partition."""
    return (
        progress_offsets(progress).groupBy("query", "topic", "partition")
        .agg(F.max_by("offset", "timestamp").alias("offset"))
    )


def stale_queries(progress: DataFrame, now: datetime, threshold: str = "60 seconds") -> DataFrame:
    """Queries that took in no rows for longer than ``threshold`` before ``now``."""
    last = F.max(F.when(F.col("numInputRows") > 0, F.col("timestamp")))
    newest = progress.groupBy(F.col("name").alias("query")).agg(
        F.coalesce(last, F.min("timestamp")).alias("last_data")
    )
    return newest.filter(F.col("last_data") < moment_literal(now - span(threshold)))
