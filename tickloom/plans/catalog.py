"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times
from tickloom.operators import bars, filters, messages, ordered, quality, universe
from tickloom.plans import refresh, views
from tickloom.schema import BAR_FIELDS, MA_WINDOWS, OBSERVED
from tickloom.session import scratch_path
from tickloom.sources import codec, lines
from tickloom.sources.store import LEVELS, MICROBATCH, RAW, TickStore, merge_bars
from tickloom.streaming import health, progress
from tickloom.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
MA_NAMES = [f"MA_{n}" for n in MA_WINDOWS]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; its result comes back with zone-free times and rounded doubles."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return presented(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def presented(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.DateType)):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 4)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.plain_ticks(views.read_events(spark, sf_dir))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flat_ticks(views.read_events(spark, sf_dir))


def _bars(ticks: DataFrame, interval: str, **options) -> DataFrame:
    return bars.tick_bars(ticks, interval, **options)


def _available(spark: SparkSession, name: str) -> tuple[TickStore, str]:
    base = scratch_path(spark, name)
    return TickStore(spark, f"{base}/tables"), f"{base}/checkpoints"


# Messages ---------------------------------------------------------------------------------------

@query("flatten_ticks")
def flatten_ticks(spark, sf_dir):
    packed = messages.build_envelopes(_flat(spark, sf_dir))
    flat = messages.flatten_ticks(packed)
    return flat.withColumn("Trade_type", F.to_json("Trade_type"))


@query("build_envelopes")
def build_envelopes(spark, sf_dir):
    return messages.ticks_per_message(messages.build_envelopes(_flat(spark, sf_dir)))


@query("decode_json_trades")
def decode_json_trades(spark, sf_dir):
    good, _ = codec.decode_json(views.feed_text(views.read_events(spark, sf_dir)))
    ticks = messages.only_trades(good).select("event_id", F.explode("data").alias("tick"))
    return ticks.select("event_id", "tick.t", "tick.s", "tick.p", "tick.v", F.to_json("tick.c").alias("c"))


@query("decode_json_bad")
def decode_json_bad(spark, sf_dir):
    return codec.decode_json(views.feed_text(views.read_events(spark, sf_dir)))[1]


@query("lookup_offset")
def lookup_offset(spark, sf_dir):
    packed = messages.build_envelopes(_flat(spark, sf_dir))
    return messages.lookup_offset(packed, 1, 42)


# Scalar functions -------------------------------------------------------------------------------

@query("tick_hash")
def tick_hash(spark, sf_dir):
    return _flat(spark, sf_dir).select("Seq", "Hash_Spark")


@query("kst_shift")
def kst_shift(spark, sf_dir):
    shifted = _plain(spark, sf_dir).select("Seq", times.to_market_clock("Trade_Time").alias("market_time"))
    return shifted.withColumn("utc_time", times.from_market_clock("market_time"))


@query("epoch_ns")
def epoch_ns(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    millis = F.unix_millis("Trade_Time")
    return ticks.select("Seq", times.epoch_ns("Trade_Time").alias("ns"),
                        times.from_epoch_millis(millis).alias("ms_time"))


@query("bucket_label")
def bucket_label(spark, sf_dir):
    return _plain(spark, sf_dir).select(
        "Seq", times.bucket_start("Trade_Time", "5 seconds").alias("bucket"),
        times.previous_bucket("Trade_Time", "5 seconds").alias("label"))


@query("time_text")
def time_text(spark, sf_dir):
    return _plain(spark, sf_dir).select("Seq", times.clock_text("Trade_Time").alias("clock"),
                                        times.iso_millis("Trade_Time").alias("iso"))


@query("parse_time")
def parse_time(spark, sf_dir):
    text = (
        F.when(F.col("Seq") % 19 == 0, F.lit("n/a"))
        .when(F.col("Seq") % 2 == 0, F.date_format("Trade_Time", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("Trade_Time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return _plain(spark, sf_dir).select("Seq", times.parse_time(text).alias("parsed"))


# Bars -------------------------------------------------------------------------------------------

def _register_tick_bars(name: str, interval: str) -> None:
    @query(name)
    def run(spark, sf_dir):
        return _bars(_plain(spark, sf_dir), interval)


_register_tick_bars("tick_bars_5s", "5 seconds")
_register_tick_bars("tick_bars_1h", "1 hour")
_register_tick_bars("tick_bars_1d", "1 day")


@query("tick_bars_lineitem_1d")
def tick_bars_lineitem(spark, sf_dir):
    return _bars(views.lineitem_ticks(spark, sf_dir), "1 day")


@query("tick_bars_orders_1d")
def tick_bars_orders(spark, sf_dir):
    return _bars(views.order_ticks(spark, sf_dir), "1 day")


@query("start_end_time")
def start_end_time(spark, sf_dir):
    return _bars(_flat(spark, sf_dir), "1 hour", ingest_times=True).select(
        "Symbol", "time", "Start_Time", "End_Time")


@query("microbatch_bars")
def microbatch_bars(spark, sf_dir):
    ticks = _flat(spark, sf_dir)
    return bars.microbatch_bars(ticks, filters.latest_moment(ticks))


def _register_rollup(name: str, interval: str) -> None:
    @query(name)
    def run(spark, sf_dir):
        ticks = _plain(spark, sf_dir)
        levels = bars.CASCADE[:bars.CASCADE.index(interval) + 1]
        return bars.bar_cascade(ticks, levels)[interval]


_register_rollup("rollup_1m", "1 minute")
_register_rollup("rollup_5m", "5 minutes")
_register_rollup("rollup_15m", "15 minutes")
_register_rollup("rollup_1h", "1 hour")


@query("bar_pyramid")
def bar_pyramid(spark, sf_dir):
    return bars.bar_pyramid(_bars(_plain(spark, sf_dir), "5 seconds"))


def _all_levels(store: TickStore) -> DataFrame:
    """The bars of every level with their interval."""
    levels = [store.scan_bars(i).withColumn("interval", F.lit(i)) for i in bars.CASCADE]
    combined = levels[0]
    for level in levels[1:]:
        combined = combined.unionByName(level)
    return combined


@query("bar_tables")
def bar_tables(spark, sf_dir):
    store, _ = _available(spark, "bar_tables")
    ticks = _plain(spark, sf_dir)
    store.write_cascade(ticks)
    return _all_levels(store).drop(*MA_NAMES)


@query("recent_ticks")
def recent_ticks(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    return filters.recent(ticks, "5 seconds", filters.latest_moment(ticks))


@query("recent_ticks_1d")
def recent_ticks_1d(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    return filters.recent(ticks, "1 day", filters.latest_moment(ticks))


@query("lookback_bars")
def lookback_bars(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    kept = filters.lookback(ticks, "70 hours", filters.latest_moment(ticks), align="1 hour")
    return _bars(kept, "1 hour")


# Windows, order, universe -----------------------------------------------------------------------

@query("moving_averages")
def moving_averages(spark, sf_dir):
    return ordered.moving_averages(_bars(_plain(spark, sf_dir), "1 hour"))


@query("moving_averages_5s")
def moving_averages_5s(spark, sf_dir):
    return ordered.moving_averages(_bars(_plain(spark, sf_dir), "5 seconds"), segment="7 days")


@query("assign_seq")
def assign_seq(spark, sf_dir):
    events = views.flat_ticks(views.read_events(spark, sf_dir)).select(
        "Partition", "Symbol", "Trade_Time", F.col("Seq").alias("event_id"))
    return ordered.assign_seq(events, ["Partition"], ["Trade_Time", "event_id"])


@query("daily_volume")
def daily_volume(spark, sf_dir):
    return universe.daily_volume(views.lineitem_ticks(spark, sf_dir))


@query("top_symbols")
def top_symbols(spark, sf_dir):
    volumes = views.lineitem_ticks(spark, sf_dir).groupBy(F.col("Symbol").alias("T"))
    return universe.top_symbols(volumes.agg(F.sum("Volume").alias("v")))


def _yesterday_top(ticks: DataFrame) -> DataFrame:
    today = filters.latest_moment(ticks).date() + timedelta(days=1)
    return universe.top_symbols(universe.scan_daily_volume(universe.daily_volume(ticks), today))


@query("top_symbols_yesterday")
def top_symbols_yesterday(spark, sf_dir):
    return _yesterday_top(views.lineitem_ticks(spark, sf_dir))


@query("in_universe")
def in_universe(spark, sf_dir):
    ticks = views.lineitem_ticks(spark, sf_dir)
    return universe.in_universe(ticks, _yesterday_top(ticks))


# Sinks and stored tables ------------------------------------------------------------------------

@query("line_protocol")
def line_protocol(spark, sf_dir):
    averaged = presented(ordered.moving_averages(_bars(_plain(spark, sf_dir), "1 hour")))
    timed = averaged.withColumn("time", F.col("time").cast("timestamp"))
    return lines.to_line_protocol(timed, "1h-monitor", ["Symbol"], [*BAR_FIELDS, *MA_NAMES])


@query("line_protocol_raw")
def line_protocol_raw(spark, sf_dir):
    ticks = _flat(spark, sf_dir)
    points = lines.raw_points(ticks, times.moment_literal(filters.latest_moment(ticks)))
    return lines.to_line_protocol(points, RAW, lines.RAW_TAGS, lines.RAW_FIELDS, ns="point_ns")


@query("raw_point_times")
def raw_point_times(spark, sf_dir):
    ticks = views.lineitem_ticks(spark, sf_dir)
    unique = lines.unique_ns(ticks, "Trade_Time", ["Symbol"], ["Seq", "Volume"])
    return unique.select("Symbol", "Seq", "Volume", "point_ns")


@query("upsert_bars")
def upsert_bars(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    existing = ordered.moving_averages(_bars(ticks, "1 hour"), [5])
    late = _bars(ticks.filter(F.col("Price") >= 10), "1 hour")
    return merge_bars(existing, late.withColumn("time", F.col("time") + F.expr("interval 1 hour")))


@query("scan_ticks")
def scan_ticks(spark, sf_dir):
    store, _ = _available(spark, "scan_ticks")
    ticks = _flat(spark, sf_dir)
    store.append_ticks(ticks)
    found = store.scan_ticks(lookback="70 hours", now=filters.latest_moment(ticks))
    return found.select("Symbol", "Price", "Volume", "Trade_Time", "Seq")


@query("scan_bars")
def scan_bars(spark, sf_dir):
    store, _ = _available(spark, "scan_bars")
    ticks = _plain(spark, sf_dir)
    store.write_bars("1 minute", _bars(ticks, "1 minute"))
    now = filters.latest_moment(ticks)
    found = store.scan_bars("1 minute", lookback="4 hours", now=now, align="5 minutes")
    return found.select("Symbol", "time", *BAR_FIELDS)


@query("refresh_bars")
def refresh_bars(spark, sf_dir):
    store, _ = _available(spark, "refresh_bars")
    ticks = _flat(spark, sf_dir)
    store.append_ticks(ticks)
    store.write_cascade(ticks)
    refresh.refresh_bars(store, filters.latest_moment(ticks))
    return _all_levels(store)


@query("latency_stored")
def latency_stored(spark, sf_dir):
    store, _ = _available(spark, "latency_stored")
    ticks = _flat(spark, sf_dir)
    store.append_ticks(ticks, clock=times.moment_literal(filters.latest_moment(ticks)))
    return quality.latency(store.scan_raw(), spark_time=F.col("Spark_Time"))


# Feed health ------------------------------------------------------------------------------------

@query("hash_mismatch")
def hash_mismatch(spark, sf_dir):
    return quality.hash_mismatch(_flat(spark, sf_dir)).select("Seq", "Symbol", "Hash_Web", "Hash_Spark")


@query("seq_gaps")
def seq_gaps(spark, sf_dir):
    return quality.seq_gaps(_flat(spark, sf_dir), ["Partition"])


@query("stale_intervals")
def stale_intervals(spark, sf_dir):
    return quality.stale_intervals(_plain(spark, sf_dir))


@query("stale_by_symbol")
def stale_by_symbol(spark, sf_dir):
    ticks = _plain(spark, sf_dir)
    now = filters.latest_moment(ticks)
    return quality.stale_intervals(ticks, "10 minutes", feed=["Symbol"], now=now, segment="1 day")


@query("latency")
def latency(spark, sf_dir):
    return quality.latency(_flat(spark, sf_dir))


@query("progress_offsets")
def progress_offsets(spark, sf_dir):
    return quality.progress_offsets(views.progress_reports(_flat(spark, sf_dir)))


@query("latest_offsets")
def latest_offsets(spark, sf_dir):
    return quality.latest_offsets(views.progress_reports(_flat(spark, sf_dir)))


# Streams ----------------------------------------------------------------------------------------

def _flat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flat_ticks(views.stream_events(spark, sf_dir))


@query("stream_raw")
def stream_raw(spark, sf_dir):
    store, checkpoints = _available(spark, "stream_raw")
    ticks = _flat_stream(spark, sf_dir)
    streams.start_raw(ticks, store, checkpoints, "available now").awaitTermination()
    return store.scan_ticks().withColumn("Trade_type", F.to_json("Trade_type"))


@query("raw_backfill")
def raw_backfill(spark, sf_dir):
    """A stream, a batch load of its own half of the ticks, and the stream again."""
    store, checkpoints = _available(spark, "raw_backfill")
    even = views.replay(spark, sf_dir, store.path("feed"), parts=2)
    for step in range(2):
        stream = views.flat_ticks(even(step)).filter("Seq % 2 = 0")
        streams.start_raw(stream, store, checkpoints, "available now").awaitTermination()
        if step == 0:
            store.append_ticks(_flat(spark, sf_dir).filter("Seq % 2 = 1"))
    return store.scan_ticks().withColumn("Trade_type", F.to_json("Trade_type"))


@query("stream_observed")
def stream_observed(spark, sf_dir):
    """What four micro-batches counted on their way into the raw table, added up."""
    store, checkpoints = _available(spark, "stream_observed")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4)
    run = streams.start_raw(views.flat_ticks(feed(3)), store, checkpoints, "available now")
    run.awaitTermination()
    told = progress.observed(progress.recent_progress(spark, run))
    return told.groupBy("name").agg(*[F.sum(n).alias(n) for n in OBSERVED])


@query("stream_raw_and_bars")
def stream_raw_and_bars(spark, sf_dir):
    """Four micro-batches into the raw table and a bar table, read once; the raw rows."""
    store, checkpoints = _available(spark, "stream_raw_and_bars")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4)
    for step in (1, 3):
        streams.start_raw_and_bars(views.flat_ticks(feed(step)), store, checkpoints, trigger="available now",
                                   clock=F.col("Trade_Time")).awaitTermination()
    return store.scan_ticks().withColumn("Trade_type", F.to_json("Trade_type"))


@query("stream_microbatch")
def stream_microbatch(spark, sf_dir):
    store, checkpoints = _available(spark, "stream_microbatch")
    clock = times.moment_literal(filters.latest_moment(_plain(spark, sf_dir)))
    tables = [MICROBATCH, next(iter(LEVELS))]
    streams.start_bars_batch(_flat_stream(spark, sf_dir), store, checkpoints, tables, "available now",
                             clock).awaitTermination()
    written = [store.scan_table(t).drop(*MA_NAMES).withColumn("table_name", F.lit(t)) for t in tables]
    return written[0].unionByName(written[1])


@query("stream_microbatch_steps")
def stream_microbatch_steps(spark, sf_dir):
    """Four micro-batches in the order of time, each labelled by its newest tick of the symbol, into both tables."""
    store, checkpoints = _available(spark, "stream_microbatch_steps")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4)
    tables = [MICROBATCH, next(iter(LEVELS))]
    for step in (1, 3):
        streams.start_bars_batch(views.flat_ticks(feed(step)), store, checkpoints, tables, "available now",
                                 F.col("Trade_Time")).awaitTermination()
    written = [store.scan_table(t).drop(*MA_NAMES).withColumn("table_name", F.lit(t)) for t in tables]
    return written[0].unionByName(written[1])


@query("stream_bars")
def stream_bars(spark, sf_dir):
    store, checkpoints = _available(spark, "stream_bars")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4, by=F.pmod(F.xxhash64("event_id"), F.lit(4)))
    ticks = views.plain_ticks(feed(3))
    streams.start_stream_bars(ticks, store, "1 hour", checkpoints, delay="400 days",
                              trigger="available now").awaitTermination()
    return store.scan_bars("1 hour").drop(*MA_NAMES)


@query("stream_refresh_ma")
def stream_refresh_ma(spark, sf_dir):
    store, checkpoints = _available(spark, "stream_refresh_ma")
    ticks = _flat_stream(spark, sf_dir)
    streams.start_raw(ticks, store, f"{checkpoints}/raw", "available now").awaitTermination()
    streams.start_refresh(store, f"{checkpoints}/refresh", "available now").awaitTermination()
    return _all_levels(store)


@query("stream_cascade")
def stream_cascade(spark, sf_dir):
    store, checkpoints = _available(spark, "stream_cascade")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4)
    root = store.path("cascade")
    streams.start_cascade(views.plain_ticks(feed(3)), root, checkpoints, delay="10 days", trigger="available now")
    levels = [streams.read_level(spark, root, i).withColumn("interval", F.lit(i)) for i in bars.CASCADE]
    combined = levels[0]
    for level in levels[1:]:
        combined = combined.unionByName(level)
    return combined


def _heartbeat(spark: SparkSession, path: str) -> None:
    """Add a micro-batch to a replay: one event without a price, a day after all others, so that sessions close."""
    events = spark.read.schema(views.EVENTS).parquet(path)
    told = {"event_id": F.lit(-1).cast("bigint"), "ts": F.col("ts") + F.expr("interval 1 day")}
    last = events.agg(F.max("ts").alias("ts"))
    last.select(*[told.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema]).write.mode(
        "append").parquet(path)


@query("stream_stale")
def stream_stale(spark, sf_dir):
    """Four micro-batches in the order of time, a restart after two, and a heartbeat at the end."""
    store, checkpoints = _available(spark, "stream_stale")
    feed = views.replay(spark, sf_dir, store.path("feed"), parts=4)
    for step in (1, 3):
        ticks = views.plain_ticks(feed(step))
        if step == 3:
            _heartbeat(spark, store.path("feed"))
        health.start_stale(ticks, store.path("stale"), checkpoints, trigger="available now").awaitTermination()
    return health.Carried(spark, store.path("stale")).out(health.stale_shape(ticks, ()))


def _by_arrival(spark: SparkSession, sf_dir: str):
    """Steps of a replay that follow the ingest time: a step is never older than the one before."""
    ingest = F.unix_millis(views.ingest_time())
    low, high = views.read_events(spark, sf_dir).agg(F.min(ingest), F.max(ingest)).first()
    return F.floor((ingest - F.lit(low or 0)) / F.lit(((high or 0) - (low or 0)) // 4 + 1))


@query("stream_seq_gaps")
def stream_seq_gaps(spark, sf_dir):
    """Four micro-batches in the order of arrival, with a restart after two."""
    store, checkpoints = _available(spark, "stream_seq_gaps")
    feed = views.replay(spark, sf_dir, store.path("feed"), 4, _by_arrival(spark, sf_dir))
    for step in (1, 3):
        ticks = views.flat_ticks(feed(step))
        health.start_seq_gaps(ticks, store.path("gaps"), checkpoints, ["Partition"],
                              trigger="available now").awaitTermination()
    return health.Carried(spark, store.path("gaps")).out(health.gap_shape(ticks, ["Partition"]))


@query("stream_assign_seq")
def stream_assign_seq(spark, sf_dir):
    """Four micro-batches in the order of time, with a restart after two."""
    store, checkpoints = _available(spark, "stream_assign_seq")
    feed = views.replay(spark, sf_dir, store.path("feed"), 4)
    for step in (1, 3):
        ticks = views.flat_ticks(feed(step)).select(
            "Partition", "Symbol", "Trade_Time", F.col("Seq").alias("event_id"))
        health.start_running_numbers(ticks, store.path("numbers"), checkpoints, ["Partition"],
                                     ["Trade_Time", "event_id"], trigger="available now").awaitTermination()
    shape = T.StructType([*ticks.schema.fields, T.StructField("Seq", T.LongType())])
    return health.Carried(spark, store.path("numbers")).out(shape)


@query("stream_late_bars")
def stream_late_bars(spark, sf_dir):
    """A shuffled replay with the default delay: bars, the late ticks put aside, and the repair of their bars."""
    store, checkpoints = _available(spark, "stream_late_bars")
    feed = views.replay(spark, sf_dir, store.path("feed"), 4, F.pmod(F.xxhash64("event_id"), F.lit(4)))
    ticks = views.flat_ticks(feed(3))
    now = "available now"
    streams.start_raw(ticks, store, f"{checkpoints}/raw", now).awaitTermination()
    streams.start_stream_bars(ticks, store, "1 hour", f"{checkpoints}/bars", trigger=now).awaitTermination()
    health.start_late_ticks(ticks, store.path("late"), f"{checkpoints}/late", "1 hour", trigger=now).awaitTermination()
    health.repair_late(store, "1 hour", health.Carried(spark, store.path("late")).out(ticks.schema))
    return store.scan_bars("1 hour").drop(*MA_NAMES)
