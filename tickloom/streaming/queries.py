"""Streaming queries: raw ticks, micro-batch bars, event-time bars, chained rollups, refreshes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators.bars import CASCADE, microbatch_bars, next_level, tick_bars
from tickloom.plans.refresh import refresh_touched
from tickloom.schema import FLAT_TICK
from tickloom.sources.store import BAR_TABLES, BATCH_LOG, LOG_DDL, MICROBATCH, TickStore, moment_of

BAR_TRIGGER = "5 seconds"
LATE_BY = "10 minutes"
LEVEL_DDL = "Symbol string, time timestamp, Open double, High double, Low double, Close double, Total_Volume double"


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """None: as fast as possible. ``"available now"``: what is there, then stop. Else a period."""
    if trigger is None:
        return writer
    if trigger == "available now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def counted(ticks: DataFrame) -> DataFrame:
    """``ticks`` whose progress reports also tell the ticks, missing prices and foreign fingerprints of each batch.

    Counted in the tasks that read the stream anyway; ``progress.observed`` shows them.
    """
    count = lambda condition: F.count(F.when(condition, 1))
    return ticks.observe(
        "ticks", F.count(F.lit(1)).alias("ticks"), count(F.col("Price").isNull() | F.isnan("Price")).alias("no_price"),
        count(~F.col("Hash_Web").eqNullSafe(F.col("Hash_Spark"))).alias("foreign"))


class _Batches:
    """Names of a stream's micro-batches: the id that the checkpoint gives its query, and the batch's number."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self._spark, self._metadata, self._owner = spark, f"{checkpoint.rstrip('/')}/metadata", None

    def name(self, batch_id: int) -> str:
        if self._owner is None:
            self._owner = self._spark.read.schema("id string").json(self._metadata).first()["id"]
        return f"{self._owner}-{batch_id}"


def start_raw(ticks: DataFrame, store: TickStore, checkpoint: str, trigger: str | None = None,
              clock: Column | None = None, name: str = "raw") -> StreamingQuery:
    """Append flat ticks to the raw table, exactly once, beside any batch loads.

    A micro-batch is one named batch of the table; repeated after a failure, it replaces itself. The
    name holds the id that the checkpoint gives its query, so streams never replace one another.
    """
    batches = _Batches(store.spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.append_ticks(batch, batches.name(batch_id))

    stamped = counted(ticks.select(*FLAT_TICK.names)).withColumn(
        "Spark_Time", clock if clock is not None else F.current_timestamp())
    writer = stamped.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def start_raw_and_bars(ticks: DataFrame, store: TickStore, checkpoint: str, tables: Sequence[str] = (MICROBATCH,),
                       trigger: str | None = BAR_TRIGGER, clock: Column | None = None,
                       name: str = "raw_and_bars") -> StreamingQuery:
    """One read of the source for both sinks: the raw table and the micro-batch bars get the same batches.

    A batch that fails between the two writes runs again as a whole: its raw folder replaces itself and its
    bars have the same keys, so both end up equal.
    """
    batches = _Batches(store.spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # one micro-batch
        try:
            store.append_ticks(kept, batches.name(batch_id))
            bars = microbatch_bars(kept, F.col("Spark_Time"))
            store.upsert_all({table: bars for table in tables})
        finally:
            kept.unpersist()

    stamped = counted(ticks.select(*FLAT_TICK.names)).withColumn(
        "Spark_Time", clock if clock is not None else F.current_timestamp())
    writer = stamped.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def start_bars_batch(ticks: DataFrame, store: TickStore, checkpoint: str,
                     tables: Sequence[str] = (MICROBATCH,), trigger: str | None = BAR_TRIGGER,
                     clock: Column | None = None, name: str = "agg_5sec") -> StreamingQuery:
    """One bar per symbol and micro-batch over all its ticks, written to each of ``tables``.

    ``clock`` is the processing time; by default the batch's own time, which a retried batch keeps,
    so the retry writes the same keys. The aggregate is computed once for all tables.
    """
    stamped = ticks.withColumn("_now", clock if clock is not None else F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        bars = microbatch_bars(batch, F.col("_now"))
        store.upsert_all({table: bars for table in tables})

    writer = stamped.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def stream_bars(ticks: DataFrame, interval: str, delay: str = LATE_BY) -> DataFrame:
    """Event-time bars of a stream.

    Ticks later than ``delay`` behind the batch before are left out; the progress log counts them (``late_rows``), and a refresh
    of the raw table puts them right.
    """
    return tick_bars(ticks.withWatermark("Trade_Time", delay), interval)


def start_stream_bars(ticks: DataFrame, store: TickStore, interval: str, checkpoint: str,
                      delay: str = LATE_BY, trigger: str | None = BAR_TRIGGER,
                      name: str = "bars") -> StreamingQuery:
    """Keep the table of ``interval`` current: changed bars are added as a new version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(BAR_TABLES[interval], batch)

    bars = stream_bars(ticks, interval, delay)
    writer = bars.writeStream.queryName(name).outputMode("update").foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def start_append(bars: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 name: str = "cascade") -> StreamingQuery:
    """Write finished bars of a stream to files."""
    writer = bars.writeStream.queryName(name).format("parquet").outputMode("append")
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start(path)


def start_cascade(ticks: DataFrame, root: str, checkpoints: str, intervals: Sequence[str] = CASCADE,
                  delay: str = LATE_BY, trigger: str | None = BAR_TRIGGER) -> list[StreamingQuery]:
    """Finished bars of every level, one query each over the appended output of the level before.

    The output of a level lies below ``root`` in a folder named after its interval. With the
    "available now" trigger a level starts when the one before has ended.
    """
    spark, queries, level = ticks.sparkSession, [], stream_bars(ticks, intervals[0], delay)
    for place, interval in enumerate(intervals):
        folder = interval.replace(" ", "_")
        path = f"{root.rstrip('/')}/{folder}"
        queries.append(start_append(level, path, f"{checkpoints.rstrip('/')}/{folder}", trigger, f"cascade_{folder}"))
        if trigger == "available now":
            queries[-1].awaitTermination()
        if place + 1 < len(intervals):
            level = next_level(read_level(spark, root, interval, True), interval, intervals[place + 1])
    return queries


def read_level(spark: SparkSession, root: str, interval: str, stream: bool = False) -> DataFrame:
    """The output of one level of ``start_cascade``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(LEVEL_DDL).parquet(f"{root.rstrip('/')}/{interval.replace(' ', '_')}")


def start_refresh(store: TickStore, checkpoint: str, trigger: str | None = BAR_TRIGGER, name: str = "refresh",
                  options: dict[str, str] | None = None) -> StreamingQuery:
    """Follow the log of tick batches; after each trigger refresh the bars that the new batches touch.

    The log has one line per batch, at most ``maxFilesPerTrigger`` (500) at a time, and names the batch's
    folders; joining days does not add to it. The ticks of a batch that was joined before its turn are all
    those of its time range.
    """
    folder = store.folders(BATCH_LOG)
    folder.fs.mkdirs(folder.at())
    reader = store.spark.readStream.schema(LOG_DDL).options(**{"maxFilesPerTrigger": "500", **(options or {})})

    def refresh(batch: DataFrame, batch_id: int) -> None:
        lines = batch.filter("low IS NOT NULL").collect()
        if not lines:
            return
        low, high = moment_of(min(r.low for r in lines)), moment_of(max(r.high for r in lines))
        ticks = store.batch_ticks([f for r in lines for f in r.folders])
        if ticks is None:
            ticks = store.scan_ticks(since=low, until=high + timedelta(microseconds=1))
        refresh_touched(store, ticks, low, high)

    writer = reader.json(store.path(BATCH_LOG)).writeStream.queryName(name).foreachBatch(refresh)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def start_all(ticks: DataFrame, store: TickStore, checkpoints: str, raw_trigger: str | None = None,
              bar_trigger: str | None = BAR_TRIGGER, clock: Column | None = None) -> list[StreamingQuery]:
    """The raw query and the micro-batch bar query over one stream, each with its own checkpoint."""
    base = checkpoints.rstrip("/")
    return [
        start_raw(ticks, store, f"{base}/raw", raw_trigger, clock),
        start_bars_batch(ticks, store, f"{base}/agg", trigger=bar_trigger, clock=clock),
    ]


def await_any(spark: SparkSession) -> None:
    """Return when any query ends; raise its error if it failed."""
    spark.streams.awaitAnyTermination()
