"""Feed health and repairs on live streams, with a little state carried from micro-batch to micro-batch.

What a batch leaves for the next is one small table, a row per feed, in a folder named after the batch: a batch
reads the folder of the one before it and writes its own. Outputs are folders by batch too. A batch that runs
again after a failure reads the same state and replaces the same folders, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.times import bucket_micros, span_micros
from tickloom.operators.ordered import assign_seq
from tickloom.operators.quality import seq_gaps
from tickloom.plans.refresh import rebuild_touched
from tickloom.sources.live import LiveFolders
from tickloom.sources.store import TickStore, moment_of
from tickloom.streaming.queries import BAR_TRIGGER, LATE_BY, _triggered


@dataclass(frozen=True)
class Carried:
    """A table that each micro-batch leaves for the next, and the folders of its output."""

    spark: SparkSession
    root: str

    def before(self, batch_id: int, schema: T.StructType) -> DataFrame:
        """What the batch before left; empty at the start."""
        if not LiveFolders(self.spark, self.root).exists(f"state/{batch_id - 1}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/state/{batch_id - 1}")

    def leave(self, batch_id: int, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(f"{self.root}/state/{batch_id}")
        folders = LiveFolders(self.spark, self.root)
        folders.delete(f"{self.root}/state/{batch_id - 2}")

    def put(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")

    def out(self, schema: T.StructType) -> DataFrame:
        """All output so far."""
        LiveFolders(self.spark, f"{self.root}/out").fs.mkdirs(LiveFolders(self.spark, f"{self.root}/out").at())
        return self.spark.read.schema(schema).parquet(f"{self.root}/out").select(*schema.names)


def _follow(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None,
            name: str, mode: str = "append") -> StreamingQuery:
    writer = rows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def _shape(df: DataFrame, keys: Sequence[str], *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in keys], *[T.StructField(n, k) for n, k in fields]])


# Silence ----------------------------------------------------------------------------------------

def stale_shape(ticks: DataFrame, feed: Sequence[str]) -> T.StructType:
    moment = T.TimestampType()
    return _shape(ticks, feed, ("gap_start", moment), ("gap_end", moment), ("gap_micros", T.LongType()))


def start_stale(ticks: DataFrame, root: str, checkpoint: str, threshold: str = "60 seconds",
                feed: Sequence[str] = (), delay: str = LATE_BY, trigger: str | None = BAR_TRIGGER,
                name: str = "stale") -> StreamingQuery:
    """Silent spells longer than ``threshold``, each reported once no tick can fall into it any more.

    A session of a feed lasts as long as its ticks are ``threshold`` apart at most; the watermark closes it,
    ``delay`` behind the newest tick of any feed. The spell before a session runs from the last tick of the
    session before, which is all that is carried. Heartbeats of any feed close the sessions of silent ones. Sessions are
    merged in each task before the shuffle (``build_session`` turns that on), so a hot feed costs few rows.
    """
    every = F.pmod(F.unix_micros("Trade_Time"), F.lit(1)).alias("_all")  # 0: Spark wants a key beside the session
    sessions = (
        ticks.withWatermark("Trade_Time", delay)
        .groupBy(every, *feed, F.session_window("Trade_Time", threshold))
        .agg(F.min("Trade_Time").alias("first_seen"), F.max("Trade_Time").alias("last_seen"))
    )
    carried = Carried(ticks.sparkSession, root)
    shape = _shape(ticks, feed, ("last_seen", T.TimestampType()))

    def write(batch: DataFrame, batch_id: int) -> None:
        before = carried.before(batch_id, shape).withColumn("first_seen", F.lit(None).cast("timestamp"))
        rows = before.unionByName(batch.select(*feed, "first_seen", "last_seen"))
        along = Window.partitionBy(*feed).orderBy("last_seen")
        gap = F.unix_micros("first_seen") - F.unix_micros("gap_start")
        spells = rows.withColumn("gap_start", F.lag("last_seen").over(along)).withColumn("gap_micros", gap)
        carried.put(batch_id, spells.filter(F.col("gap_micros") > span_micros(threshold)).select(
            *feed, "gap_start", F.col("first_seen").alias("gap_end"), "gap_micros"))
        last = rows.groupBy(*feed).agg(F.max("last_seen").alias("last_seen")).filter("last_seen IS NOT NULL")
        carried.leave(batch_id, last)

    return _follow(sessions, write, checkpoint, trigger, name)


# Numbers ----------------------------------------------------------------------------------------

def gap_shape(ticks: DataFrame, feed: Sequence[str]) -> T.StructType:
    return _shape(ticks, feed, *[(n, T.LongType()) for n in ("after_seq", "next_seq", "missing")])


def start_seq_gaps(ticks: DataFrame, root: str, checkpoint: str, feed: Sequence[str] = (),
                   order: str = "Timestamp_Web", trigger: str | None = BAR_TRIGGER,
                   name: str = "seq_gaps") -> StreamingQuery:
    """Jumps in ``Seq`` along arrival, also from the last tick of one micro-batch to the first of the next.

    The last ``Seq`` of each feed is carried and stands before the feed's ticks of the batch.
    """
    carried, shape = Carried(ticks.sparkSession, root), _shape(ticks, feed, ("Seq", T.LongType()))

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select(*feed, order, "Seq").filter(F.col("Seq").isNotNull() & F.col(order).isNotNull())
        before = carried.before(batch_id, shape).withColumn(order, F.lit(None).cast(ticks.schema[order].dataType))
        rows = before.unionByName(fresh)
        carried.put(batch_id, seq_gaps(rows, feed, order))
        last = F.max_by("Seq", F.struct(F.col(order).isNotNull(), order, "Seq")).alias("Seq")
        carried.leave(batch_id, rows.groupBy(*feed).agg(last).filter("Seq IS NOT NULL"))

    return _follow(ticks, write, checkpoint, trigger, name)


def start_running_numbers(ticks: DataFrame, root: str, checkpoint: str, feed: Sequence[str], order: Sequence[str],
                          name_of: str = "Seq", trigger: str | None = BAR_TRIGGER,
                          name: str = "running_numbers") -> StreamingQuery:
    """Running numbers per feed that go on from micro-batch to micro-batch; how many there were is carried."""
    carried = Carried(ticks.sparkSession, root)
    shape = _shape(ticks, feed, ("_n", T.LongType()))

    def write(batch: DataFrame, batch_id: int) -> None:
        before = carried.before(batch_id, shape)
        numbered = assign_seq(batch, feed, order, name_of).join(before, [*feed], "left")
        shifted = F.col(name_of) + F.coalesce(F.col("_n"), F.lit(0))
        carried.put(batch_id, numbered.withColumn(name_of, shifted).drop("_n"))
        counts = batch.groupBy(*feed).agg(F.count("*").alias("_n")).unionByName(before)
        carried.leave(batch_id, counts.groupBy(*feed).agg(F.sum("_n").alias("_n")))

    return _follow(ticks, write, checkpoint, trigger, name)


# Late ticks -------------------------------------------------------------------------------------

def start_late_ticks(ticks: DataFrame, root: str, checkpoint: str, interval: str, delay: str = LATE_BY,
                     trigger: str | None = BAR_TRIGGER, name: str = "late_ticks") -> StreamingQuery:
    """Put aside the ticks that event-time bars of ``interval`` may leave out.

    The newest event time is carried. A tick is late when its bucket ended ``delay`` before the newest tick of
    the batches before its own, the earliest that a bar query over the same batches can close the bucket.
    """
    carried = Carried(ticks.sparkSession, root)
    shape = T.StructType([T.StructField("newest", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        before = carried.before(batch_id, shape)
        newest = before.agg(F.max("newest")).first()[0]  # one row
        end = bucket_micros("Trade_Time", interval) + span_micros(interval)
        late = F.lit(False) if newest is None else end <= F.lit(newest - span_micros(delay))
        carried.put(batch_id, batch.filter(late))
        carried.leave(batch_id, batch.agg(F.max(F.unix_micros("Trade_Time")).alias("newest")).union(before)
                      .agg(F.max("newest").alias("newest")))

    return _follow(ticks, write, checkpoint, trigger, name)


def repair_late(store: TickStore, interval: str, late: DataFrame) -> tuple[datetime, datetime] | None:
    """Build exactly the bars that ``late`` ticks belong to again, from the raw table; returns their time range."""
    low, high = late.agg(F.min(F.unix_micros("Trade_Time")), F.max(F.unix_micros("Trade_Time"))).first()
    if low is None:
        return None
    rebuild_touched(store, interval, late, moment_of(low), moment_of(high))
    return moment_of(low), moment_of(high)
