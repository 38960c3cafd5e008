"""Tick views over the given tables, so that every operator runs on whole tables.

Timestamps are read as UTC instants by giving the scan its schema; no cast stands between a time
filter and the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.hashing import tick_hash
from tickloom.functions.times import iso_millis
from tickloom.schema import FLAT_TICK

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
LINEITEM = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_shipdate timestamp")
ORDERS = "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"

FEEDS = 3
TICKS_PER_MESSAGE = 8
CENTS = 1 << 24


def _feed() -> Column:
    return (F.col("user_id") % FEEDS).cast("int")


def _volume() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def plain_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks with only the columns bars need."""
    return events.select(
        F.col("event_type").alias("Symbol"), F.col("value").alias("Price"), _volume().alias("Volume"),
        F.col("ts").alias("Trade_Time"), F.col("event_id").alias("Seq"),
    )


def ingest_time() -> Column:
    """When an event was taken in: ``k`` milliseconds after it."""
    return F.timestamp_micros(F.unix_micros("ts") + _volume().cast("bigint") * 1000)


def flat_ticks(events: DataFrame) -> DataFrame:
    """Events in the full flat-tick shape.

    The ingest text lies ``k`` milliseconds after the event; every 97th tick carries a foreign
    fingerprint; eight consecutive ids of a feed make a message.
    """
    volume = _volume()
    conditions = F.array("event_type")
    fingerprint = tick_hash(F.col("event_type"), F.unix_millis("ts"), F.col("value"), volume, conditions)
    fields = {
        "Trade_type": conditions,
        "Price": F.col("value"),
        "Symbol": F.col("event_type"),
        "Volume": volume,
        "Trade_Time": F.col("ts"),
        "Hash_Web": F.when(F.col("event_id") % 97 == 0, F.lit("0")).otherwise(F.col("fingerprint")),
        "Seq": F.col("event_id"),
        "Timestamp_Web": iso_millis(ingest_time()),
        "Offset": F.floor(F.col("event_id") / TICKS_PER_MESSAGE),
        "Partition": _feed(),
        "Hash_Spark": F.col("fingerprint"),
    }
    position = (F.col("event_id") % TICKS_PER_MESSAGE).cast("int").alias("Position")
    hashed = events.withColumn("fingerprint", fingerprint)
    return hashed.select(*[fields[n].alias(n) for n in FLAT_TICK.names], position)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pattern form of the path lets the table be one file or a folder of files."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def replay(spark: SparkSession, sf_dir: str, path: str, parts: int,
           by: Column | None = None) -> Callable[[int], DataFrame]:
    """The events written below ``path`` in ``parts`` steps, to be streamed one step per micro-batch.

    By default the steps follow event time, else ``by`` names the step of a row. The result takes a
    step: it writes what is missing up to it and opens all that is there as a stream. Each step has as many
    files as the scan of the events has partitions, empty ones where it has too few rows, and a micro-batch
    takes that many: the number of micro-batches does not grow with the events.
    """
    events = read_events(spark, sf_dir)
    files = max(1, events.rdd.getNumPartitions())
    if by is None:
        low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
        width = max(1, ((high or 0) - (low or 0)) // parts + 1)
        by = F.floor((F.unix_micros("ts") - F.lit(low or 0)) / width)
    written = [0]

    def upto(step: int) -> DataFrame:
        while written[0] <= step:
            events.filter(by == written[0]).repartition(files).write.mode("append").parquet(path)
            written[0] += 1
            for _ in range(files * written[0] - len(spark.read.schema(EVENTS).parquet(path).inputFiles())):
                spark.createDataFrame([], EVENTS).write.mode("append").parquet(path)
        return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)

    return upto


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines as ticks of their supplier: day grain, so nearly every time is shared.

    (orderkey, linenumber) is not unique, so ``Seq`` also packs the price in cents (below 2^24).
    """
    lines = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(
        F.col("l_suppkey").cast("string").alias("Symbol"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_quantity").alias("Volume"),
        F.col("l_shipdate").alias("Trade_Time"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * CENTS
         + F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("Seq"),
    )


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ticks of their priority; the order key is unique."""
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.col("o_orderpriority").alias("Symbol"), F.col("o_totalprice").alias("Price"),
        F.lit(1.0).alias("Volume"), F.col("o_orderdate").alias("Trade_Time"),
        F.col("o_orderkey").alias("Seq"),
    )


def feed_text(events: DataFrame) -> DataFrame:
    """Events as feed messages in JSON text, with pings and cut-off messages between them."""
    tick = F.struct(F.unix_millis("ts").alias("t"), F.col("event_type").alias("s"),
                    F.col("value").alias("p"), _volume().alias("v"), F.array("event_type").alias("c"))
    trade = F.to_json(F.struct(F.lit("trade").alias("type"), F.array(tick).alias("data")))
    cut = F.concat(F.lit('{"type":"trade","data":['), F.col("event_id").cast("string"))
    text = (
        F.when(F.col("event_id") % 17 == 0, cut)
        .when(F.col("event_id") % 10 == 0, F.lit('{"type":"ping"}'))
        .otherwise(trade)
    )
    return events.select("event_id", text.alias("value"))


def progress_reports(ticks: DataFrame, topic: str = "stock_data") -> DataFrame:
    """Hourly progress reports of a query that would have read ``ticks`` from a topic."""
    hour = F.timestamp_micros(F.unix_micros("Trade_Time") - F.pmod(F.unix_micros("Trade_Time"), F.lit(3_600_000_000)))
    ends = (
        ticks.groupBy(hour.alias("timestamp"), F.col("Partition").cast("string").alias("p"))
        .agg(F.max("Offset").alias("end"), F.count("*").alias("n"))
    )
    per_hour = ends.groupBy("timestamp").agg(
        F.sum("n").alias("numInputRows"),
        F.map_from_entries(F.collect_list(F.struct("p", "end"))).alias("ends"),
    )
    source = F.struct(F.lit("topic reader").alias("description"),
                      F.to_json(F.create_map(F.lit(topic), F.col("ends"))).alias("endOffset"))
    return per_hour.select(F.lit("raw").alias("name"), "timestamp", "numInputRows",
                           F.array(source).alias("sources"))
