"""Nested trade messages: un-nest, re-nest, keep trades, look one message up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.hashing import tick_hash
from tickloom.functions.times import from_epoch_millis, to_market_clock
from tickloom.schema import FLAT_TICK, TICK

MESSAGE_KEYS = ["Partition", "Offset"]


def _ticks(df: DataFrame, position: bool) -> DataFrame:
    """One row per tick, each with its own envelope's time."""
    envelopes = df.select(
        F.col("partition").alias("Partition"),
        F.col("offset").alias("Offset"),
        F.explode("value").alias("envelope"),
    )
    keep = [*MESSAGE_KEYS, F.col("envelope.timestamp_web").alias("Timestamp_Web")]
    if position:
        return envelopes.select(*keep, F.posexplode("envelope.data").alias("Position", "tick"))
    return envelopes.select(*keep, F.explode("envelope.data").alias("tick"))


def flatten_ticks(df: DataFrame, zone: str | None = None, position: bool = False) -> DataFrame:
    """Messages ``(value, partition, offset)`` to flat ticks, hashed again on this side.

    ``Trade_Time`` is the UTC instant; with ``zone`` it is shifted to that zone's wall clock.
    A narrow plan: two generators and projections, no shuffle, the same on batch and stream.
    """
    tick = F.col("tick")
    instant = from_epoch_millis(tick["t"])
    price = tick["p"].cast("double")
    volume = tick["v"].cast("double")
    fields: dict[str, Column] = {
        "Trade_type": tick["c"],
        "Price": price,
        "Symbol": tick["s"],
        "Volume": volume,
        "Trade_Time": to_market_clock(instant, zone) if zone else instant,
        "Hash_Web": tick["Hash"],
        "Seq": tick["Seq"],
        "Timestamp_Web": F.col("Timestamp_Web"),
        "Offset": F.col("Offset"),
        "Partition": F.col("Partition"),
        "Hash_Spark": tick_hash(tick["s"], tick["t"], price, volume, tick["c"]),
    }
    columns = [fields[name].alias(name) for name in FLAT_TICK.names]
    if position:
        columns.append(F.col("Position"))
    return _ticks(df, position).select(*columns)


def wire_tick() -> Column:
    """The wire struct of a flat tick."""
    sources = {"t": F.unix_millis("Trade_Time"), "s": F.col("Symbol"), "p": F.col("Price"),
               "v": F.col("Volume"), "c": F.col("Trade_type"), "Hash": F.col("Hash_Web"),
               "Seq": F.col("Seq")}
    return F.struct(*[sources[f.name].cast(f.dataType).alias(f.name) for f in TICK.fields])


def build_envelopes(df: DataFrame, max_ticks: int = 1000) -> DataFrame:
    """Flat ticks back to messages ``(value, partition, offset, part)`` of one envelope each.

    ``Position`` (the tick's place in its message) cuts a message into parts of ``max_ticks``
    ticks, so no group outgrows ``max_ticks`` however large a message is; every tick is kept.
    """
    part = F.floor(F.col("Position") / F.lit(max_ticks)).cast("int")
    grouped = df.groupBy(*MESSAGE_KEYS, part.alias("part")).agg(
        F.min("Timestamp_Web").alias("timestamp_web"),
        F.sort_array(F.collect_list(F.struct("Position", wire_tick().alias("tick")))).alias("rows"),
    )
    envelope = F.struct(
        "timestamp_web",
        F.transform("rows", lambda r: r["tick"]).alias("data"),
    )
    return grouped.select(
        F.array(envelope).alias("value"),
        F.col("Partition").cast("int").alias("partition"),
        F.col("Offset").alias("offset"),
        "part",
    )


def ticks_per_message(df: DataFrame) -> DataFrame:
    """Number of ticks each message row carries."""
    sizes = F.transform("value", lambda e: F.size(e["data"]))
    total = F.aggregate(sizes, F.lit(0), lambda a, b: a + F.greatest(b, F.lit(0)))
    return df.select("partition", "offset", total.alias("n_ticks"))


def only_trades(df: DataFrame) -> DataFrame:
    """Keep trade messages; pings and messages without a type go."""
    return df.filter(F.col("type") == "trade")


def lookup_offset(df: DataFrame, partition: int, offset: int) -> DataFrame:
    """The ticks of the message at (partition, offset), numbered by their place in it."""
    message = df.filter((F.col("partition") == partition) & (F.col("offset") == offset))
    return flatten_ticks(message, position=True).select(
        "Partition", "Offset", "Position", "Symbol", "Price", "Volume", "Seq", F.col("Hash_Web").alias("Hash"),
    )
