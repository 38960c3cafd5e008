"""Table shapes. Column names and types are fixed values: they are the data format."""

from __future__ import annotations

import json

from pyspark.sql import types as T

TICK = T.StructType([
    T.StructField("t", T.LongType()),
    T.StructField("s", T.StringType()),
    T.StructField("p", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("c", T.ArrayType(T.StringType())),
    T.StructField("Hash", T.StringType()),
    T.StructField("Seq", T.LongType()),
])

ENVELOPES = T.ArrayType(T.StructType([
    T.StructField("timestamp_web", T.StringType()),
    T.StructField("data", T.ArrayType(TICK)),
]))

# One row per message, after decoding and before un-nesting.
MESSAGE = T.StructType([
    T.StructField("value", ENVELOPES),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Trade feed text before hashing and sequencing.
FEED_MESSAGE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType(TICK.fields[:5]))),
])

FLAT_TICK = T.StructType([
    T.StructField("Trade_type", T.ArrayType(T.StringType())),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Symbol", T.StringType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Trade_Time", T.TimestampType()),
    T.StructField("Hash_Web", T.StringType()),
    T.StructField("Seq", T.LongType()),
    T.StructField("Timestamp_Web", T.StringType()),
    T.StructField("Offset", T.LongType()),
    T.StructField("Partition", T.IntegerType()),
    T.StructField("Hash_Spark", T.StringType()),
])

# The stored tick also has the processing time of its batch.
RAW_TICK = T.StructType([*FLAT_TICK.fields, T.StructField("Spark_Time", T.TimestampType())])

BAR_FIELDS = ["Open", "High", "Low", "Close", "Total_Volume"]
MA_WINDOWS = (5, 10, 20, 60)

BAR = T.StructType(
    [T.StructField("Symbol", T.StringType()), T.StructField("time", T.TimestampType())]
    + [T.StructField(f, T.DoubleType()) for f in BAR_FIELDS]
    + [T.StructField(f"MA_{n}", T.DoubleType()) for n in MA_WINDOWS]
)

# Carried by bars made per micro-batch.
INGEST_FIELDS = [T.StructField(n, T.StringType()) for n in ("Spark_Time", "Start_Time", "End_Time")]

DAILY_VOLUME = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("T", T.StringType()),
    T.StructField("v", T.DoubleType()),
])

PROGRESS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("endOffset", T.StringType()),
    ]))),
])

# As logged: also what each stateful operator left out for being late, and what was counted on the way.
OBSERVED = ("ticks", "no_price", "foreign")
PROGRESS_LOG = T.StructType([
    *PROGRESS.fields, T.StructField("batchId", T.LongType()),
    T.StructField("stateOperators", T.ArrayType(T.StructType([
        T.StructField("numRowsDroppedByWatermark", T.LongType())]))),
    T.StructField("observedMetrics", T.StructType([
        T.StructField("ticks", T.StructType([T.StructField(n, T.LongType()) for n in OBSERVED]))])),
])


def tick_schema() -> str:
    """The wire schema as an Avro JSON document, for ``from_avro`` / ``to_avro``."""
    avro_names = {"bigint": "long", "string": "string", "double": "double"}

    def avro_field(field: T.StructField) -> dict:
        if isinstance(field.dataType, T.ArrayType):
            return {"name": field.name, "default": None,
                    "type": ["null", {"type": "array", "items": "string"}]}
        return {"name": field.name, "type": avro_names[field.dataType.simpleString()]}

    tick = {"type": "record", "name": "StockData",
            "fields": [avro_field(f) for f in TICK.fields]}
    envelope = {
        "type": "record",
        "name": "StockDataWithTimestamp",
        "fields": [
            {"name": "timestamp_web", "type": "string"},
            {"name": "data", "type": {"type": "array", "items": tick}},
        ],
    }
    return json.dumps({"type": "array", "items": envelope})
