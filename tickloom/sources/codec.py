"""Message decoding and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro, to_avro

from tickloom.schema import FEED_MESSAGE, tick_schema

BAD = "_bad"


def decode_avro(df: DataFrame, schema_json: str | None = None) -> DataFrame:
    """Binary ``value`` to nested envelopes; partition and offset stay beside it.

    Needs the spark-avro package; Spark names it in its error when it is missing.
    """
    value = from_avro("value", schema_json or tick_schema())
    return df.select(value.alias("value"), "partition", "offset")


def encode_avro(df: DataFrame, schema_json: str | None = None) -> DataFrame:
    """Nested envelopes to binary ``value``, ready for a topic."""
    return df.withColumn("value", to_avro("value", schema_json or tick_schema()))


def parse_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Feed text parsed in one pass: ``type``, ``data`` and the text itself where it is bad.

    The parse sits in a one-element ``explode``: Spark does not move filters on its result below a
    generator, so a text is parsed once however many filters and columns follow.
    """
    shape = T.StructType([*FEED_MESSAGE.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    others = [c for c in df.columns if c != column]
    once = F.explode(F.array(F.from_json(column, shape, options))).alias("message")
    parsed = df.select(*others, F.col(column), once)
    bad = F.when(F.col("message").isNull(), F.col(column)).otherwise(F.col(f"message.{BAD}"))
    return parsed.select(*others, "message.type", "message.data", bad.alias(BAD))


def decode_json(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(well-formed messages, malformed texts)."""
    parsed = parse_json(df, column)
    good = parsed.filter(F.col(BAD).isNull()).drop(BAD)
    bad = parsed.filter(F.col(BAD).isNotNull()).drop("type", "data").withColumnRenamed(BAD, column)
    return good, bad
