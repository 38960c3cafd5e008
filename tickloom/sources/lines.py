"""Line-protocol text: ``table,tag=value field=value timestamp``, missing fields left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import clock_text, epoch_ns


def _escaped(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit("\\" + character))
    return text


def _field(df: DataFrame, name: str) -> Column:
    """``name=value``, null when the value is null or NaN."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.when(~F.isnan(value), value.cast("string"))
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        text = F.concat(F.lit('"'), _escaped(F.to_json(value), '\\"'), F.lit('"'))
    elif isinstance(kind, (T.StringType, T.TimestampType, T.DateType)):
        text = F.concat(F.lit('"'), _escaped(value.cast("string"), '\\"'), F.lit('"'))
    else:
        text = value.cast("string")
    return F.concat(F.lit(_escape_name(name) + "="), text)


def _escape_name(name: str, characters: str = ",= ") -> str:
    for character in characters:
        name = name.replace(character, "\\" + character)
    return name


def _any_present(df: DataFrame, fields: Sequence[str]) -> Column:
    """Whether a row has a field to write; plain null tests, so no text is built twice."""
    present = F.lit(False)
    for name in fields:
        known = F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            known = known & ~F.isnan(name)
        present = present | known
    return present


# Tags and fields of a raw point.
RAW_TAGS = ["Symbol", "Partition"]
RAW_FIELDS = ["Trade_type", "Price", "Volume", "Trade_Time", "Timestamp_Web", "Spark_Time", "Hash_Web", "Hash_Spark",
              "Seq", "Offset"]
#: Wire times are in milliseconds, so a tie may use that many nanoseconds.
MOST_TIED = 1_000_000


def unique_ns(df: DataFrame, ts: str, tags: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``point_ns``: nanoseconds of ``ts`` plus the rank inside a tie of tags and millisecond.

    A store keeps one point per tags and time, so tied rows need times of their own. Ties that would
    run into the next millisecond stop the job.
    """
    millis = F.unix_millis(ts)
    rank = F.row_number().over(Window.partitionBy(*tags, "_millis").orderBy(ts, *order)) - 1
    ranked = df.withColumn("_millis", millis).withColumn("_rank", rank)
    too_many = F.raise_error(F.lit(f"more than {MOST_TIED} ticks share tags and millisecond")).cast("bigint")
    stamp = F.when(F.col("_rank") < MOST_TIED, F.col("_millis") * 1_000_000 + F.col("_rank")).otherwise(too_many)
    return ranked.withColumn("point_ns", stamp).drop("_millis", "_rank")


def raw_points(ticks: DataFrame, spark_time: Column) -> DataFrame:
    """Flat ticks with the fields of a raw point and a time of its own for each."""
    unique = unique_ns(ticks, "Trade_Time", RAW_TAGS, ["Seq", "Offset"])
    return unique.withColumns({"Trade_Time": clock_text("Trade_Time"), "Spark_Time": clock_text(spark_time)})


def to_line_protocol(df: DataFrame, table: str, tags: Sequence[str], fields: Sequence[str],
                     ts: str = "time", ns: str | None = None) -> DataFrame:
    """One ``line`` per row; null tags and fields are left out, a row without fields gives none."""
    tag_texts = [
        F.concat(F.lit(_escape_name(t) + "="), _escaped(F.col(t).cast("string"), ",= ")) for t in tags
    ]
    head = F.concat_ws(",", F.lit(_escape_name(table, ", ")), *tag_texts)
    body = F.concat_ws(",", *[_field(df, f) for f in fields])
    stamp = epoch_ns(ts) if ns is None else F.col(ns)
    line = F.concat_ws(" ", head, body, stamp.cast("string"))
    return df.filter(_any_present(df, fields)).select(line.alias("line"))


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Text files, written by all tasks in parallel."""
    df.write.mode(mode).text(path)
