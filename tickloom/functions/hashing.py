"""Tick fingerprint: SHA-256 over a joined text key, as one built-in expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form both ends must agree on.
SEPARATOR = "|"
NUMBER_FORMAT = "%.10f"
NULL_LIST = "null"
NULL_TEXT = "None"


def fixed_decimals(number: Column) -> Column:
    return F.format_string(NUMBER_FORMAT, number)


def json_list(items: Column) -> Column:
    """Compact JSON of an array, ``null`` for a missing one."""
    return F.coalesce(F.to_json(items), F.lit(NULL_LIST))


def joined_key(*parts: Column) -> Column:
    """Join with the separator; a missing part keeps its place."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_TEXT)) for p in parts])


def tick_hash(symbol: Column, epoch_millis: Column, price: Column, volume: Column,
              conditions: Column) -> Column:
    """Equal to the sender's hash for finite prices of ordinary size and ASCII conditions.

    Outside that domain (very small or very large doubles, non-ASCII conditions) the two
    sides round or escape differently.
    """
    key = joined_key(symbol, epoch_millis, fixed_decimals(price), fixed_decimals(volume),
                     json_list(conditions))
    return F.sha2(key, 256)
