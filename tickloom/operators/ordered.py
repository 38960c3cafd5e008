"""Row-order operators over histories too long for one task.

A plain window over a symbol or feed puts its whole history into one task. Here the history is cut
into segments, consecutive in the order. Rows deep enough in a segment see their whole frame there.
The first rows of each segment are finished from a small table that holds only the first and last
rows of every segment. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.times import bucket_micros
from tickloom.schema import MA_WINDOWS
from tickloom.session import materialize


Extend = Callable[[DataFrame, WindowSpec], DataFrame]


def over_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column,
                  depth: int, added: Sequence[str], extend: Extend) -> DataFrame:
    """``extend(df, window)``, which adds the columns ``added`` and looks at most ``depth`` rows back.

    ``segment`` must not decrease along ``order`` within ``keys``, and ``order`` must be total.
    Both branches read one shuffle by (keys, segment); the second shuffle carries at most
    ``2 * depth`` rows per segment.
    """
    columns = [*df.columns, *added]
    inside = Window.partitionBy(*keys, "_seg").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*order)
    placed = df.withColumn("_seg", segment).withColumns({
        "_from_start": F.row_number().over(inside),
        "_from_end": F.lead(F.lit(1), depth).over(inside),
    })
    head = F.col("_from_start") <= depth
    deep = extend(placed, inside).filter(~head)
    edges = placed.filter(head | F.col("_from_end").isNull())
    finished = extend(edges, across).filter(head)
    return deep.select(*columns).unionByName(finished.select(*columns))


def _with_sums(bars: DataFrame, window: WindowSpec, windows: Sequence[int]) -> DataFrame:
    """``_sum_n`` of the last n closes, null while there are fewer or one is null.

    A sum whose length is a multiple of the one before is put together from shifted copies of it
    (60 = 3 x 20 = 3 x 2 x 10...), so a row costs a few shifts instead of n additions per length.
    """
    done = 1
    for n in sorted(set(windows)):
        base, size = ("Close", 1) if n % done else (f"_sum_{done}" if done > 1 else "Close", done)
        total = F.col(base)
        for shift in range(size, n, size):
            total = total + F.lag(base, shift).over(window)
        bars = bars.withColumn(f"_sum_{n}", total)
        done = n
    return bars


def moving_averages(bars: DataFrame, windows: Sequence[int] = MA_WINDOWS, segment: str | None = "30 days",
                    keys: Sequence[str] = ("Symbol",)) -> DataFrame:
    """``MA_n``: mean Close of the last n observed bars of a symbol, null before there are n.

    A null Close anywhere in the frame gives null. A segment holds at most
    ``segment / bar interval`` bars per symbol. ``segment=None`` uses one plain window: right when
    a lookback already bounds the bars per symbol.
    """
    names = [f"MA_{n}" for n in windows]

    def averaged(df: DataFrame, window: WindowSpec) -> DataFrame:
        summed = _with_sums(df, window, windows)
        return summed.withColumns({f"MA_{n}": F.col(f"_sum_{n}") / n for n in windows})

    if segment is None:
        return averaged(bars, Window.partitionBy(*keys).orderBy("time")).select(*bars.columns, *names)
    return over_segments(bars, keys, ["time"], bucket_micros("time", segment),
                         max(windows) - 1, names, averaged)


def range_segments(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort into balanced range partitions and note each row's partition and place.

    Adds ``_id``, increasing along ``order``, and ``_segment``, its range partition. Range bounds
    are sampled, so a hot key or hour is split like any other as long as ``order`` is total. The
    result is written once, because the bounds of a second run may differ.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_segment", F.shiftrightunsigned("_id", 33))
    )
    return materialize(placed)


def assign_seq(df: DataFrame, feed: Sequence[str], order: Sequence[str],
               name: str = "Seq") -> DataFrame:
    """Running number 1, 2, 3... per feed along ``order``, which must be total within a feed.

    One range shuffle; a row's number is its place in its partition plus the count of its feed's
    rows in the partitions before.
    """
    placed = range_segments(df, [*feed, *order])
    parts = materialize(
        placed.groupBy(*feed, "_segment").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    )
    before = Window.partitionBy(*feed).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")
    renamed = {k: f"_f{i}" for i, k in enumerate(feed)}
    starts = parts.select(
        *[F.col(k).alias(r) for k, r in renamed.items()],
        F.col("_segment").alias("_s"),
        shift.alias("_shift"),
    )
    match = F.col("_segment") == F.col("_s")
    for k, r in renamed.items():
        match = match & F.col(k).eqNullSafe(F.col(r))
    numbered = placed.join(starts, match)
    kept = [c for c in df.columns if c != name]
    return numbered.select(*kept, (F.col("_id") + F.col("_shift")).alias(name))
