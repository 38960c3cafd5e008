"""Re-aggregation of the bars that new ticks touch, level by level, with moving averages.

Changed (Symbol, bucket) keys go up the levels: ticks name the finest bars to build, those name the next
coarser ones, which are built from stored and changed finer bars of their own buckets. A changed bar changes the
averages of at most ``max(windows) - 1`` bars after it, and only those are written again.

What averages need from before comes from the tail of each level: the last closes of every symbol before a
moment that moves on behind the newest bar. Closes after it are read from the table, a bounded stretch of
time. So a symbol that was never seen, or that trades once a month, widens no scan. Only bars that change before
that moment (ticks later than the lookback) read the closes of their symbols from the whole table, and put the
tail of those symbols right.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import bucket_micros, floor_moment, lookback_start, moment_literal, span
from tickloom.operators.bars import rollup_bars, tick_bars
from tickloom.operators.ordered import moving_averages
from tickloom.schema import BAR_FIELDS, MA_WINDOWS
from tickloom.sources.live import unique
from tickloom.sources.store import BAR_TABLES, LEVELS, RAW, TickStore, last_closes, micros, moment_of

#: A tail moves on when the newest bar is so many lookbacks ahead of it, to one lookback behind that bar.
TAIL_BEHIND = 3
#: Above so many lookbacks between tail and newest bar, a symbol's bars are averaged in segments.
PLAIN_LOOKBACKS = 12
_NOW = 1 << 62  # the version of what changes now


@dataclass(frozen=True)
class Range:
    """Buckets of a level to build: from ``start``, before ``stop`` if there is one."""

    start: datetime
    stop: datetime | None = None


def _ranges(low: datetime, high: datetime | None) -> dict[str, Range]:
    return {i: Range(floor_moment(low, i), high and floor_moment(high, i) + span(i)) for i in BAR_TABLES}


def _changed_bars(store: TickStore, interval: str, where: Range, finer: DataFrame | None,
                  ticks: DataFrame | None) -> DataFrame:
    """The bars of one level that ``ticks`` (of the finest) or changed ``finer`` bars touch; None: all in range."""
    order = list(BAR_TABLES)
    keys = ("Symbol", "_bucket")
    if finer is None:
        every = store.scan_ticks(since=where.start, until=where.stop)
        if ticks is not None:
            touched = ticks.select("Symbol", bucket_micros("Trade_Time", interval).alias("_bucket")).distinct()
            every = every.withColumn("_bucket", bucket_micros("Trade_Time", interval)).join(touched, [*keys], "left_semi")
        return tick_bars(every, interval)
    columns = ["Symbol", "time", *BAR_FIELDS, "version"]
    stored, _ = store.scan_versions(BAR_TABLES[order[order.index(interval) - 1]], where.start, where.stop)
    stored = stored.select(*columns).withColumn("_bucket", bucket_micros("time", interval))
    fresh = finer.filter(F.col("time") >= moment_literal(where.start)).withColumn("version", F.lit(_NOW)).select(*columns)
    fresh = fresh.withColumn("_bucket", bucket_micros("time", interval))
    if ticks is not None:
        stored = stored.join(fresh.select(*keys).distinct(), [*keys], "left_semi")
    # laid out by coarse bucket once: versions meet and finer bars are rolled up inside those partitions
    laid = stored.unionByName(fresh).repartition(*keys)
    fields = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("version"))).alias(f) for f in BAR_FIELDS]
    return rollup_bars(laid.groupBy(*keys, "time").agg(*fields), interval, within=["_bucket"]).drop("_bucket")


def _averaged(store: TickStore, changed: Mapping[str, DataFrame], tails: Mapping[str, tuple[int, DataFrame]],
              windows: Sequence[int], segment: str | None) -> DataFrame:
    """Changed bars of some levels with averages, and the averages of the bars after them that they change.

    All changed bars are at or after their tail's moment. The levels share every shuffle; ``_table`` tells them apart.
    """
    keys, stored, own = ("_table", "Symbol"), None, None
    for interval, bars in changed.items():
        table, (moment, before) = BAR_TABLES[interval], tails[interval]
        since, _ = store.scan_versions(table, since=moment_of(moment))
        closes = since.selectExpr("Symbol", "time", "Close", "version", f"'{table}' AS _table").union(
            before.selectExpr("Symbol", "time", "Close", "0L", f"'{table}'"))
        bars = bars.selectExpr("Symbol", "time", *BAR_FIELDS, f"{_NOW}L AS version", f"'{table}' AS _table")
        stored = closes if stored is None else stored.union(closes)
        own = bars if own is None else own.union(bars)
    context = stored.join(own.select(*keys).distinct(), [*keys], "left_semi")
    rows = own.unionByName(context, allowMissingColumns=True).repartition(*keys)
    newest = [F.expr(f"max_by({f}, if({f} IS NULL, NULL, version)) AS {f}") for f in BAR_FIELDS]
    merged = rows.groupBy(*keys, "time").agg(*newest, F.expr(f"max(version) = {_NOW}L AS _changed"))
    if segment is None:
        reach = Window.partitionBy(*keys).orderBy("time").rowsBetween(-(max(windows) - 1), 0)
        merged = merged.withColumn("_near", F.max("_changed").over(reach))
        averaged = moving_averages(merged, windows, None, keys).filter("_near")
    else:
        firsts = own.groupBy(*keys).agg(F.min("time").alias("_first"))
        averaged = moving_averages(merged, windows, segment, keys).join(firsts, [*keys]).filter("time >= _first")
    values = [f"if(_changed, {f}, NULL) AS {f}" for f in BAR_FIELDS]
    return averaged.selectExpr(*keys, "time", *values, *[f"MA_{n}" for n in windows])


def _refresh(store: TickStore, ranges: Mapping[str, Range], newest: datetime, ticks: DataFrame | None,
             windows: Sequence[int]) -> None:
    """Build the bars of every level in its range, or those that ``ticks`` touch, and what follows from them."""
    depth = max(windows) - 1
    tails = _tails(store, ranges, newest, depth)
    near = all(micros(where.start) >= tails[i][0]
               and newest - moment_of(tails[i][0]) <= PLAIN_LOOKBACKS * span(LEVELS[BAR_TABLES[i]][1])
               for i, where in ranges.items())
    if near:
        _refresh_at_once(store, ranges, ticks, tails, windows)
    else:
        _refresh_by_level(store, ranges, ticks, tails, windows)
    _move_tails(store, newest, depth)


def _refresh_at_once(store, ranges, ticks, tails, windows) -> None:
    """All levels in one job: the changed bars are few and kept for the next level."""
    changed, finer = {}, None
    try:
        for interval, where in ranges.items():
            finer = _changed_bars(store, interval, where, finer, ticks).persist()
            changed[interval] = finer
        store.upsert_tables(_averaged(store, changed, tails, windows, None), list(BAR_TABLES.values()), keep_tails=True)
    finally:
        for bars in changed.values():
            bars.unpersist()


def _refresh_by_level(store, ranges, ticks, tails, windows) -> None:
    """Level by level, for a history of any length: changed bars are written first and read again."""
    depth, finer, aside = max(windows) - 1, None, store.path(f"_staging/{unique()}")
    for interval, where in ranges.items():
        table = BAR_TABLES[interval]
        path = f"{aside}/{table}"
        _changed_bars(store, interval, where, finer, ticks).write.parquet(path)
        finer = store.spark.read.parquet(path)
        tail, moment = tails[interval], micros(where.start)
        late = moment < tail[0]
        if late:  # the closes before the first changed bar, from the whole table
            symbols = finer.select("Symbol").distinct()
            stored = store.scan_bars(interval).join(symbols, "Symbol", "left_semi")
            tail = moment, last_closes(stored.filter(F.col("time") < moment_literal(where.start)), depth)
        averaged = _averaged(store, {interval: finer}, {interval: tail}, windows, "30 days")
        store.upsert_tables(averaged, [table], keep_tails=True)
        if late:
            _mend_tail(store, interval, tails[interval], finer.select("Symbol").distinct(), depth)
    store.folders(RAW).delete(aside)


def _mend_tail(store: TickStore, interval: str, tail: tuple[int, DataFrame], symbols: DataFrame, depth: int) -> None:
    """Take the tail of ``symbols`` from the table again."""
    moment, rows = tail
    stored = store.scan_bars(interval, until=moment_of(moment)).join(symbols, "Symbol", "left_semi")
    mended = rows.join(symbols, "Symbol", "left_anti").unionByName(last_closes(stored, depth))
    store.write_tails({BAR_TABLES[interval]: (moment, mended)})


def _tails(store: TickStore, ranges: Mapping[str, Range], newest: datetime,
           depth: int) -> dict[str, tuple[int, DataFrame]]:
    """Every level's tail; those that are missing are made, in one job, from the bars before its range or lookback."""
    tails = {i: store.tail(BAR_TABLES[i]) for i in ranges}
    made = {}
    for interval in (i for i, tail in tails.items() if tail is None):
        moment = min(ranges[interval].start, lookback_start(newest, LEVELS[BAR_TABLES[interval]][1], interval))
        made[BAR_TABLES[interval]] = micros(moment), last_closes(store.scan_bars(interval, until=moment), depth)
    if made:
        store.write_tails(made)
        tails = {i: store.tail(BAR_TABLES[i]) for i in ranges}
    return tails


def _move_tails(store: TickStore, newest: datetime, depth: int) -> None:
    """Move on the tails that are far behind: from the old tail and the bars since, for all symbols, in one job."""
    moved = {}
    for table, (interval, lookback) in LEVELS.items():
        moment, rows = store.tail(table)
        if newest - moment_of(moment) > TAIL_BEHIND * span(lookback):
            ahead = floor_moment(newest - span(lookback), interval)
            between = store.scan_bars(interval, since=moment_of(moment), until=ahead).select("Symbol", "time", "Close")
            moved[table] = micros(ahead), last_closes(rows.unionByName(between), depth)
    if moved:
        store.write_tails(moved)


def refresh_bars(store: TickStore, now: datetime, windows: Sequence[int] = MA_WINDOWS) -> None:
    """Refresh every level over its own lookback before ``now``, whatever ticks are new."""
    ranges = {i: Range(lookback_start(now, lookback, align=i)) for i, lookback in LEVELS.values()}
    _refresh(store, ranges, now, None, windows)


def refresh_since(store: TickStore, since: datetime, windows: Sequence[int] = MA_WINDOWS) -> None:
    """Refresh every level from the bucket of ``since`` on, whatever ticks are new."""
    newest = _newest(store)
    if newest is not None:
        _refresh(store, _ranges(since, None), max(newest, since), None, windows)


def refresh_touched(store: TickStore, ticks: DataFrame, low: datetime, high: datetime,
                    windows: Sequence[int] = MA_WINDOWS) -> None:
    """Refresh the bars that stored ``ticks``, all within [low, high], touch, and what follows from them."""
    newest = max(high, _newest(store) or high)
    _refresh(store, _ranges(low, high), newest, ticks, windows)


def rebuild_touched(store: TickStore, interval: str, ticks: DataFrame, low: datetime, high: datetime) -> None:
    """Build the bars of one level that ``ticks``, all within [low, high], touch, straight from the raw table."""
    store.upsert_bars(interval, _changed_bars(store, interval, _ranges(low, high)[interval], None, ticks))


def _newest(store: TickStore) -> datetime | None:
    """The newest stored tick, from the lists of the last dates alone."""
    folders = store.folders(RAW)
    for part in reversed(folders.partitions()):
        highs = [e.high for e in folders.read(part)[1] if e.high is not None]
        if highs:
            return moment_of(max(highs))
    return None
