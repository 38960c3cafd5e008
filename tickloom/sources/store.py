"""Parquet tables of ticks and bars, laid out by date; coarse bars by month.

Every write is a new folder below its date: a batch of ticks, or a version of bars. Nothing that is stored
is rewritten to add rows. ``live`` keeps, per partition, the list of folders that count; a write is seen when the
next list names it. Readers of bars take, per (Symbol, time) and field, the value of the newest version that is
not null. Versions are joined by size class while they are written, so an open day never has many; a joined
version keeps the number of the newest in it, so it never hides one that was committed later.

A time bound becomes a list of folders whose time range overlaps it, so others are not even opened, and a
pushed-down row filter.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import lookback_start, moment_literal, utc
from tickloom.operators.bars import CASCADE, rollup_cascade, tick_bars
from tickloom.schema import BAR, FLAT_TICK, INGEST_FIELDS, RAW_TICK
from tickloom.sources.live import (
    FAN, Entry, LiveFolders, at_once, batch_ranges, bounds, in_ranges, joinable, unique)

RAW = "raw"
MICROBATCH = "5sec"
TAILS = "tails"
BATCH_LOG = "raw-batches"

# Table name, bar interval and lookback of each level, finest first.
LEVELS = {
    "5sec-monitor": ("5 seconds", "10 minutes"),
    "1m-monitor": ("1 minute", "2 hours"),
    "5m-monitor": ("5 minutes", "4 hours"),
    "15m-monitor": ("15 minutes", "8 hours"),
    "1h-monitor": ("1 hour", "70 hours"),
}
BAR_TABLES = {interval: table for table, (interval, _) in LEVELS.items()}


# Bars of these tables are so few that a day would make small files.
MONTHLY = frozenset({"15m-monitor", "1h-monitor"})

#: What the log keeps of a batch: its time range in epoch microseconds and its folders below the raw table.
LOG_DDL = "batch string, low bigint, high bigint, folders array<string>"
TAIL_DDL = "Symbol string, time timestamp, Close double"
VERSIONED = [*BAR.fields, *INGEST_FIELDS, T.StructField("version", T.StringType())]


def _utc_parts(ts: str) -> dict[str, Column]:
    """Month and date of the UTC instant, whatever the session zone."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col(ts)) / 86400).cast("int"))
    return {"month": F.trunc(day, "month"), "date": day}


def with_layout(df: DataFrame, ts: str, part: str) -> DataFrame:
    return df.withColumn(part, _utc_parts(ts)[part])


def micros(moment: datetime | None) -> int | None:
    if moment is None:
        return None
    return (utc(moment) - utc(datetime(1970, 1, 1))) // timedelta(microseconds=1)


def moment_of(micros_: int) -> datetime:
    return utc(datetime(1970, 1, 1)) + timedelta(microseconds=micros_)


@dataclass(frozen=True)
class TickStore:
    """The tables below one root folder; any number of writers.

    ``retain``: how long folders stay that joined ones replaced, for readers that began before.
    """

    spark: SparkSession
    root: str
    retain: timedelta = timedelta(hours=1)

    def layout(self, table: str) -> str:
        return "month" if table in MONTHLY else "date"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def folders(self, table: str) -> LiveFolders:
        return LiveFolders(self.spark, self.path(table), self.retain)

    # Reading ----------------------------------------------------------------------------------------

    def _first(self, table: str, since: datetime | None) -> str | None:
        if since is None:
            return None
        part, day = self.layout(table), utc(since).date()
        return f"{part}={day.replace(day=1) if part == 'month' else day}"

    def live(self, table: str, since: datetime | None = None,
             until: datetime | None = None) -> dict[str, list[Entry]]:
        """Per partition the live folders whose time range overlaps [since, until)."""
        low, high = micros(since), micros(until)
        found = self.folders(table).live(self._first(table, since))
        return {p: kept for p, es in found.items() if (kept := [e for e in es if e.overlaps(low, high)])}

    def _open(self, table: str, shape: Iterable[T.StructField], paths: Sequence[str]) -> DataFrame:
        schema, root = _ddl(shape), self.path(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])

    def has_bars(self, interval: str) -> bool:
        return bool(self.live(BAR_TABLES[interval]))

    def scan_raw(self, lookback: str | None = None, now: datetime | None = None, since: datetime | None = None,
                 until: datetime | None = None, symbols: Sequence[str] | None = None) -> DataFrame:
        """Stored ticks with their processing time: all, or those in [since, until) or of some symbols.

        Joined days are sorted by symbol, so the symbol filter skips most of their row groups.
        """
        start = lookback_start(now, lookback) if lookback else since
        paths = [f"{p}/{e.name}" for p, entries in self.live(RAW, start, until).items() for e in entries]
        found = _between(self._open(RAW, RAW_TICK.fields, paths), "Trade_Time", start, until)
        return found if symbols is None else found.filter(F.col("Symbol").isin(*symbols))

    def scan_ticks(self, lookback: str | None = None, now: datetime | None = None, since: datetime | None = None,
                   until: datetime | None = None, symbols: Sequence[str] | None = None) -> DataFrame:
        """Stored ticks: all, or those in [since, until) or of some symbols."""
        return self.scan_raw(lookback, now, since, until, symbols).select(*FLAT_TICK.names)

    def scan_versions(self, table: str, since: datetime | None = None,
                      until: datetime | None = None) -> tuple[DataFrame, bool]:
        """Rows of all live versions with their number, and whether each bar is there only once."""
        live = self.live(table, since, until)
        paths = [f"{p}/{e.name}" for p, entries in live.items() for e in entries]
        rows = _between(self._open(table, VERSIONED, paths), "time", since, until)
        number = F.substring_index("version", "-", 1).cast("long")
        return rows.withColumn("version", number), all(len(entries) == 1 for entries in live.values())

    def scan_table(self, table: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """A bar table with all its fields, all or in [since, until)."""
        rows, single = self.scan_versions(table, since, until)
        return rows.drop("version", "date", "month") if single else newest_values(rows)

    def scan_bars(self, interval: str, lookback: str | None = None, now: datetime | None = None,
                  since: datetime | None = None, align: str | None = None,
                  until: datetime | None = None) -> DataFrame:
        """Stored bars of an interval, all or since a moment floored to ``align``."""
        start = lookback_start(now, lookback, align) if lookback else since
        return self.scan_table(BAR_TABLES[interval], start, until).select(*BAR.names)

    # Writing ----------------------------------------------------------------------------------------

    def append_ticks(self, ticks: DataFrame, batch: str | None = None, clock: Column | None = None) -> None:
        """Add ticks as one batch: a folder per date, in files of even size, and a line in the batch log.

        A batch that is written again under its own name replaces itself; where it was joined with
        others meanwhile, it stays as it was. ``clock``: the processing time, by default now; ticks that
        have a ``Spark_Time`` keep it.
        """
        if "Spark_Time" not in ticks.columns:
            ticks = ticks.withColumn("Spark_Time", clock if clock is not None else F.current_timestamp())
        batch = batch or f"load-{uuid.uuid4().hex}"
        staged = self._stage(ticks.select(*RAW_TICK.names, F.lit(RAW).alias("_table")), [RAW], "Trade_Time")
        folders, (low, high) = self.folders(RAW), staged.ranges[RAW]

        def add(found: tuple[str, str]) -> str | None:
            part, source = found
            entry = Entry(f"batch={batch}.{unique()}", 0, *_clip(part, low, high))
            folders.move(source, f"{self.path(RAW)}/{part}/{entry.name}")

            def named(number: int, live: list[Entry]) -> list[Entry] | None:
                if any(in_ranges(batch, e.holds) for e in live):
                    return None
                return [e for e in live if e.holds is not None or e.batch != batch] + [entry]

            return f"{part}/{entry.name}" if folders.commit(part, named) else None

        added = [f for f in at_once(add, staged.parts(RAW)) if f]
        staged.done()
        if added:
            self.folders(BATCH_LOG).write_text(f"{batch}.json", json.dumps(
                {"batch": batch, "low": low, "high": high, "folders": added}))

    def batch_ticks(self, folders: Sequence[str]) -> DataFrame | None:
        """The ticks of folders that the batch log names; None if some are gone, joined with others."""
        table = self.folders(RAW)
        if not all(table.exists(f) for f in folders):
            return None
        return self._open(RAW, RAW_TICK.fields, folders).select(*FLAT_TICK.names)

    def write_bars(self, interval: str, bars: DataFrame) -> None:
        self.upsert(BAR_TABLES[interval], bars)

    def upsert_bars(self, interval: str, new: DataFrame) -> None:
        self.upsert(BAR_TABLES[interval], new)

    def upsert(self, table: str, new: DataFrame) -> None:
        """Add a version of the bars in ``new``, each of which it holds once; nothing else is rewritten."""
        self.upsert_all({table: new})

    def upsert_all(self, new: Mapping[str, DataFrame]) -> None:
        """Add a version to each table, in one job."""
        laid = None
        for table, rows in new.items():
            rows = rows.withColumn("_table", F.lit(table))
            laid = rows if laid is None else laid.unionByName(rows, allowMissingColumns=True)
        self.upsert_tables(laid, list(new))

    def upsert_tables(self, new: DataFrame, tables: Sequence[str], keep_tails: bool = False) -> None:
        """Add a version to each of ``tables`` from its rows (column ``_table``), in one job.

        Each partition's version is seen as a whole. Tails that begin after the oldest bar are dropped, unless
        the caller puts them right.
        """
        staged = self._stage(new, tables, "time")

        def add(found: tuple[str, str, str]) -> None:
            table, part, source = found
            folders, (low, high), at = self.folders(table), staged.ranges[table], [source]

            def named(number: int, live: list[Entry]) -> list[Entry]:
                name = f"version={number}-{unique()}"
                target = f"{folders.root}/{part}/{name}"
                folders.move(at[0], target)
                at[0] = target
                return [*live, Entry(name, 0, *_clip(part, low, high))]

            live = folders.commit(part, named)
            if joinable(live, FAN):
                self._join_versions(table, part)

        for table in tables if not keep_tails else ():
            if (low := staged.ranges[table][0]) is not None:
                self._drop_tail(table, low)
        at_once(add, [(t, *found) for t in tables for found in staged.parts(t)])
        staged.done()

    def _stage(self, rows: DataFrame, tables: Sequence[str], ts: str) -> Staged:
        """Write rows aside by table (column ``_table``) and partition, and note each table's time range."""
        parts, monthly = _utc_parts(ts), [t for t in tables if self.layout(t) == "month"]
        part = F.when(F.col("_table").isin(*monthly), parts["month"]).otherwise(parts["date"]) if monthly else parts["date"]
        seen, figures = Observation(), []
        for i, table in enumerate(tables):
            at = f"if(_table = '{table}', unix_micros({ts}), NULL)"
            figures += [F.expr(f"min({at})").alias(f"low{i}"), F.expr(f"max({at})").alias(f"high{i}")]
        path = f"{self.root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
        laid = rows.withColumn("_part", part.cast("string")).hint("rebalance", "_table", "_part")
        laid.observe(seen, *figures).write.partitionBy("_table", "_part").parquet(path)
        got = seen.get
        return Staged(self, path, {t: (got.get(f"low{i}"), got.get(f"high{i}")) for i, t in enumerate(tables)})

    # Joining ----------------------------------------------------------------------------------------

    def _join_versions(self, table: str, part: str, all_of_them: bool = False) -> bool:
        """Join the newest versions of one size class (or all), as long as there are enough."""
        folders, done = self.folders(table), False
        while True:
            live = folders.read(part)[1]
            chosen = (live if len(live) > 1 else []) if all_of_them else joinable(live, FAN)
            if not chosen:
                return done
            rows = self._open(table, VERSIONED, [f"{part}/{e.name}" for e in chosen])
            rows = rows.withColumn("version", F.substring_index("version", "-", 1).cast("long"))
            entry = Entry(f"version={chosen[-1].number}-{unique()}", max(e.tier for e in chosen) + 1, *bounds(chosen))
            newest_values(rows).hint("rebalance").write.parquet(f"{self.path(table)}/{part}/{entry.name}")
            done = self._replace(folders, part, chosen, entry) or done

    def _replace(self, folders: LiveFolders, part: str, chosen: list[Entry], entry: Entry) -> bool:
        """Put ``entry`` at the place of the newest of ``chosen``, if all of them still count."""
        names = {e.name for e in chosen}

        def named(number: int, live: list[Entry]) -> list[Entry] | None:
            if not names <= {e.name for e in live}:
                return None
            return [entry if e.name == chosen[-1].name else e for e in live
                    if e.name not in names or e.name == chosen[-1].name]

        if folders.commit(part, named) is not None:
            return True
        folders.delete(f"{folders.root}/{part}/{entry.name}")
        return False

    def compact(self, table: str, before: date) -> list[str]:
        """Join the versions of every period that ended before ``before``; returns the periods."""
        edge = f"{self.layout(table)}={before}"
        return [p for p in self.folders(table).partitions()
                if p < edge and self._join_versions(table, p, all_of_them=True)]

    def compact_ticks(self, before: date) -> list[str]:
        """Join the batches of every day before ``before``, sorted by symbol; returns the days.

        The day's list changes at once from the batches to the joined folder, so readers never miss it;
        the batch log does not change, so streams that follow it see nothing new.
        """
        folders, done = self.folders(RAW), []
        for part, live in folders.live().items():
            if not part.startswith("date=") or part >= f"date={before}" or len(live) < 2:
                continue
            rows = self._open(RAW, RAW_TICK.fields, [f"{part}/{e.name}" for e in live]).select(*RAW_TICK.names)
            entry = Entry(f"batch=joined.{unique()}", 1, *bounds(live), holds=batch_ranges(live))
            (rows.repartitionByRange("Symbol", "Trade_Time", "Seq").sortWithinPartitions("Symbol", "Trade_Time")
             .write.option("parquet.bloom.filter.enabled#Symbol", "true")
             .parquet(f"{self.path(RAW)}/{part}/{entry.name}"))
            if self._replace(folders, part, live, entry):
                done.append(part)
        return done

    # Tails ------------------------------------------------------------------------------------------

    def tail(self, table: str) -> tuple[int, DataFrame] | None:
        """The last closes of each symbol before a moment (epoch microseconds), and that moment."""
        live = self.folders(f"{TAILS}/{table}").read("all=")[1]
        if not live:
            return None
        path = f"{self.path(TAILS)}/{table}/all=/{live[-1].name}"
        return live[-1].low, self.spark.read.schema(TAIL_DDL).parquet(path)

    def write_tails(self, tails: Mapping[str, tuple[int, DataFrame]]) -> None:
        """Replace the tails of tables in one job: each a moment and the closes before it."""
        laid = None
        for table, (_, rows) in tails.items():
            rows = rows.select("Symbol", "time", "Close").withColumn("_table", F.lit(table))
            laid = rows if laid is None else laid.unionByName(rows)
        path = f"{self.root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
        laid.hint("rebalance", "_table").write.partitionBy("_table").parquet(path)
        for table, (moment, _) in tails.items():
            folders, name = self.folders(f"{TAILS}/{table}"), f"version=0-{unique()}"
            source, target = f"{path}/_table={table}", f"{folders.root}/all=/{name}"
            if folders.fs.exists(folders._path(source)):
                folders.move(source, target)
            else:  # no symbol has an earlier bar
                folders.fs.mkdirs(folders._path(target))
            folders.commit("all=", lambda number, live: [Entry(name, 0, moment, moment)])
        self.folders(TAILS).delete(path)

    def _drop_tail(self, table: str, low: int) -> None:
        folders = self.folders(f"{TAILS}/{table}")
        if any(e.low > low for e in folders.read("all=")[1]):
            folders.commit("all=", lambda number, live: [])

    def write_cascade(self, ticks: DataFrame, intervals: Sequence[str] = CASCADE) -> None:
        """Build every level; ticks are scanned once and the finest bars, once written, shuffled once."""
        self.write_bars(intervals[0], tick_bars(ticks, intervals[0]))
        levels = rollup_cascade(self.scan_bars(intervals[0]), intervals)
        self.upsert_all({BAR_TABLES[i]: levels[i] for i in intervals[1:]})


@dataclass(frozen=True)
class Staged:
    """Rows written aside, by table and partition."""

    store: TickStore
    path: str
    ranges: dict[str, tuple]

    def parts(self, table: str) -> list[tuple[str, str]]:
        """Name of each of a table's partitions, and where its rows wait."""
        folders, layout = self.store.folders(table), self.store.layout(table)
        below = f"{self.path}/_table={table}"
        return [(n.replace("_part=", f"{layout}=", 1), f"{below}/{n}") for n in folders.below(below)]

    def done(self) -> None:
        self.store.folders(RAW).delete(self.path)


def _clip(part: str, low: int | None, high: int | None) -> tuple[int | None, int | None]:
    """The time range inside a partition; unknown for rows without a time."""
    kind, _, day = part.partition("=")
    if low is None or day.startswith("__"):
        return None, None
    begin = date.fromisoformat(day)
    end = begin + timedelta(days=1) if kind == "date" else (begin.replace(day=28) + timedelta(days=4)).replace(day=1)
    first, last = (micros(datetime(d.year, d.month, d.day)) for d in (begin, end))
    return max(low, first), min(high, last - 1)


def _ddl(fields: Iterable) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _between(df: DataFrame, ts: str, start: datetime | None, stop: datetime | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(ts) >= moment_literal(utc(start)))
    return df if stop is None else df.filter(F.col(ts) < moment_literal(utc(stop)))


def newest_values(versions: DataFrame) -> DataFrame:
    """Per (Symbol, time) and field the value of the highest ``version`` that is not null."""
    fields = [c for c in versions.columns if c not in ("Symbol", "time", "version", "date", "month")]
    newest = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("version"))).alias(f) for f in fields]
    return versions.groupBy("Symbol", "time").agg(*newest)


def last_closes(bars: DataFrame, depth: int) -> DataFrame:
    """The last ``depth`` (Symbol, time, Close) of each symbol, ranked per task before the shuffle."""
    newest = Window.partitionBy("Symbol").orderBy(F.desc("time"))
    ranked = bars.select("Symbol", "time", "Close").withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= depth).drop("_rank")


def merge_bars(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Union by (Symbol, time); per field the new value wins, a null new value keeps the old.

    One shuffle over both sides: the two versions of a bar meet in a hash aggregate.
    """
    return newest_values(existing.withColumn("version", F.lit(0)).unionByName(
        new.withColumn("version", F.lit(1)), allowMissingColumns=True))
