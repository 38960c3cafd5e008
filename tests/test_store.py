from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, at, rows, ticks
from tickloom.operators import bars, filters, ordered
from tickloom.plans import refresh, views
from tickloom.schema import BAR_FIELDS, FLAT_TICK
from tickloom.sources import lines
from tickloom.sources import store as store_module
from tickloom.sources.live import Entry, LiveFolders, bounds, joinable
from tickloom.sources.store import TickStore, merge_bars


def flat(spark, rows_):
    base = ticks(spark, rows_)
    return base.select(*[
        F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FLAT_TICK])


def test_merge_lets_new_values_win_and_keeps_what_is_absent(spark):
    old = spark.createDataFrame([("A", at(0), 1.0, 5.0), ("A", at(5), 2.0, 6.0)], "Symbol string, time timestamp, Close double, MA_5 double")
    new = spark.createDataFrame([("A", at(5), 3.0, None), ("A", at(10), 4.0, 7.0)], old.schema)
    merged = merge_bars(old, new)
    values = [r[2:] for r in rows(merged, "Symbol", "time")]
    assert values == [(1.0, 5.0), (3.0, 6.0), (4.0, 7.0)]
    assert rows(merge_bars(merged, new), "Symbol", "time") == rows(merged, "Symbol", "time")


def test_upsert_writes_its_own_rows_only(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    day = 86400.0
    first = bars.tick_bars(ticks(spark, [("A", 1.0, 1.0, 0.0, 1), ("A", 2.0, 1.0, day, 2)]), "5 seconds")
    assert store.scan_bars("5 seconds").count() == 0
    store.write_bars("5 seconds", first)
    old_files = set((tmp_path / "5sec-monitor").rglob("*.parquet"))
    late = bars.tick_bars(ticks(spark, [("A", 7.0, 1.0, day, 2), ("A", 3.0, 1.0, day + 5, 3)]), "5 seconds")
    for _ in range(2):
        store.upsert_bars("5 seconds", late)
        assert [r.Close for r in store.scan_bars("5 seconds").orderBy("time").collect()] == [1.0, 7.0, 3.0]
    now = set((tmp_path / "5sec-monitor").rglob("*.parquet"))
    assert old_files < now and not any("2024-03-04" in str(f) for f in now - old_files)
    assert sum(spark.read.parquet(str(f)).count() for f in now - old_files) == 4


def test_half_a_write_never_leaves_fewer_bars(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    old = bars.tick_bars(ticks(spark, [("A", float(i), 1.0, 5.0 * i, i) for i in range(40)]), "5 seconds")
    store.write_bars("5 seconds", old)
    fresh = bars.tick_bars(ticks(spark, [("A", 100.0 + i, 1.0, 5.0 * i, i) for i in range(40)]), "5 seconds")
    broken = fresh.repartition(8).withColumn("Close", F.when(F.col("time") < F.lit(at(150)), F.col("Close")).otherwise(
        F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        store.upsert_bars("5 seconds", broken)
    assert [r.Close for r in store.scan_bars("5 seconds").orderBy("time").collect()] == [float(i) for i in range(40)]
    store.upsert_bars("5 seconds", fresh)
    files = sorted((tmp_path / "5sec-monitor").rglob("*.parquet"))
    assert files
    version = max(p.name for p in (tmp_path / "5sec-monitor" / "date=2024-03-04").iterdir())
    for file in list((tmp_path / "5sec-monitor" / "date=2024-03-04" / version).glob("*.parquet"))[:1]:
        file.unlink()  # as if the commit had stopped before it
    assert store.scan_bars("5 seconds").count() == 40


def test_compaction_keeps_the_newest_values(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    day = 86400.0
    for price in (1.0, 2.0, 3.0):
        store.write_bars("5 seconds", bars.tick_bars(
            ticks(spark, [("A", price, 1.0, 0.0, 1), ("B", price, 1.0, 5.0 * price, 1), ("A", price, 1.0, day, 2)]), "5 seconds"))
    before = rows(store.scan_bars("5 seconds"), "Symbol", "time")
    assert store.compact("5sec-monitor", date(2024, 3, 5)) == ["date=2024-03-04"]
    assert {p: len(es) for p, es in store.live("5sec-monitor").items()} == {"date=2024-03-04": 1, "date=2024-03-05": 3}
    assert rows(store.scan_bars("5 seconds"), "Symbol", "time") == before
    assert store.compact("5sec-monitor", date(2024, 3, 5)) == []


def test_tick_batches_add_up_replace_themselves_and_join(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    part = lambda n: flat(spark, [("A", float(i), 1.0, i * 7000.0, i) for i in range(n, n + 20)])
    store.append_ticks(part(0), "one", F.lit("2024-05-01").cast("timestamp"))
    store.append_ticks(part(0), "one", F.lit("2024-05-01").cast("timestamp"))
    store.append_ticks(part(20))
    seqs = list(range(40))
    assert [r.Seq for r in store.scan_ticks().orderBy("Seq").collect()] == seqs
    assert store.scan_raw().filter("Spark_Time < '2024-06-01'").count() == 20
    assert store.compact_ticks(date(2024, 3, 6)) == ["date=2024-03-05"]
    assert {len(entries) for p, entries in store.live("raw").items() if p < "date=2024-03-06"} == {1}
    assert [r.Seq for r in store.scan_ticks().orderBy("Seq").collect()] == seqs
    store.append_ticks(part(0), "one")  # a retry after its days were joined
    assert [r.Seq for r in store.scan_ticks().orderBy("Seq").collect()] == seqs


def test_append_makes_few_files(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    store.append_ticks(flat(spark, [("A", 1.0, 1.0, i * 3600.0, i) for i in range(240)]).repartition(16))
    assert len(list((tmp_path / "raw").rglob("*.parquet"))) <= 2 * 10


def test_scans_list_only_the_folders_in_range(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    source = flat(spark, [("A", float(i), 1.0, i * 3600.0, i) for i in range(60)])
    store.append_ticks(source)
    store.write_bars("1 minute", bars.tick_bars(source, "1 minute"))
    now = filters.latest_moment(source)
    recent = store.scan_ticks(lookback="5 hours", now=now)
    assert recent.count() == 6 and store.scan_ticks().count() == 60
    assert all("date=2024-03-06" in f for f in recent.inputFiles())
    kept = store.scan_bars("1 minute", lookback="330 minutes", now=now, align="1 hour")
    assert kept.count() == 7
    assert all("date=2024-03-06" in f for f in kept.inputFiles())
    assert "GreaterThanOrEqual(time" in kept._jdf.queryExecution().executedPlan().toString()
    assert len(store.live("raw")) == 3 and list(store.live("raw", since=at(50 * 3600))) == ["date=2024-03-06"]
    store.append_ticks(flat(spark, [("B", 1.0, 1.0, 59 * 3600.0 + i, i) for i in range(3)]))
    assert [len(es) for es in store.live("raw", since=at(59 * 3600 + 1)).values()] == [1]


def test_raw_points_have_times_of_their_own(spark):
    source = flat(spark, [("A", float(i), 1.0, 1.0, i % 7) for i in range(50)]).withColumn("Partition", F.lit(1))
    points = lines.raw_points(source, F.col("Trade_Time"))
    assert points.select("point_ns").distinct().count() == 50
    texts = [r[0] for r in lines.to_line_protocol(points, "raw", lines.RAW_TAGS, lines.RAW_FIELDS, ns="point_ns").collect()]
    assert all('Trade_Time="2024-03-04 18:00:01.000",Spark_Time="' in t for t in texts)


def test_cascade_tables_equal_direct_bars(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    source = views.plain_ticks(views.read_events(spark, SF_DIR))
    store.write_cascade(source)
    for interval in bars.CASCADE:
        stored = store.scan_bars(interval).select("Symbol", "time", *BAR_FIELDS)
        assert rows(stored, "Symbol", "time") == rows(bars.tick_bars(source, interval), "Symbol", "time")


def test_refresh_from_a_moment_inside_a_bucket_keeps_the_oldest_bar(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    source = flat(spark, [("A", float(i), 1.0, i * 7.0, i) for i in range(400)])
    store.append_ticks(source)
    refresh.refresh_since(store, at(0))
    before = {i: rows(store.scan_bars(i), "Symbol", "time") for i in bars.CASCADE}
    refresh.refresh_bars(store, at(2793.5))
    refresh.refresh_since(store, at(1234.5))
    for interval in bars.CASCADE:
        assert rows(store.scan_bars(interval), "Symbol", "time") == before[interval]
        direct = ordered.moving_averages(bars.tick_bars(source, interval))
        assert before[interval] == rows(direct, "Symbol", "time")


def test_late_tick_corrects_bars_and_following_averages(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    early = [("A", float(i), 1.0, i * 5.0, i) for i in range(100)]
    store.append_ticks(flat(spark, early))
    refresh.refresh_since(store, at(0))
    late = [("A", 1000.0, 1.0, 302.5, 1000)]
    store.append_ticks(flat(spark, late))
    refresh.refresh_since(store, at(302.5))
    direct = ordered.moving_averages(bars.tick_bars(ticks(spark, early + late), "5 seconds"))
    assert rows(store.scan_bars("5 seconds"), "Symbol", "time") == rows(direct, "Symbol", "time")


def averaged(source, interval):
    return rows(ordered.moving_averages(bars.tick_bars(source, interval)), "Symbol", "time")


def test_joining_versions_keeps_an_open_day_small():
    """2,000 writes of a day, joined as the store joins them."""
    live, written = [], 0
    for number in range(1, 2001):
        live.append(Entry(f"version={number}-x", 0, number, number))
        while chosen := joinable(live):
            written += len(chosen) ** (chosen[0].tier + 1)
            low, high = bounds(chosen)
            live = live[:-len(chosen)] + [Entry(f"version={chosen[-1].number}-y", chosen[0].tier + 1, low, high)]
        assert len(live) <= 7 * 4
        assert [e.number for e in live] == sorted(e.number for e in live)
    assert written <= 4 * 2000 and live[0].low == 1 and live[-1].high == 2000


def test_versions_are_joined_while_they_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "FAN", 3)
    monkeypatch.setattr(store_module, "joinable", lambda live, fan: joinable(live, 3))
    store = TickStore(spark, str(tmp_path))
    for step in range(10):
        store.write_bars("5 seconds", bars.tick_bars(
            ticks(spark, [("A", float(step), 1.0, 0.0, 1), ("B", 1.0, 1.0, 5.0 * step, 1)]), "5 seconds"))
        assert len(store.live("5sec-monitor")["date=2024-03-04"]) <= 4
    found = {(r.Symbol, r.time): r.Close for r in store.scan_bars("5 seconds").collect()}
    assert len(found) == 11 and found["A", at(0).replace(tzinfo=None)] == 9.0


def test_a_join_loses_no_update(spark, tmp_path, monkeypatch):
    """A version that is written before a join and committed after it is newer than the joined one."""
    store = TickStore(spark, str(tmp_path))
    bar = lambda price: bars.tick_bars(ticks(spark, [("A", price, 1.0, 0.0, 1)]), "5 seconds")
    store.write_bars("5 seconds", bar(1.0))
    store.write_bars("5 seconds", bar(2.0))
    plain = TickStore._stage

    def staged_then_joined(self, *given):
        done = plain(self, *given)
        TickStore(spark, str(tmp_path)).compact("5sec-monitor", date(2024, 3, 5))
        return done

    monkeypatch.setattr(TickStore, "_stage", staged_then_joined)
    store.write_bars("5 seconds", bar(9.0))
    monkeypatch.undo()
    assert [r.Close for r in store.scan_bars("5 seconds").collect()] == [9.0]
    assert len(store.live("5sec-monitor")["date=2024-03-04"]) == 2
    store.compact("5sec-monitor", date(2024, 3, 5))
    assert [r.Close for r in store.scan_bars("5 seconds").collect()] == [9.0]


def test_two_writers_at_a_time_both_count(spark, tmp_path, monkeypatch):
    """The list that loses the race for a number is made again on top of the other."""
    store = TickStore(spark, str(tmp_path))
    plain, other = LiveFolders._create, []

    def after_another(self, part, number, text):
        if not other:
            other.append(number)
            store.write_bars("5 seconds", bars.tick_bars(ticks(spark, [("B", 1.0, 1.0, 0.0, 1)]), "5 seconds"))
        return plain(self, part, number, text)

    monkeypatch.setattr(LiveFolders, "_create", after_another)
    store.write_bars("5 seconds", bars.tick_bars(ticks(spark, [("A", 1.0, 1.0, 0.0, 1)]), "5 seconds"))
    assert {r.Symbol for r in store.scan_bars("5 seconds").collect()} == {"A", "B"}


def test_readers_that_began_before_a_join_finish(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    for n in (0, 20):
        store.append_ticks(flat(spark, [("A", float(i), 1.0, float(i), i) for i in range(n, n + 20)]))
        store.write_bars("5 seconds", bars.tick_bars(ticks(spark, [("A", 1.0, 1.0, float(n), 1)]), "5 seconds"))
    early = store.scan_ticks(), store.scan_bars("5 seconds")
    store.compact_ticks(date(2024, 3, 5)), store.compact("5sec-monitor", date(2024, 3, 5))
    assert [df.count() for df in early] == [40, 2]
    assert [store.scan_ticks().count(), store.scan_bars("5 seconds").count()] == [40, 2]
    soon = TickStore(spark, str(tmp_path), retain=timedelta(0))
    soon.append_ticks(flat(spark, [("A", 1.0, 1.0, 1.0, 99)]))
    soon.append_ticks(flat(spark, [("A", 1.0, 1.0, 1.0, 99)]))
    assert soon.scan_ticks().count() == 42  # the replaced folders are gone, their rows are not


def test_a_list_that_was_not_written_to_its_end_does_not_count(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    store.append_ticks(flat(spark, [("A", 1.0, 1.0, 1.0, 1)]))
    (tmp_path / "raw" / "date=2024-03-04" / "_live" / "2").write_text('{"live": [')
    assert store.scan_ticks().count() == 1
    store.append_ticks(flat(spark, [("A", 1.0, 1.0, 1.0, 2)]))
    assert store.scan_ticks().count() == 2


def test_symbols_are_found_in_few_row_groups(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    for n in range(2):
        store.append_ticks(flat(spark, [(f"S{i % 50}", 1.0, 1.0, float(i), i) for i in range(n, 20_000, 2)]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files for so few rows
    store.compact_ticks(date(2024, 3, 5))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [p for p in (tmp_path / "raw" / "date=2024-03-04").rglob("*.parquet") if "joined" in str(p)]
    ranges = [pq.ParquetFile(f).metadata.row_group(g).column(2).statistics for f in files
              for g in range(pq.ParquetFile(f).num_row_groups)]
    holding = [r for r in ranges if r.min <= "S17" <= r.max]
    assert len(ranges) >= 4 and len(holding) <= 2
    assert store.scan_ticks(symbols=["S17"]).count() == 400
    assert "In(Symbol" in (plan := store.scan_ticks(symbols=["S17", "S3"])._jdf.queryExecution().toString()) or "IN (S17" in plan


def test_averages_come_from_the_tail_for_a_thin_symbol(spark, tmp_path):
    store = TickStore(spark, str(tmp_path))
    thin = [("THIN", float(i), 1.0, i * 40000.0, i) for i in range(8)]
    busy = [("BUSY", float(i), 1.0, 280000.0 + i * 5.0, 100 + i) for i in range(90)]
    store.append_ticks(flat(spark, thin + busy))
    columns = ["Symbol", "time", *BAR_FIELDS, "MA_5"]
    for since in (0, 280000, 100000):
        refresh.refresh_since(store, at(since), windows=(5,))
        direct = ordered.moving_averages(bars.tick_bars(ticks(spark, thin + busy), "5 seconds"), [5])
        assert rows(store.scan_bars("5 seconds").select(columns), "Symbol", "time") == rows(direct, "Symbol", "time")


def follow(spark, store, batches):
    """Append each batch and refresh what it touches; all ticks so far after each."""
    seen = []
    for batch in batches:
        seen += batch
        moments = [r[3] for r in batch]
        store.append_ticks(flat(spark, batch))
        refresh.refresh_touched(store, flat(spark, batch), at(min(moments)), at(max(moments)))
        yield seen


def test_touched_keys_keep_all_levels_right(spark, tmp_path):
    """Live batches, a late tick inside the lookback, one before all tails, a new and a silent symbol."""
    store = TickStore(spark, str(tmp_path))
    live = lambda a, b, s="A": [(s, float(i % 17), 1.0, i * 5.0 + 1, i) for i in range(a, b)]
    batches = [live(0, 200) + live(0, 3, "SILENT"), live(200, 210), live(210, 900) + live(250, 260, "NEW"),
               [("A", 99.0, 2.0, 880 * 5.0 + 2, 5000)], [("A", 77.0, 2.0, 52.5, 5001), ("SILENT", 7.0, 1.0, 4499.0, 5002)],
               live(900, 905)]
    for seen in follow(spark, store, batches):
        for interval in bars.CASCADE:
            stored = rows(store.scan_bars(interval), "Symbol", "time")
            assert stored == averaged(ticks(spark, seen), interval), interval


def test_a_new_symbol_widens_no_scan_and_others_are_not_rewritten(spark, tmp_path, monkeypatch):
    store = TickStore(spark, str(tmp_path))
    history = [("A", float(i), 1.0, i * 3600.0 * 8, i) for i in range(30)]
    now = 29 * 3600.0 * 8
    list(follow(spark, store, [history, [("A", 5.0, 1.0, now + 5, 50)]]))
    opened = []
    plain = TickStore._open
    monkeypatch.setattr(TickStore, "_open", lambda self, table, shape, paths: (
        opened.extend((table, p.split("/")[0]) for p in paths), plain(self, table, shape, paths))[1])
    list(follow(spark, store, [[("FRESH", 1.0, 1.0, now + 11, 51)]]))
    today = {"date=2024-03-13", "date=2024-03-14"}
    assert {p for t, p in opened if t in ("raw", "5sec-monitor", "1m-monitor", "5m-monitor")} <= today
    monkeypatch.undo()
    newest = [max(es, key=lambda e: e.number) for t in ("5sec-monitor", "1h-monitor") for es in [
        store.live(t)[max(store.live(t))]]]
    for table, entry in zip(("5sec-monitor", "1h-monitor"), newest):
        part = max(store.live(table))
        written = spark.read.parquet(f"{store.path(table)}/{part}/{entry.name}")
        assert {r.Symbol for r in written.collect()} == {"FRESH"}


def test_line_protocol_escapes_and_leaves_out_missing_fields(spark):
    source = spark.createDataFrame(
        [("A B,=", 'say "hi"\\', 1.5, None, 3, at(0)), ("C", None, float("nan"), None, None, at(0)),
         (None, "x", 2e10, 1.0, 4, at(1))],
        "Symbol string, note string, Open double, MA_5 double, Seq bigint, time timestamp")
    found = [r[0] for r in lines.to_line_protocol(source, "1h-monitor", ["Symbol"], ["note", "Open", "MA_5", "Seq"]).collect()]
    assert found == [
        '1h-monitor,Symbol=A\\ B\\,\\= note="say \\"hi\\"\\\\",Open=1.5,Seq=3 1709542800000000000',
        '1h-monitor note="x",Open=2.0E10,MA_5=1.0,Seq=4 1709542801000000000']


def test_lines_are_written_as_text(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines.write_lines(spark.createDataFrame([("a b=1 1",)], "line string"), path)
    assert rows(spark.read.text(path)) == [("a b=1 1",)]
