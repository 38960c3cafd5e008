"""Silence, gaps, running numbers and late ticks over several micro-batches with restarts."""

from pyspark.sql import functions as F

from tests.conftest import at, rows, seconds_of, ticks
from tickloom.operators import bars, quality
from tickloom.schema import BAR_FIELDS
from tickloom.sources.store import TickStore
from tickloom.streaming import health, progress, queries


def replayed(spark, path, batches, start, checkpoint, restarts=(1,)):
    """Write the batches one file each and stream them; the query ends and starts again after ``restarts``."""
    for number, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(path)
        if number in restarts or number + 1 == len(batches):
            stream = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)
            start(stream, checkpoint).awaitTermination()
    return stream


def test_silence_per_feed_and_in_all(spark, tmp_path):
    seen = [("A", t) for t in (0, 30, 100, 130, 400)] + [("B", t) for t in (10, 50, 210, 215, 390)]
    steps = [(0, 120), (120, 220), (220, 500)]
    batches = [ticks(spark, [(s, 1.0, 1.0, float(t), t) for s, t in seen if a <= t < b]) for a, b in steps]
    batches.append(ticks(spark, [("HEART", None, None, 9e4, 0)]))
    for feed in ((), ("Symbol",)):
        root = str(tmp_path / f"stale{len(feed)}")
        start = lambda stream, cp: health.start_stale(
            stream, root, cp, feed=feed, delay="20 seconds", trigger="available now")
        replayed(spark, f"{root}-in", batches, start, f"{root}-cp")
        found = health.Carried(spark, root).out(health.stale_shape(batches[0], feed))
        direct = quality.stale_intervals(ticks(spark, [(s, 1.0, 1.0, float(t), t) for s, t in seen]), feed=feed)
        assert rows(found, *found.columns) == rows(direct, *direct.columns) != []


def test_a_repeated_batch_reads_the_same_state(spark, tmp_path):
    carried = health.Carried(spark, str(tmp_path))
    shape = spark.createDataFrame([], "n bigint").schema
    for batch in (0, 1, 1, 2):
        before = carried.before(batch, shape)
        carried.put(batch, before)
        carried.leave(batch, spark.createDataFrame([(batch,)], shape))
    assert rows(carried.out(shape), "n") == [(0,), (1,)]


def test_gaps_between_batches(spark, tmp_path):
    seqs = [[1, 2, 4], [5, 9], [9, 1, 2], [7]]
    told = "feed string, Timestamp_Web string, Seq bigint"
    numbered = iter(range(100))
    batches = [spark.createDataFrame([("f", f"2024-03-04T18:00:{next(numbered):02d}", s) for s in own], told) for own in seqs]
    root = str(tmp_path / "gaps")
    start = lambda stream, cp: health.start_seq_gaps(stream, root, cp, ["feed"], trigger="available now")
    replayed(spark, f"{root}-in", batches, start, f"{root}-cp")
    found = health.Carried(spark, root).out(health.gap_shape(batches[0], ["feed"]))
    assert rows(found, "after_seq", "next_seq") == [("f", 2, 4, 1), ("f", 2, 7, 4), ("f", 5, 9, 3)]


def test_late_ticks_are_put_aside_and_their_bars_repaired(spark, tmp_path):
    hours = [0, 1, 2, 30, 31, 3, 32, 4, 60, 5]
    every = [("A", float(i), 1.0, h * 3600.0 + 5, i) for i, h in enumerate(hours)]
    store = TickStore(spark, str(tmp_path / "store"))
    flat = lambda df: df.selectExpr(
        "Symbol", "Price", "Volume", "Trade_Time", "Seq", "array('x') AS Trade_type", "'' AS Hash_Web", "'' AS Timestamp_Web",
        "1L AS Offset", "1 AS Partition", "'' AS Hash_Spark")
    batches = [flat(ticks(spark, [r])) for r in every]
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    now = {"trigger": "available now"}
    start = lambda stream, at_: queries.start_raw(stream, store, at_, "available now")
    stream = replayed(spark, path, batches, start, f"{cp}-raw", ())
    queries.start_stream_bars(stream, store, "1 hour", f"{cp}-bars", **now).awaitTermination()
    health.start_late_ticks(stream, store.path("late"), f"{cp}-late", "1 hour", **now).awaitTermination()
    late = health.Carried(spark, store.path("late")).out(stream.schema)
    assert sorted(r.Seq for r in late.collect()) == [5, 7, 9]
    columns = ["Symbol", "time", *BAR_FIELDS]
    direct = rows(bars.tick_bars(ticks(spark, every), "1 hour").select(columns), "time")
    before = rows(store.scan_bars("1 hour").select(columns), "time")
    assert set(before) <= set(direct) and len(before) + late.count() >= len(direct) > len(before)
    low, high = health.repair_late(store, "1 hour", late)
    assert (seconds_of(low.replace(tzinfo=None)), high) == (3 * 3600.0 + 5, at(5 * 3600 + 5))
    assert rows(store.scan_bars("1 hour").select(columns), "time") == direct


def test_one_read_feeds_both_tables_and_a_failure_between_them_leaves_both_equal(spark, tmp_path, monkeypatch):
    store = TickStore(spark, str(tmp_path / "store"))
    flat = lambda df: df.selectExpr(
        "Symbol", "Price", "Volume", "Trade_Time", "Seq", "array('x') AS Trade_type", "'a' AS Hash_Web", "'' AS Timestamp_Web",
        "1L AS Offset", "1 AS Partition", "if(Seq = 3, 'b', 'a') AS Hash_Spark")
    batches = [flat(ticks(spark, [("A", 1.0, 1.0, 1.0, 1), ("B", 2.0, 1.0, 2.0, 2)])),
               flat(ticks(spark, [("A", None, 1.0, 61.0, 3), ("A", 4.0, 1.0, 62.0, 4)]))]
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)
    plain, broken = TickStore.upsert_all, []

    def once_lost(self, new):
        if store.scan_ticks().count() > 2 and not broken:
            broken.append(1)
            raise OSError("lost")
        return plain(self, new)

    monkeypatch.setattr(TickStore, "upsert_all", once_lost)
    start = lambda: queries.start_raw_and_bars(stream(), store, cp, trigger="available now", clock=F.col("Trade_Time"))
    try:
        start().awaitTermination()
    except Exception as error:
        assert "lost" in str(error)
    run = start()
    run.awaitTermination()
    assert broken and rows(store.scan_ticks().select("Seq"), "Seq") == [(1,), (2,), (3,), (4,)]
    assert rows(store.scan_table("5sec").select("Symbol", "Close"), "Symbol", "Close") == [("A", 1.0), ("A", 4.0), ("B", 2.0)]
    told = progress.observed(progress.recent_progress(spark, run)).collect()
    assert [(r.ticks, r.no_price, r.foreign) for r in told] == [(2, 1, 1)]
