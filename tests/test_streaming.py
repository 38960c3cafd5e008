import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, at, rows
from tickloom.functions.times import moment_literal
from tickloom.operators import bars, filters, messages, ordered, quality
from tickloom.plans import views
from tickloom.schema import BAR_FIELDS, FLAT_TICK
from tickloom.sources import topics
from tickloom.sources.store import MICROBATCH, TickStore
from tickloom.streaming import progress, queries

MESSAGES_PER_FILE = 5


@pytest.fixture(scope="module")
def flat(spark):
    return views.flat_ticks(views.read_events(spark, SF_DIR)).filter("Trade_Time < '2024-01-04'").persist()


@pytest.fixture
def feed(spark, flat, tmp_path):
    """A message folder and functions to add slices of the feed to it and to open it as a stream."""
    path = str(tmp_path / "topic")

    def add(part):
        slice_of = F.least(F.floor(F.col("Offset") / MESSAGES_PER_FILE), F.lit(2)) + 1
        packed = messages.build_envelopes(flat.filter(slice_of == part)).drop("part")
        packed.coalesce(1).write.mode("append").parquet(path)

    def open_stream():
        source = topics.FileSource(path, options={"maxFilesPerTrigger": "1"})
        return messages.flatten_ticks(topics.read_ticks_stream(spark, source))

    add(1), add(2)
    return add, open_stream


def millis(df):
    return df.withColumn("Trade_Time", F.timestamp_millis(F.unix_millis("Trade_Time")))


def same(left, right, columns):
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_raw_appends_each_tick_once_over_restarts(spark, flat, feed, tmp_path):
    add, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    for part in (None, 3, None):
        if part:
            add(part)
        queries.start_raw(open_stream(), store, str(tmp_path / "cp"), "available now").awaitTermination()
    columns = [c for c in FLAT_TICK.names if c != "Timestamp_Web"]
    assert same(store.scan_ticks(), millis(flat), columns)


def test_streamed_bars_equal_batch_bars(spark, flat, feed, tmp_path):
    add, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    for part in (None, 3):
        if part:
            add(part)
        queries.start_stream_bars(open_stream(), store, "1 hour", str(tmp_path / "cp"), delay="10 days",
                                  trigger="available now").awaitTermination()
    direct = bars.tick_bars(millis(flat), "1 hour")
    assert same(store.scan_bars("1 hour"), direct, ["Symbol", "time", *BAR_FIELDS])


def test_refresh_follows_the_raw_table(spark, flat, feed, tmp_path):
    add, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    for part in (None, 3):
        if part:
            add(part)
        queries.start_raw(open_stream(), store, str(tmp_path / "raw"), "available now").awaitTermination()
        queries.start_refresh(store, str(tmp_path / "refresh"), "available now").awaitTermination()
    for interval in ("5 seconds", "1 hour"):
        direct = ordered.moving_averages(bars.tick_bars(millis(flat), interval))
        assert same(store.scan_bars(interval), direct, direct.columns)


def test_every_level_of_the_cascade_emits_its_closed_bars(spark, flat, feed, tmp_path):
    add, open_stream = feed
    add(3)
    out = str(tmp_path / "out")
    queries.start_cascade(open_stream(), out, str(tmp_path / "cp"), delay="12 hours", trigger="available now")
    for interval in bars.CASCADE:
        found = queries.read_level(spark, out, interval)
        direct = bars.tick_bars(millis(flat), interval)
        assert found.count() > 0
        assert found.select("Symbol", "time", *BAR_FIELDS).exceptAll(
            direct.select("Symbol", "time", *BAR_FIELDS)).count() == 0
    last = queries.read_level(spark, out, "1 hour").agg(F.max("time")).first()[0]
    closed = bars.tick_bars(millis(flat), "1 hour").filter(F.col("time") <= F.lit(last))
    assert same(queries.read_level(spark, out, "1 hour"), closed, ["Symbol", "time", *BAR_FIELDS])


def test_late_ticks_are_counted_and_a_refresh_puts_them_right(spark, flat, tmp_path):
    store = TickStore(spark, str(tmp_path / "store"))
    path = str(tmp_path / "ticks")
    days = [f"Trade_Time >= '2024-01-0{d}' AND Trade_Time < '2024-01-0{d + 1}'" for d in (3, 2, 1)]
    for newest_first in days:
        flat.drop("Position").filter(newest_first).coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema(flat.drop("Position").schema).option(
        "maxFilesPerTrigger", 1).parquet(path)
    query = queries.start_stream_bars(stream(), store, "1 hour", str(tmp_path / "cp"), trigger="available now")
    query.awaitTermination()
    log = progress.late_rows(progress.recent_progress(spark, query)).collect()
    assert [r.name for r in log] == ["bars"] and log[0].late_rows > 0
    direct = bars.tick_bars(flat, "1 hour")
    columns = ["Symbol", "time", *BAR_FIELDS]
    assert not same(store.scan_bars("1 hour"), direct, columns)
    queries.start_raw(stream(), store, str(tmp_path / "raw"), "available now").awaitTermination()
    queries.start_refresh(store, str(tmp_path / "refresh"), "available now").awaitTermination()
    assert same(store.scan_bars("1 hour"), direct, columns)


def test_batch_loads_and_streams_see_each_other(spark, flat, feed, tmp_path):
    _, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    store.append_ticks(flat.limit(7))
    for checkpoint in ("cp", "cp", "other"):
        queries.start_raw(open_stream(), store, str(tmp_path / checkpoint), "available now").awaitTermination()
    streamed = open_stream().isStreaming and store.scan_raw().count() - 7
    store.append_ticks(flat.limit(5))
    assert streamed > 0 and streamed % 2 == 0  # two streams, each once
    assert store.scan_ticks().count() == streamed + 12


def test_a_period_triggers_batch_after_batch(spark, feed, tmp_path):
    add, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    query = queries.start_raw(open_stream(), store, str(tmp_path / "cp"), "1 second")
    try:
        deadline = time.time() + 60
        while (query.lastProgress is None or query.lastProgress.batchId < 2) and time.time() < deadline:
            if query.lastProgress is not None and query.lastProgress.batchId == 1:
                add(3)
            time.sleep(0.3)
        assert query.isActive and query.lastProgress.batchId >= 2
    finally:
        query.stop()
    assert store.scan_ticks().count() > 0


def test_microbatch_bars_go_to_two_tables_and_a_repeat_changes_nothing(spark, flat, feed, tmp_path):
    _, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    clock = moment_literal(filters.latest_moment(flat))
    for attempt in ("one", "two"):
        queries.start_bars_batch(open_stream(), store, str(tmp_path / attempt), [MICROBATCH, "5sec-monitor"],
                                 "available now", clock).awaitTermination()
    one, two = (rows(store.scan_table(t), "Symbol", "time") for t in (MICROBATCH, "5sec-monitor"))
    assert one == two and len(one) == flat.select("Symbol").distinct().count()


def test_start_all_runs_both_queries_and_logs_progress(spark, flat, feed, tmp_path):
    add, open_stream = feed
    store = TickStore(spark, str(tmp_path / "store"))
    log = progress.ProgressLog(spark, str(tmp_path / "log"), every=2)
    spark.streams.addListener(log)
    try:
        started = queries.start_all(open_stream(), store, str(tmp_path / "cp"), "available now", "available now",
                                    clock=moment_literal(at(0)))
        for q in started:
            q.awaitTermination()
        recent = progress.recent_progress(spark, started[0])
        assert recent.agg(F.sum("numInputRows")).first()[0] > 0
        assert recent.select(F.explode("sources").alias("s")).select("s.endOffset").first()[0].startswith("{")
    finally:
        spark.streams.removeListener(log)
    log.flush()
    logged = progress.read_progress(spark, str(tmp_path / "log"))
    assert {r[0] for r in logged.select("name").distinct().collect()} == {"raw", "agg_5sec"}
    assert store.scan_ticks().count() > 0


def test_a_failing_sink_stops_the_query(spark, feed, tmp_path):
    _, open_stream = feed
    (tmp_path / "blocked").write_text("a file where the tables should go")
    store = TickStore(spark, str(tmp_path / "blocked"))
    query = queries.start_bars_batch(open_stream(), store, str(tmp_path / "cp"), trigger="available now",
                                     clock=F.lit("2000-01-01").cast("timestamp"))
    with pytest.raises(Exception):
        query.awaitTermination()


def test_streams_reject_nothing_the_batch_accepts(spark, feed):
    _, open_stream = feed
    stream = open_stream()
    assert stream.isStreaming
    for df in (filters.recent(stream, "5 seconds"), quality.hash_mismatch(stream), queries.stream_bars(stream, "5 seconds")):
        assert df.isStreaming


def test_replay_makes_one_batch_of_a_step_however_many_files(spark, tmp_path):
    """Events in several files, the last step with a single row: four steps are four micro-batches, in order."""
    given = str(tmp_path / "events.parquet")
    for part in range(3):
        spark.range(40).selectExpr(
            f"id * 3 + {part} AS event_id", "timestamp_seconds(id * 60) AS ts", "id AS user_id", "'a' AS event_type",
            "1.0D AS value", "'{\"k\": 1}' AS props").coalesce(1).write.mode("append").parquet(given)
    step = F.least(F.floor(F.col("event_id") / 50), F.lit(2)) + F.when(F.col("event_id") == 119, 1).otherwise(0)
    seen = {}
    with_many_scans = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in with_many_scans}
    for k, v in with_many_scans.items():
        spark.conf.set(k, v)
    try:
        assert views.read_events(spark, str(tmp_path)).rdd.getNumPartitions() > 2
        feed = views.replay(spark, str(tmp_path), str(tmp_path / "feed"), 4, step)
        for last in (1, 3):
            feed(last).writeStream.foreachBatch(
                lambda batch, number: seen.update({number: sorted(r["event_id"] for r in batch.collect())})).option(
                "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen == {0: list(range(50)), 1: list(range(50, 100)), 2: list(range(100, 119)), 3: [119]}
