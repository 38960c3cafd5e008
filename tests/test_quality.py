from datetime import timedelta

from pyspark.sql import functions as F

from tests.conftest import BASE, at, rows, seconds_of, ticks
from tickloom.operators import quality
from tickloom.schema import PROGRESS


def test_hash_mismatch_counts_a_missing_side(spark):
    source = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), (None, None)],
                                   "Hash_Web string, Hash_Spark string")
    assert sorted(rows(quality.hash_mismatch(source)), key=str) == [("a", "b"), (None, "b")]


def test_gap_and_restart_in_seq(spark):
    seqs = [1, 2, 4, 1, 2, 2, 7]
    source = spark.createDataFrame([("f", f"2024-03-04T18:00:{i:02d}.000+09:00", s) for i, s in enumerate(seqs)],
                                   "feed string, Timestamp_Web string, Seq bigint")
    assert rows(quality.seq_gaps(source, ["feed"]), "after_seq") == [("f", 2, 4, 1), ("f", 2, 7, 4)]
    assert rows(quality.seq_gaps(source), "after_seq") == [(2, 4, 1), (2, 7, 4)]


def test_gaps_are_found_across_segments(spark):
    source = spark.range(5000).filter("id % 100 <> 0 and id > 0").select(
        F.lit("f").alias("feed"), F.format_string("%09d", F.col("id")).alias("Timestamp_Web"), F.col("id").alias("Seq"))
    assert quality.seq_gaps(source, ["feed"]).count() == 49


def silent(df):
    return [(seconds_of(r.gap_start), seconds_of(r.gap_end), r.gap_micros) for r in df.orderBy("gap_start").collect()]


def test_only_silence_beyond_the_threshold_counts(spark):
    source = ticks(spark, [("A", 1.0, 1.0, float(t), t) for t in (0, 59, 60, 121, 180, 240)])
    assert silent(quality.stale_intervals(source)) == [(60.0, 121.0, 61_000_000)]
    assert silent(quality.stale_intervals(source, now=at(301))) == [
        (60.0, 121.0, 61_000_000), (240.0, 301.0, 61_000_000)]
    assert len(silent(quality.stale_intervals(source, now=at(300)))) == 1


def test_silence_per_feed_across_segments(spark):
    source = ticks(spark, [(s, 1.0, 1.0, t * 3600.0 + d, t) for t in range(30) for s, d in (("A", 0), ("B", 1800))])
    for segment in ("1 hour", "7 hours", "30 days"):
        assert quality.stale_intervals(source, feed=["Symbol"], segment=segment).count() == 58
        assert quality.stale_intervals(source, "31 minutes", segment=segment).count() == 0


def test_latency_percentiles_are_exact(spark):
    source = spark.range(1, 1001).select(
        F.lit("A").alias("Symbol"), F.lit(at(0)).alias("Trade_Time"),
        F.date_format(F.timestamp_millis(F.lit(int(BASE.timestamp() * 1000)) + F.col("id")),
                      "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("Timestamp_Web"))
    found = quality.latency(source, F.lit(at(2))).first()
    assert (found.n, found.min_ms, found.max_ms, found.p50_ms, found.p95_ms) == (1000, 1, 1000, 500, 950)
    assert (found.mean_ms, found.spark_mean_ms) == (500.5, 1499.5)


def test_unreadable_ingest_times_count_nowhere(spark):
    source = spark.createDataFrame(
        [("A", at(0), "2024-03-04T18:00:00.007+09:00"), ("A", at(0), "?"), ("B", at(0), None)],
        "Symbol string, Trade_Time timestamp, Timestamp_Web string")
    found = {r.Symbol: (r.n, r.p50_ms, r.mean_ms) for r in quality.latency(source).collect()}
    assert found == {"A": (1, 7, 7.0), "B": (0, None, None)}


def progress(spark):
    def report(name, seconds, rows_in, *sources):
        return (name, at(seconds), rows_in, list(sources))

    return spark.createDataFrame([
        report("raw", 0, 5, ("topic", '{"stock_data":{"0":10,"1":7}}')),
        report("raw", 5, 3, ("topic", '{"stock_data":{"0":12,"1":8}}')),
        report("raw", 10, 0, ("topic", '{"stock_data":{"0":12,"1":8}}')),
        report("agg", 5, 1, ("files", '{"logOffset":3}'), ("topic", '{"other":{"2":1}}')),
    ], PROGRESS)


def test_offsets_per_query_topic_and_partition(spark):
    assert quality.progress_offsets(progress(spark)).count() == 7
    assert rows(quality.latest_offsets(progress(spark)), "query", "partition") == [
        ("agg", "other", "2", 1), ("raw", "stock_data", "0", 12), ("raw", "stock_data", "1", 8)]


def test_stale_queries_look_at_reports_with_rows(spark):
    found = quality.stale_queries(progress(spark), at(0) + timedelta(seconds=65.5))
    assert sorted(r.query for r in found.collect()) == ["agg", "raw"]
    assert quality.stale_queries(progress(spark), at(64)).count() == 0
