import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import at, rows
from tickloom.operators import ordered


def bar_frame(spark, counts, seed=1, gap=40, nulls=()):
    """Bars at irregular multiples of 5 seconds; ``counts`` gives bars per symbol."""
    pick = random.Random(seed)
    data = []
    for symbol, n in counts.items():
        t = 0
        for i in range(n):
            t += 5 * pick.randint(1, gap)
            data.append((symbol, at(t), None if (symbol, i) in nulls else round(pick.uniform(1, 9), 2), i))
    return spark.createDataFrame(data, "Symbol string, time timestamp, Close double, place int")


def near(found):
    """Averages are added up in another order than the plain window does."""
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in found]


def plain(bars, windows):
    w = Window.partitionBy("Symbol").orderBy("time")
    return bars.withColumns({
        f"MA_{n}": F.when(F.count("Close").over(w.rowsBetween(1 - n, 0)) == n, F.avg("Close").over(w.rowsBetween(1 - n, 0)))
        for n in windows})


@pytest.mark.parametrize("segment", ["1 minute", "10 minutes", "2 hours", "30 days", None])
def test_averages_equal_the_plain_window_for_any_segment(spark, segment):
    bars = bar_frame(spark, {"A": 400, "B": 7, "C": 60, "D": 1}, nulls={("A", 30), ("A", 200)})
    mine = ordered.moving_averages(bars, segment=segment)
    assert near(rows(mine, "Symbol", "time")) == near(rows(plain(bars, [5, 10, 20, 60]), "Symbol", "time"))


@pytest.mark.parametrize("windows", [[1], [3, 7], [60, 5], [2, 4, 9, 18], [20]])
def test_averages_of_any_lengths(spark, windows):
    bars = bar_frame(spark, {"A": 80, "B": 3})
    mine = ordered.moving_averages(bars, windows, segment="20 minutes")
    assert mine.columns == [*bars.columns, *[f"MA_{n}" for n in windows]]
    assert near(rows(mine, "Symbol", "time")) == near(rows(plain(bars, windows), "Symbol", "time"))


def test_averages_equal_the_mean_of_the_last_closes(spark):
    bars = bar_frame(spark, {"A": 150, "B": 20})
    mine = ordered.moving_averages(bars, segment="5 minutes").toPandas().sort_values(["Symbol", "place"])
    for n in (5, 10, 20, 60):
        for _, rows_ in mine.groupby("Symbol"):
            closes, found = rows_["Close"].tolist(), rows_[f"MA_{n}"].tolist()
            for i, value in enumerate(found):
                if i + 1 < n:
                    assert value != value
                else:
                    assert value == pytest.approx(sum(closes[i + 1 - n:i + 1]) / n)


def test_average_appears_with_the_nth_bar(spark):
    for n, expected in [(4, [None] * 4), (5, [None] * 4 + [True]), (6, [None] * 4 + [True, True])]:
        found = ordered.moving_averages(bar_frame(spark, {"A": n}), [5]).orderBy("time").collect()
        assert [None if r.MA_5 is None else True for r in found] == expected


def test_segmented_average_never_groups_a_symbol_whole(spark):
    bars = bar_frame(spark, {"A": 400})
    plan = ordered.moving_averages(bars, segment="10 minutes")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_seg") > 0


def feed_frame(spark, n=2000, hot_share=3):
    """Rows of which a third share one feed and one time."""
    return spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), F.col("id") % 5)).alias("feed"),
        F.when(F.col("id") % hot_share == 0, F.lit(0)).otherwise(F.col("id") * 7919 % 1009).alias("ts"),
        (F.col("id") * 104729 % 1000003).alias("tie"))


def test_running_numbers_equal_row_number(spark):
    source = feed_frame(spark)
    expected = source.withColumn("Seq", F.row_number().over(Window.partitionBy("feed").orderBy("ts", "tie")))
    mine = ordered.assign_seq(source, ["feed"], ["ts", "tie"])
    assert rows(mine, "feed", "Seq") == [(*r[:3], r[3]) for r in rows(expected, "feed", "Seq")]


def test_running_numbers_of_one_feed_and_of_null_feeds(spark):
    source = feed_frame(spark, 500).withColumn("feed", F.lit(None).cast("string"))
    assert [r[0] for r in rows(ordered.assign_seq(source, ["feed"], ["ts", "tie"]).select("Seq"), "Seq")] == list(range(1, 501))
    assert ordered.assign_seq(source, [], ["ts", "tie"]).agg(F.countDistinct("Seq"), F.max("Seq")).first()[:] == (500, 500)


def test_a_hot_feed_is_spread_over_range_segments(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows share a task
    try:
        placed = ordered.range_segments(feed_frame(spark, 40000), ["feed", "ts", "tie"])
        sizes = [r[0] for r in placed.filter("feed = 'hot'").groupBy("_segment").count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 13334 and len(sizes) > 1 and max(sizes) < 13334
