from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE, at, seconds_of
from tickloom.functions import times


def one(spark, column, moment=None):
    return spark.createDataFrame([(moment or at(7.123456),)], "ts timestamp").select(column).first()[0]


def test_buckets_and_labels(spark):
    assert seconds_of(one(spark, times.bucket_start("ts", "5 seconds"))) == 5
    assert seconds_of(one(spark, times.previous_bucket("ts", "5 seconds"))) == 0
    before_epoch = datetime(1969, 12, 31, 23, 59, 58, tzinfo=timezone.utc)
    assert one(spark, times.bucket_micros("ts", "5 seconds"), before_epoch) == -5_000_000


def test_epoch_forms(spark):
    micros = int(BASE.timestamp()) * 1_000_000 + 7_123_456
    assert one(spark, times.epoch_ns("ts")) == micros * 1000
    assert seconds_of(one(spark, times.from_epoch_millis(F.lit(int(BASE.timestamp() * 1000) + 1500)))) == 1.5


def test_market_clock_round_trip(spark):
    shifted = times.to_market_clock("ts")
    assert seconds_of(one(spark, shifted)) == 9 * 3600 + 7.123456
    assert seconds_of(one(spark, times.from_market_clock(shifted))) == 7.123456


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_text_forms_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, times.clock_text("ts")) == "2024-03-04 18:00:07.123"
        assert one(spark, times.iso_millis("ts")) == "2024-03-04T18:00:07.123+09:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_mixed_texts(spark):
    texts = ["2024-03-04 09:00:01", "2024-03-04 09:00:01.250", "nonsense", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    found = [r[0] for r in frame.orderBy("i").select(times.parse_time("s")).collect()]
    assert [None if f is None else seconds_of(f) for f in found] == [1.0, 1.25, None, None]


def test_driver_side_moments():
    assert times.span("15 minutes") == timedelta(minutes=15)
    assert times.floor_moment(at(3607), "1 hour") == at(3600)
    assert times.lookback_start(at(3607), "10 seconds", align="1 minute") == at(3540)
    assert times.utc(datetime(2024, 3, 4, 9)) == BASE
