import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import BASE, SF_DIR
from tickloom.operators import messages
from tickloom.plans import views
from tickloom.schema import FLAT_TICK, MESSAGE, TICK, tick_schema
from tickloom.sources import codec, topics

T0 = int(BASE.timestamp() * 1000)


def tick(t=T0, s="AAPL", p=190.25, v=10.0, c=("1", "8"), h="x", q=1):
    return (t, s, p, v, None if c is None else list(c), h, q)


def envelope(*items, at="2024-03-04T18:00:00.000+09:00"):
    return (at, list(items))


def message_rows(spark, *values):
    return spark.createDataFrame([(v, 1, 100 + i) for i, v in enumerate(values)], MESSAGE)


# SHA-256 of symbol, time, price, volume and conditions as the sender joins them.
DIGESTS = [
    (None, "179a75c16ed8d0f9c7e9ae04ba15bcd4ec30bba845f04555598a65ecacf7140e"),
    ([], "eb7305e5401c907a7491195877b0f5105b0e89216131a8a06d4c8817b0df8fd9"),
    (['1', '8'], "b9373beb2a47f14a6962e6345035a74e08c455ac6ec2c0f86e733c254fe2cf81"),
    (['quo"te', 'back\\slash'], "bcac8a53778f44edd5365f833100a95168b24efaed59177141404d3988fceaf8"),
]
NO_SYMBOL = "bd4d00ecb53b62c657e586a281690e7872dc03aca96c777c1861cc017d053dce"


def test_two_ticks_share_their_position_in_the_topic(spark):
    flat = messages.flatten_ticks(message_rows(spark, [envelope(tick(q=1), tick(q=2, s="MSFT"))]))
    assert flat.columns == FLAT_TICK.names
    assert [f.dataType for f in flat.schema] == [f.dataType for f in FLAT_TICK]
    found = flat.orderBy("Seq").collect()
    assert [(r.Symbol, r.Partition, r.Offset) for r in found] == [("AAPL", 1, 100), ("MSFT", 1, 100)]


def test_empty_messages_give_no_rows(spark):
    assert messages.flatten_ticks(message_rows(spark, [], [envelope()], None)).count() == 0


def test_each_tick_keeps_its_own_envelope_time(spark):
    flat = messages.flatten_ticks(message_rows(spark, [envelope(tick(q=1), at="a"), envelope(tick(q=2), at="b")]))
    assert [r.Timestamp_Web for r in flat.orderBy("Seq").collect()] == ["a", "b"]


@pytest.mark.parametrize(("c", "digest"), DIGESTS)
def test_hash_equals_the_senders(spark, c, digest):
    flat = messages.flatten_ticks(message_rows(spark, [envelope(tick(c=c))]))
    assert flat.first().Hash_Spark == digest


def test_hash_keeps_the_place_of_a_missing_symbol(spark):
    flat = messages.flatten_ticks(message_rows(spark, [envelope(tick(s=None))]))
    assert flat.first().Hash_Spark == NO_SYMBOL


def test_zone_shifts_the_wall_clock(spark):
    rows = message_rows(spark, [envelope(tick())])
    utc, shifted = (messages.flatten_ticks(rows, zone=z).select(F.unix_millis("Trade_Time")).first()[0]
                    for z in (None, "Asia/Seoul"))
    assert (utc, shifted - utc) == (T0, 9 * 3600 * 1000)


def test_build_then_flatten_is_identity(spark):
    flat = views.flat_ticks(views.read_events(spark, SF_DIR))
    flat = flat.withColumn("Trade_Time", F.timestamp_millis(F.unix_millis("Trade_Time")))
    flat = flat.withColumn("Timestamp_Web", F.lit("same"))
    again = messages.flatten_ticks(messages.build_envelopes(flat, max_ticks=3), position=True)
    positions = again.groupBy("Partition", "Offset").count()
    assert positions.count() > 0
    columns = FLAT_TICK.names
    assert again.select(columns).exceptAll(flat.select(columns)).count() == 0
    assert flat.select(columns).exceptAll(again.select(columns)).count() == 0


def test_large_message_is_cut_into_parts_and_kept_whole(spark):
    one = spark.range(25).select(
        F.array(F.lit("1")).alias("Trade_type"), F.lit(1.0).alias("Price"), F.lit("A").alias("Symbol"),
        F.lit(1.0).alias("Volume"), F.timestamp_millis(F.lit(T0)).alias("Trade_Time"),
        F.lit("h").alias("Hash_Web"), F.col("id").alias("Seq"), F.lit("w").alias("Timestamp_Web"),
        F.lit(7).cast("bigint").alias("Offset"), F.lit(0).alias("Partition"), F.col("id").cast("int").alias("Position"))
    packed = messages.build_envelopes(one, max_ticks=10)
    sizes = messages.ticks_per_message(packed).select("n_ticks").collect()
    assert sorted(r[0] for r in sizes) == [5, 10, 10]
    assert sorted(r.Seq for r in messages.flatten_ticks(packed).collect()) == list(range(25))


def test_json_decode_splits_malformed_texts(spark):
    texts = ['{"type":"trade","data":[{"t":1,"s":"A","p":1.5,"v":2,"c":null}]}', '{"type":"ping"}',
             "{oops", "[1]", '{"type":"trade","data":[{"t":"x"', '{"data":[]}']
    good, bad = codec.decode_json(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string"))
    assert [r.id for r in good.orderBy("id").collect()] == [0, 1, 5]
    assert [(r.id, r.value) for r in bad.orderBy("id").collect()] == [(i, texts[i]) for i in (2, 3, 4)]
    kept = messages.only_trades(good).collect()
    assert [r.id for r in kept] == [0]
    assert kept[0].data[0].p == 1.5 and kept[0].data[0].c is None


def test_lookup_lists_the_ticks_in_message_order(spark):
    rows = message_rows(spark, [envelope(tick(q=5), tick(q=6))], [envelope(tick(q=7))])
    found = messages.lookup_offset(rows, 1, 100).orderBy("Position").collect()
    assert [(r.Position, r.Seq) for r in found] == [(0, 5), (1, 6)]
    assert messages.lookup_offset(rows, 0, 100).count() == 0


def test_file_source_reads_one_message(spark, tmp_path):
    path = str(tmp_path / "topic")
    message_rows(spark, [envelope(tick(q=5))], [envelope(tick(q=6))]).write.parquet(path)
    source = topics.FileSource(path)
    assert messages.flatten_ticks(topics.read_message(spark, source, 1, 101)).first().Seq == 6
    assert topics.read_messages(spark, source).count() == 2


def test_one_message_options_cover_one_offset():
    options = topics.one_message_options("t", 1, 46170)
    assert json.loads(options["assign"]) == {"t": [1]}
    assert json.loads(options["startingOffsets"]) == {"t": {"1": 46170}}
    assert json.loads(options["endingOffsets"]) == {"t": {"1": 46171}}


def test_avro_document_matches_the_tick_struct():
    document = json.loads(tick_schema())
    fields = document["items"]["fields"][1]["type"]["items"]["fields"]
    assert [f["name"] for f in fields] == TICK.names
    assert document["items"]["fields"][0] == {"name": "timestamp_web", "type": "string"}


def test_avro_round_trip_or_a_clear_error(spark):
    rows = message_rows(spark, [envelope(tick())])
    try:
        decoded = codec.decode_avro(codec.encode_avro(rows))
        assert decoded.exceptAll(rows).count() == 0
    except AnalysisException as error:
        assert "spark-avro" in str(error)
