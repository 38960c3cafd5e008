"""Stratified interleaving against the plain definition, its law and its mixture."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING
from tickloom.llm import sharding

ROWS = "doc_id long, text string, source string"


def plain_places(rows, shards):
    """(doc_id, text, source, shard, slot) of unlike rows, from sorted lists."""
    by_source = collections.defaultdict(list)
    for doc_id, text, source in rows:
        label = "" if doc_id is None else doc_id
        key = hashlib.md5(f"{sharding.SEED}:{label}:{text or ''}".encode()).hexdigest()
        by_source[source].append((key, doc_id, text))
    shares = []
    for source, own in by_source.items():
        own.sort(key=lambda r: r[0])
        for rank, (key, doc_id, text) in enumerate(own):
            shares.append(((2 * rank + 1) / (2 * len(own)), source is None, source or "", key, doc_id, text, source))
    shares.sort(key=lambda r: r[:4])
    slots = collections.Counter()
    out = []
    for place, (*_, doc_id, text, source) in enumerate(shares):
        shard = place * shards // len(shares)
        out.append((doc_id, text, source, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=str)


def some_rows(rng, n):
    sources = ["hot"] * 6 + ["b", "c", None]
    return [(i, rng.choice(["copy", f"text {i}", ""]), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("bucket_rows, span", [(7, 3), (7, 4096), (4000, 4096)])
@pytest.mark.parametrize("size, shards", [(1, 4), (5, 40), (400, 7)])
def test_places_equal_definition(spark, monkeypatch, size, shards, bucket_rows, span):
    monkeypatch.setattr(sharding, "SPAN_BUCKETS", span)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    rows = some_rows(random.Random(size), size)
    found = sharding.interleave(spark.createDataFrame(rows, ROWS), shards).select(
        "doc_id", "text", "source", "_shard", "_slot")
    assert sorted(map(tuple, found.collect()), key=str) == plain_places(rows, shards)


def test_every_shard_has_the_mixture(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(6000)]
    found = sharding.interleave(spark.createDataFrame(rows, ROWS), 40)
    counts = {r["_shard"]: r["count"] for r in found.groupBy("_shard").count().collect()}
    assert set(counts.values()) == {150} and len(counts) == 40
    whole = collections.Counter(source for *_, source in rows)
    for r in found.groupBy("_shard", "source").count().collect():
        assert abs(r["count"] - whole[r["source"]] / 40) <= 2


def test_repeated_rows_share_no_place(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_COPIES", 16)
    rows = [(1, "same", "hot")] * 500 + [(1, "same", "b")] * 40 + [(None, None, None)] * 30 + some_rows(random.Random(1), 430)
    found = sharding.interleave(spark.createDataFrame(rows, ROWS), 10).collect()
    assert collections.Counter((r["doc_id"], r["text"], r["source"]) for r in found) == collections.Counter(rows)
    assert sorted((r["_shard"], r["_slot"]) for r in found) == [(s, i) for s in range(10) for i in range(100)]
    hot = collections.Counter(r["_shard"] for r in found if r["source"] == "hot")
    assert max(hot.values()) - min(hot.values()) <= 4


def test_reruns_and_partitions_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = sharding.interleave(docs).select("doc_id", "_shard", "_slot")
    again = sharding.interleave(docs.repartition(7, F.rand(3))).select("doc_id", "_shard", "_slot")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_odd_rows(spark, odd_docs, no_docs):
    found = sharding.interleave(odd_docs, 3)
    assert {"_rest", "_shard", "_slot"} <= set(found.columns) and found.count() == 9
    kept = found.select("_rest.*").columns
    assert set(CLASHING) <= set(kept)
    assert sorted((r["_shard"], r["_slot"]) for r in found.collect()) == [(s, i) for s in range(3) for i in range(3)]
    assert sharding.interleave(no_docs).count() == 0
