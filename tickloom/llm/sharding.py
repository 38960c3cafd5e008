"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded random order; the row of rank ``r`` of ``n`` gets the
fractional rank ``(r + 1/2) / n``. Sorted by that number all sources advance at the same pace, so each of
the ``shards`` consecutive cuts, whose row counts differ by one at most, holds every source in its share of
the whole: with S sources, a source's rows in a shard differ from that share by less than two and its share
of S/2 more rows.

Neither a source nor the whole table is ever sorted in one task:

* The order key is a digest of seed, id and text, so its leading digits deal the rows of any source, however
  hot, evenly into buckets in key order. A rank is the place in the bucket plus the rows of the buckets before.
* Fractional ranks are as even, so a second set of buckets gives the place in the whole in the same way.
* Only digests take part. The texts travel once, in the join that gives rows their places. Rows equal in
  all columns are counted before any shuffle and multiplied again after the places are known, in runs of
  bounded length that are dealt out first.

The law is ``rows``: counts at most one apart. Equal texts are not held together, since a group of copies may
be larger than a shard.

Defined cases: a null source is a source of its own, behind the others in ties; a null and an empty text
differ only in the order of rows equal in id and text; rows with a null id are placed by their text; rows equal
in all columns get a place each; an empty table gives an empty result; other columns stay in ``_rest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import shielded
from tickloom.session import materialize

SHARDS = 40
SEED = "shard-1"
#: Rows that a bucket holds on average, and copies of one row that are multiplied together.
BUCKET_ROWS = 4_000
RUN_COPIES = 4_000
#: Buckets whose row counts are added up in one task.
SPAN_BUCKETS = 4_096


def order_key(seed: str = SEED) -> Column:
    """A digest of seed, id and text."""
    parts = (F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
             F.coalesce(F.col("text"), F.lit("")))
    return F.md5(F.concat(*parts).cast("binary"))


def _rows_before(rows: DataFrame, within: list[str], bucket: str, amount: Column) -> DataFrame:
    """Per (``within``, ``bucket``) the amount in the buckets before.

    Buckets are ordered inside spans of ``SPAN_BUCKETS``, and the spans among themselves, so no task orders all.
    """
    counts = rows.groupBy(*within, bucket).agg(F.sum(amount).alias("_amount")).withColumn(
        "_span", F.floor(F.col(bucket) / SPAN_BUCKETS))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*within, "_span").orderBy(bucket).rowsBetween(*earlier)
    across = Window.partitionBy(*within).orderBy("_span").rowsBetween(*earlier)
    none = F.lit(0).cast("long")
    spans = counts.groupBy(*within, "_span").agg(F.sum("_amount").alias("_before")).withColumn(
        "_before", F.coalesce(F.sum("_before").over(across), none))
    placed = counts.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), none))
    placed = _with_before(placed, spans, [*within, "_span"])
    return placed.select(*within, bucket, (F.col("_before") + F.col("_inside")).alias("_before"))


def _with_before(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_before`` of their bucket; null keys match."""
    renamed = before.select(*[F.col(k).alias(f"_other{k}") for k in keys], "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_other{k}")) for k in keys]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return rows.join(renamed, condition).drop(*[f"_other{k}" for k in keys])


def places(keys: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``_key``, ``_tie``, ``_shard``, ``_slot`` for each row of ``keys(source, _key, _tie)``.

    Rows with equal keys are copies of one row; each gets a place.
    """
    counted = materialize(keys.groupBy("source", "_key", "_tie").agg(F.count("*").alias("_copies")))
    total = counted.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    buckets = -(-total // BUCKET_ROWS) or 1

    digits = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    dealt = counted.withColumn("_bucket", F.shiftright(digits * F.lit(buckets), 32))
    sizes = counted.groupBy("source").agg(F.sum("_copies").alias("_before"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "_tie").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = _with_before(dealt, _rows_before(dealt, ["source"], "_bucket", F.col("_copies")),
                          ["source", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    ranked = _with_before(ranked.drop("_before", "_bucket"), sizes, ["source"])

    runs = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(RUN_COPIES).cast("long"))
    spread = ranked.withColumn("_run", F.explode(runs)).repartition("_key", "_tie", "_run")
    last = F.least(F.col("_run") + (RUN_COPIES - 1), F.col("_copies") - 1)
    single = spread.withColumn("_copy", F.explode(F.sequence("_run", last)))
    share = (2 * (F.col("_rank") + F.col("_copy")) + 1) / (2 * F.col("_before"))
    placed = materialize(single.select("source", "_key", "_tie", "_copy", share.alias("_share")))

    placed = placed.withColumn("_bucket", F.least(F.floor(F.col("_share") * buckets), F.lit(buckets - 1)))
    along = Window.partitionBy("_bucket").orderBy("_share", F.col("source").asc_nulls_last(), "_key", "_tie", "_copy")
    placed = _with_before(placed, _rows_before(placed, [], "_bucket", F.lit(1)), ["_bucket"])
    place = F.col("_before") + F.row_number().over(along) - 1
    placed = placed.withColumn("_place", place).withColumn(
        "_shard", F.expr(f"(_place * {shards}) div {max(total, 1)}"))
    begin = F.expr(f"(_shard * {total} + {shards - 1}) div {shards}")
    return placed.select("_key", "_tie", F.col("_shard").cast("int").alias("_shard"),
                         (F.col("_place") - begin).alias("_slot"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``shielded(docs)`` with ``_shard`` (from 0) and ``_slot`` (from 0 without gaps in the shard)."""
    docs = shielded(docs, "doc_id", "source", "text")
    rest = [F.to_json("_rest")] if "_rest" in docs.columns else []
    tie = F.xxhash64(F.col("source"), F.col("text").isNull(), *rest)
    keyed = docs.withColumn("_key", order_key(seed)).withColumn("_tie", tie)
    placed = places(keyed.select("source", "_key", "_tie"), shards)
    distinct = keyed.groupBy("_key", "_tie").agg(F.first(F.struct(*docs.columns)).alias("_row"))
    return placed.join(distinct, ["_key", "_tie"]).select("_row.*", "_shard", "_slot")
