"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its shingles of ``WORDS`` lower-cased (A-Z) words, weighted by how often
they occur. Every unit of weight of an element is a region of the plane (weight x rank) into which hashed
darts fall at a rate of one per unit of rank; a dart's hash also names one of ``COORDINATES`` coordinates,
and each coordinate keeps the dart of lowest rank. Ranks are searched in blocks of growing size, the same
for all documents, until every coordinate has its dart. Two documents agree in a coordinate with
probability equal to their weighted Jaccard similarity.

``ROWS`` coordinates make a band. At similarity 0.8 a pair shares no band with a probability of
(1 - 0.8**4)**24 = 3e-6. Links are then verified by the exact weighted Jaccard similarity:

1. documents with equal weighted sets fall together by a 128-bit hash;
2. in each bucket, all members are compared with its most central one (largest number of bucket mates);
3. buckets of three or more that still hold several classes are compared across classes, in squares of
   bounded size, and give one link for each pair of classes that meets.

So no list of all pairs is ever made, and no link between different classes is lost beyond the stated
probability. Sets are compared as 32-bit hashes.

Defined cases: null texts count as empty; documents without words form one class; texts under ``WORDS``
words are one shingle; repeated rows and ties get equal results; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.text import as_strings, lowered_words, restored, shielded, slices, tidied
from tickloom.session import scratch_path

WORDS = 5
SIMILAR = 0.8
COORDINATES = 96
ROWS = 4
SQUARE = 1024
#: Rank blocks below 1, in order; from 1 on blocks have length 1.
FIRST_BLOCKS = (0.0, 0.125, 0.25, 0.5, 1.0)
MOST_DARTS = 24

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _B
        x = (x ^ (x >> np.uint64(29))) * _A
        return x ^ (x >> np.uint64(32))


def _poisson_steps(mean: float) -> np.ndarray:
    steps, p, total = [], np.exp(-mean), 0.0
    for n in range(1, MOST_DARTS + 1):
        total += p
        steps.append(total)
        p *= mean / n
    return np.array(steps)


_STEPS = {mean: _poisson_steps(mean) for mean in (0.125, 0.25, 0.5, 1.0)}


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def shingles(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Hash of each run of ``words`` words; of all words if there are fewer."""
    if not len(hashes):
        return hashes
    span = min(words, len(hashes))
    with np.errstate(over="ignore"):
        out = hashes[:len(hashes) - span + 1].copy()
        for i in range(1, span):
            out = mixed(out * _A + hashes[i:len(hashes) - span + 1 + i])
    return out


def weighted_cells(elements: np.ndarray) -> np.ndarray:
    """One hash per unit of weight: (element, how many of it came before), sorted."""
    ordered = np.sort(elements)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, bool)
    turn = np.arange(len(ordered)) - np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    with np.errstate(over="ignore"):
        return np.sort(mixed(ordered + turn.astype(np.uint64) * _B))


def dart_signature(cells: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The dart kept by each coordinate, as a 64-bit hash; ``cells`` must not be empty."""
    kept = np.zeros(coordinates, np.uint64)
    filled = np.zeros(coordinates, bool)
    block, begin = 0, 0.0
    while not filled.all():
        if begin < 1:
            until, count = FIRST_BLOCKS[block + 1], 1
            mean = until - begin
        else:  # several blocks of length 1 at once for light documents
            count, mean = max(1, 256 // len(cells)), 1.0
        with np.errstate(over="ignore"):
            keys = mixed(cells[None, :] + (np.uint64(block + 1) + np.arange(count, dtype=np.uint64))[:, None] * _A)
        darts = np.searchsorted(_STEPS[mean], (keys >> np.uint64(11)) * 2.0 ** -53, side="right")
        rank0 = np.repeat(begin + mean * np.arange(count), len(cells)).reshape(count, -1)
        source = np.repeat(keys.ravel(), darts.ravel())
        if len(source):
            until_ = np.cumsum(darts.ravel())
            number = np.arange(len(source)) - np.repeat(until_ - darts.ravel(), darts.ravel())
            with np.errstate(over="ignore"):
                dart = mixed(source + (number.astype(np.uint64) + np.uint64(1)) * _B)
            rank = np.repeat(rank0.ravel(), darts.ravel()) + mean * ((mixed(dart) >> np.uint64(11)) * 2.0 ** -53)
            place = (mixed(dart ^ _A) % np.uint64(coordinates)).astype(np.int64)
            order = np.argsort(-rank, kind="stable")
            order = order[~filled[place[order]]]
            kept[place[order]] = dart[order]  # the last one written has the lowest rank
            filled[place[order]] = True
        block += count
        begin += mean * count
    return kept


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates."""
    grouped = signature.reshape(-1, rows)
    out = np.arange(1, len(grouped) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows):
            out = mixed(out * _A + grouped[:, i])
    return out


def _documents(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The cells of each text of a batch."""
    for texts in slices(as_strings(batch["text"])):
        codes, words, starts = lowered_words(texts)
        hashes = word_hashes(words)[codes]
        for begin, end in zip(starts[:-1], starts[1:]):
            yield weighted_cells(shingles(hashes[begin:end]))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, found = [], []
        for cells in _documents(batch):
            keys.append(xxhash.xxh3_128_digest(cells.tobytes()))
            found.append(bands(dart_signature(cells)).view(np.int64) if len(cells) else [])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["tie"], pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
            names=["doc_id", "tie", "key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.sort((cells >> np.uint64(32)).astype("<u4")).tobytes() for cells in _documents(batch)]
        yield pa.RecordBatch.from_arrays([batch["v"], pa.array(found, pa.binary())], names=["v", "cells"])


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared)


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [np.frombuffer(x, "<u4") for x in batch["cells_a"].to_pylist()]
            right = [np.frombuffer(x, "<u4") for x in batch["cells_b"].to_pylist()]
            near = pa.array([similarity(x, y) >= least for x, y in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)
    return run


def _incidence(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(vocabulary)), np.float32)
    for i, own in enumerate(sets):
        at = np.searchsorted(vocabulary, own)
        at[at == len(vocabulary)] = 0
        hit = vocabulary[at] == own if len(vocabulary) else np.zeros(len(own), bool)
        out[i, at[hit]] = 1
    return out


def _across(least: float):
    """Links between different classes of a square of a bucket, one for each pair of classes that meets."""
    def run(square: pa.Table) -> pa.Table:
        side = np.asarray(square["side"].to_pylist())
        vertex = np.asarray(square["v"].to_pylist(), np.int64)
        group = np.asarray(square["class"].to_pylist(), np.int64)
        sets = [np.frombuffer(x, "<u4") for x in square["cells"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        rows = np.flatnonzero(side <= 0)  # 0: compared with each other; -1 and 1: across
        columns = rows if not (side != 0).any() else np.flatnonzero(side == 1)
        links: dict[tuple[int, int], tuple[int, int]] = {}
        if len(rows) and len(columns):
            values, times = np.unique(np.concatenate(sets), return_counts=True)
            vocabulary = values[times > 1]
            for r in range(0, len(rows), 256):
                mine = rows[r:r + 256]
                for c in range(0, len(columns), 256):
                    other = columns[c:c + 256]
                    shared = np.zeros((len(mine), len(other)), np.float32)
                    for v in range(0, len(vocabulary), 16_384):
                        slice_ = vocabulary[v:v + 16_384]
                        shared += (_incidence([sets[i] for i in mine], slice_)
                                   @ _incidence([sets[i] for i in other], slice_).T)
                    near = shared >= least * (sizes[mine][:, None] + sizes[other][None, :] - shared) - 1e-6
                    near &= group[mine][:, None] != group[other][None, :]
                    for x, y in zip(*np.nonzero(near)):
                        i, j = mine[x], other[y]
                        if group[i] > group[j]:
                            i, j = j, i
                        links.setdefault((group[i], group[j]), (vertex[i], vertex[j]))
        return pa.table({"a": pa.array([x for x, _ in links.values()], pa.int64()),
                         "b": pa.array([y for _, y in links.values()], pa.int64())})
    return run


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, tie, class_id, class_tie.

    ``tie`` is the MD5 of the text; the class is named by its smallest (doc_id, tie).
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "neardup")

    def fixed(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"), "text")
    sketches = fixed(texts.mapInArrow(
        tidied(_sketch), f"doc_id {kind}, tie string, key binary, bands array<long>").selectExpr(
        "doc_id", "tie", "key", "bands"), "sketches")
    names = sketches.groupBy("key").agg(F.min(F.struct("doc_id", "tie")).alias("rep"))
    distinct = fixed(names.select("key", "rep.doc_id", "rep.tie")
                     .withColumn("v", F.monotonically_increasing_id()), "distinct")

    reps = distinct.withColumnRenamed("doc_id", "rep_id").withColumnRenamed("tie", "rep_tie")
    own = (sketches.join(reps, "key")
           .where(F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("tie") == F.col("rep_tie")))
           .select("v", "bands").dropDuplicates(["v"]))
    banded = own.select("v", F.explode("bands").alias("b"))
    counts = banded.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    buckets = fixed(banded.join(counts, "b"), "buckets")
    central = buckets.groupBy("v").agg(F.sum("n").alias("mates"))
    pivots = buckets.join(central, "v").groupBy("b").agg(F.max(F.struct("mates", "v"))["v"].alias("a"))
    pairs = (buckets.join(pivots, "b").where("a <> v")
             .select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct())

    needed = (buckets.select("v").distinct().join(distinct, "v").select("v", "doc_id", "tie")
              .withColumnsRenamed({"doc_id": "rep_id", "tie": "rep_tie"}))
    wanted = (texts.join(needed, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("tie") == F.col("rep_tie")))
              .select("v", "text"))
    sets = fixed(wanted.mapInArrow(tidied(_sets), "v long, cells binary").dropDuplicates(["v"]), "sets")
    with_a = pairs.join(sets.withColumnsRenamed({"v": "a", "cells": "cells_a"}), "a")
    with_both = with_a.join(sets.withColumnsRenamed({"v": "b", "cells": "cells_b"}), "b")
    stars = fixed(with_both.select("a", "b", "cells_a", "cells_b").mapInArrow(tidied(_verify(similar)), "a long, b long"),
                  "stars")

    first = components(stars)
    placed = buckets.where("n > 2").join(first, "v", "left").withColumn("class", F.coalesce("class", "v"))
    open_ = placed.groupBy("b").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.max("n").alias("n"),
        F.sum(F.xxhash64("v").cast("decimal(20,0)")).alias("members")).where("low <> high")
    once = open_.groupBy("members", "n").agg(F.min("b").alias("b"))  # equal buckets of other bands
    cut = F.ceil(F.col("n") / SQUARE).cast("int")
    mine = F.pmod(F.xxhash64("v"), cut.cast("long")).cast("int")
    dealt = (placed.join(once.select("b"), "b").withColumn("cut", cut).withColumn("part", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
             .select("b", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"),
                     F.signum(F.col("part") - F.col("other")).cast("int").alias("side"), "v", "class"))
    squares = dealt.join(sets, "v").groupBy("b", "x", "y").applyInArrow(_across(similar), "a long, b long")
    links = stars.union(fixed(squares, "across"))

    classes = components(links)
    found = distinct.join(classes, "v", "left").withColumn("class", F.coalesce("class", "v"))
    labels = found.groupBy("class").agg(F.min(F.struct("doc_id", "tie")).alias("c"))
    named = found.join(labels, "class").select("key", F.col("c.doc_id").alias("class_id"),
                                               F.col("c.tie").alias("class_tie"))
    return sketches.select("doc_id", "tie", "key").join(named, "key").drop("key")


def one_of_each(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that name their class, one of each; columns as in ``docs``.

    Rows repeated as a whole are told apart by their number, in the order that the join leaves.
    """
    key = lambda id_, tie: F.concat_ws(":", F.col(id_).cast("string"), tie)
    classes = near_duplicates(docs.select("doc_id", "text"), similar)
    chosen = classes.select(key("class_id", F.col("class_tie")).alias("_key")).distinct()
    marked = shielded(docs, "doc_id", "text").withColumn("_key", key("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    number = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return restored(marked.join(chosen, "_key").withColumn("_number", number).where("_number = 1"), docs)
