"""Nearest neighbours by inner product with vantage-point trees per shard.

The largest inner product becomes a smallest distance: with M the largest norm, a vector x is extended by
sqrt(M*M - x.x) and a query q by 0, so that the squared distance is q.q + M*M - 2 q.x. Vectors are dealt
to shards of bounded size by the hash of their id. A shard's tree splits at the median distance from a
vantage point down to leaves; a query, with the k-th best distance found so far as its radius, leaves out
a side when the triangle inequality puts it farther than ``radius / relax``. ``relax`` 1, the default, is exact
search; larger values leave out more and lose neighbours. Equal vectors are one point of the tree, which
stands for all their ids. A shard's tree is built once: its rows come first in its partition, then the
queries stream past it. A shard returns a query's k best by (score, id), and the k best of all shards are kept.

Scores are inner products of the original vectors in double precision, added from the first component to the
last. Defined cases: vectors that are null, zero, or hold null or non-finite components, and those of another
length than most (of equally frequent lengths the smaller one counts), take no part; equal vectors under
different ids are all candidates; rows equal in id and vector are one row; an id with several vectors has a row
and, as a query, a result for each; equal scores are ordered by id; a query never finds its own row; fewer
candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEIGHBOURS = 20
QUERY_EVERY = 20
SHARD_ROWS = 32_768
BLOCK_ROWS = 2_048
LEAF = 1_024
RELAX = 1.0
#: Squared distances are right up to this part of the largest squared length.
ROUNDING = 1e-12
#: Inner products worked out at a time.
PRODUCTS = 65_536


def ranks(groups: np.ndarray) -> np.ndarray:
    """Number of each entry in its run of equal entries."""
    at = np.arange(len(groups))
    new = np.concatenate([[True], groups[1:] != groups[:-1]])[:len(groups)]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows, added up in order."""
    return np.cumsum(left * right, axis=1)[:, -1]


class VantageTree:
    """Rows of ``points`` ordered so that every node of the tree is a contiguous range."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.order = np.arange(len(points))
        self.scale = float((points ** 2).sum(1).max()) if len(points) else 0.0
        #: (begin, end, vantage row or -1, median distance, inner child, outer child)
        self.nodes: list[tuple[int, int, int, float, int, int]] = []
        if len(points):
            self._split(0, len(points))

    def _split(self, begin: int, end: int) -> int:
        number = len(self.nodes)
        self.nodes.append((begin, end, -1, 0.0, -1, -1))
        if end - begin <= self.leaf:
            return number
        own = self.order[begin:end]
        centre = self.points[own].mean(0)
        vantage = own[np.argmax(((self.points[own] - centre) ** 2).sum(1))]  # far out: distances vary most
        apart = np.sqrt(np.maximum(((self.points[own] - self.points[vantage]) ** 2).sum(1), 0))
        half = (end - begin) // 2
        by = np.argpartition(apart, half)
        self.order[begin:end] = own[by]
        median = float(apart[by[half]])
        inner = self._split(begin, begin + half)
        outer = self._split(begin + half, end)
        self.nodes[number] = (begin, end, int(vantage), median, inner, outer)
        return number

    def search(self, queries: np.ndarray, k: int, relax: float, leave_out: np.ndarray):
        """Rows and inner products of the ``k`` nearest of each query, of equal ones the first rows; -1 and -inf
        where there are fewer.

        ``leave_out``: the row that is the query itself, or -1.
        """
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1, np.int64)
        scores = np.full((len(queries), k), -np.inf)
        if self.nodes:
            self._visit(0, np.arange(len(queries)), np.zeros(len(queries)), queries, k, relax, leave_out,
                        (best, rows, scores))
        return rows, scores

    def _leaf(self, begin, end, asked, queries, k, leave_out, kept):
        """Take the rows of a leaf that are among the ``k`` best: squared distances, which rounding can order
        wrongly, only choose candidates; inner products and then row numbers decide."""
        best, rows, scores = kept
        mine = self.order[begin:end]
        points = self.points[mine]
        sizes = (points ** 2).sum(1)
        lengths = (queries[asked] ** 2).sum(1)
        squares = lengths[:, None] + sizes[None, :] - 2 * queries[asked] @ points.T
        squares = np.maximum(squares, 0)
        squares[mine[None, :] == leave_out[asked][:, None]] = np.inf
        joined = np.concatenate([best[asked], squares], 1)
        limit = np.partition(joined, k - 1, 1)[:, k - 1] + ROUNDING * (lengths + sizes.max())
        who, place = np.nonzero((joined <= limit[:, None]) & np.isfinite(joined))
        old = place < k
        name = np.where(old, rows[asked[who], np.minimum(place, k - 1)], mine[np.maximum(place - k, 0)])
        score = np.where(old, scores[asked[who], np.minimum(place, k - 1)], 0.0)
        new = np.flatnonzero(~old)
        for at in range(0, len(new), PRODUCTS):
            own = new[at:at + PRODUCTS]
            score[own] = products(queries[asked[who[own]]], self.points[name[own]])
        order = np.lexsort((name, -score, who))
        who, place, name, score = who[order], place[order], name[order], score[order]
        rank = ranks(who)
        stay = rank < k
        who, place, name, score, rank = who[stay], place[stay], name[stay], score[stay], rank[stay]
        best[asked], rows[asked], scores[asked] = np.inf, -1, -np.inf
        best[asked[who], rank] = joined[who, place]
        rows[asked[who], rank] = name
        scores[asked[who], rank] = score

    def _visit(self, number, asked, bound, queries, k, relax, leave_out, kept):
        """Look at a node for the queries ``asked`` whose distance to it is ``bound`` at least."""
        go = (bound * relax) ** 2 <= kept[0][asked].max(1) + ROUNDING * self.scale
        asked, bound = asked[go], bound[go]
        if not len(asked):
            return
        begin, end, vantage, median, inner, outer = self.nodes[number]
        if vantage < 0:
            self._leaf(begin, end, asked, queries, k, leave_out, kept)
            return
        apart = np.sqrt(np.maximum(((queries[asked] - self.points[vantage]) ** 2).sum(1), 0))
        near_inner = apart < median
        inner_bound = np.maximum(bound, apart - median)
        outer_bound = np.maximum(bound, median - apart)
        for side, first, second, first_bound, second_bound in (
                (near_inner, inner, outer, inner_bound, outer_bound),
                (~near_inner, outer, inner, outer_bound, inner_bound)):
            if side.any():
                self._visit(first, asked[side], first_bound[side], queries, k, relax, leave_out, kept)
                self._visit(second, asked[side], second_bound[side], queries, k, relax, leave_out, kept)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.asarray(column.combine_chunks().flatten(), np.float64)
    return flat.reshape(len(column), -1)


def distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct vector in the order of rows, and each row's number among them."""
    whole = np.ascontiguousarray(vectors + 0.0)  # -0.0 and 0.0 are one value
    whole = whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel()
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    number = np.empty(len(first), np.int64)
    number[np.argsort(first)] = np.arange(len(first))
    return np.sort(first), number[group.ravel()]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector takes part, as ``vec_id`` and ``embedding`` (doubles) with its squared ``norm``."""
    doubles = F.col("embedding").cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    square = F.aggregate(doubles, F.lit(0.0), lambda total, x: total + x * x)
    rows = (vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
            .where(~F.coalesce(bad, F.lit(False)))
            .select("vec_id", doubles.alias("embedding"), square.alias("norm")).where("norm > 0"))
    return rows


class Shard:
    """The tree over a shard's rows and their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        # the tree holds each vector once, numbered by its smallest id; its copies' ids come back at the end
        firsts, group = distinct(vectors)
        kept = np.unique(np.stack([ids, group], 1), axis=0, return_index=True)[1]  # equal rows are one
        self.ids, self.group = ids[kept], group[kept]
        self.sizes = np.bincount(self.group, minlength=len(firsts))
        self.begins, self.by_group = np.cumsum(self.sizes) - self.sizes, np.argsort(self.group, kind="stable")
        self.vectors = vectors[firsts]
        extra = np.sqrt(np.maximum(longest - (self.vectors ** 2).sum(1), 0))
        self.tree = VantageTree(np.column_stack([self.vectors, extra]))

    def own_group(self, asking: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The group of each query's own row, or -1 for one of another shard."""
        own = np.full(len(asking), -1)
        at = np.searchsorted(self.ids, asking)
        open_ = np.flatnonzero(at < len(self.ids))
        while len(open_):
            open_ = open_[self.ids[at[open_]] == asking[open_]]
            same = (self.vectors[self.group[at[open_]]] == asked[open_]).all(1)
            own[open_[same]] = self.group[at[open_[same]]]
            at[open_] += 1
            open_ = open_[~same]
            open_ = open_[at[open_] < len(self.ids)]
        return own

    def search(self, asking: np.ndarray, asked: np.ndarray, k: int, relax: float):
        """Place of the query, vec_id and score of the ``k`` best of each."""
        own = self.own_group(asking, asked)
        alone = np.where((own >= 0) & (self.sizes[own] == 1), own, -1)
        # a query is only compared within its direction: a common length keeps the order of the products
        # one more than k, as copies of a query's own row may take a place
        found, scores = self.tree.search(np.column_stack([asked, np.zeros(len(asked))]),
                                         min(k + 1, len(self.vectors)), relax, alone)
        who, which = np.nonzero(found >= 0)
        hit, score = found[who, which], scores[who, which]
        many = np.minimum(self.sizes[hit], k + 1)
        who, score, hit, begin = (np.repeat(x, many) for x in (who, score, hit, self.begins[hit]))
        vec = self.ids[self.by_group[begin + ranks(np.repeat(np.arange(len(many)), many))]]
        other = (vec != asking[who]) | (hit != own[who])
        who, score, vec = who[other], score[other], vec[other]
        order = np.lexsort((vec, -score, who))
        who, score, vec = who[order], score[order], vec[order]
        stay = ranks(who) < k
        return who[stay], vec[stay], score[stay]


def _search(k: int, relax: float, longest: float):
    """Rows of a shard and then its queries, shard by shard; the queries are answered some at a time."""
    def answers(shard: Shard, waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        asked = pa.Table.from_batches(waiting)
        who, vec, score = shard.search(np.asarray(asked["vec_id"]), _matrix(asked["embedding"]), k, relax)
        return pa.RecordBatch.from_arrays(
            [asked["vec_id"].combine_chunks().take(pa.array(who)), asked["variant"].combine_chunks().take(pa.array(who)),
             pa.array(vec, pa.int64()), pa.array(score, pa.float64())], names=["query_id", "variant", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, rows, waiting = None, None, [], []
        for batch in batches:
            kinds = np.asarray(batch["shard"]) * 2 + np.asarray(batch["asks"])
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                piece, (own, asks) = batch.slice(begin, end - begin), divmod(int(kinds[begin]), 2)
                if own != number:
                    if waiting:
                        yield answers(shard, waiting)
                    number, shard, rows, waiting = own, None, [], []
                if not asks:
                    rows.append(piece)
                    continue
                if shard is None:
                    if not rows:  # no row was dealt to this shard
                        continue
                    table = pa.Table.from_batches(rows)
                    shard, rows = Shard(np.asarray(table["vec_id"]), _matrix(table["embedding"]), longest), []
                waiting.append(piece)
                if sum(w.num_rows for w in waiting) >= BLOCK_ROWS:
                    yield answers(shard, waiting)
                    waiting = []
        if waiting:
            yield answers(shard, waiting)
    return run


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, every: int = QUERY_EVERY, relax: float = RELAX) -> DataFrame:
    """The ``k`` nearest rows of each query (``vec_id`` divisible by ``every``): query_id, rank, vec_id, score.

    Every query is sent to every shard: a stated query set against all rows. A task holds one shard's tree
    and ``BLOCK_ROWS`` queries.
    """
    rows = usable(vectors)
    facts = (rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max("norm").alias("most"))
             .orderBy(F.desc("n"), "d").first())
    if facts is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = max(1, -(-facts["n"] // SHARD_ROWS))
    rows = rows.where(F.size("embedding") == facts["d"]).select(F.col("vec_id").cast("long"), "embedding")
    none = F.lit(0).cast("long")
    data = rows.select("vec_id", "embedding", none.alias("variant"), F.lit(0).alias("asks"),
                       F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    # an id with several vectors asks once for each
    asked = (rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.collect_set("embedding").alias("own"))
             .select("vec_id", F.posexplode(F.array_sort("own")).alias("variant", "embedding"))
             .select("vec_id", "embedding", F.col("variant").cast("long"), F.lit(1).alias("asks"),
                     F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")))
    found = (data.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
             .mapInArrow(_search(k, relax, float(facts["most"])),
                         "query_id long, variant long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "variant").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
