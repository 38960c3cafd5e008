"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words whose smallest period ``q`` fits at least twice (and whose length
is at least ``least``) and that no neighbouring word extends. Texts of a slice are joined to one word
array, each closed by a separator of its own, so no run crosses texts.

* Prefix doubling sorts the suffixes; the ranks of every round name the words from a place on up to the
  next power of two, so a dyadic block's occurrences are one interval of the suffix array.
* A wavelet tree over the suffix array answers range successor: the first, the last and the number of the
  block's occurrences in a neighbouring window. A run of period ``q >= 7`` holds an aligned block of length
  ``b``, ``2b-1 <= q <= 4b-2``, together with its copy ``q`` words on; blocks of 4 at every second place do
  for all smaller periods, because a run has 12 words at least.
* Occurrences whose starts differ by less than ``b`` are an arithmetic progression. Up to two are candidates
  as they are. A longer one lies in a stretch with the block's own period: either that stretch holds the
  block as well (then no primitive period is found here), or the candidates are the shifts that lay the two
  stretches' ends or starts onto each other and, where the stretches touch, the progression's short members,
  which are runs themselves.
* Every candidate is extended both ways by the ranks (longest common extension) and kept if it is a run;
  of equal stretches the smallest period stays.

Work is n log n whatever the text repeats; memory is about four bytes per word for each power of two up to
the longest repeat in the slice. A text is never cut, so one long text is a slice of its own.

Defined cases: a null or empty text has no runs and an empty collapsed text; null ids, repeated rows and other
columns stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import WORD_PATTERN, as_strings, coded_words, shielded, slices

LEAST = 12
#: Words of the smallest block; ``least`` must hold three of them.
BLOCK_BITS = 2
#: Distances in which occurrences of the smallest block are looked for, at every second place.
SMALL_WINDOWS = ((1, 4), (5, 8), (9, 12), (13, 14))
RUN_DDL = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


class WaveletTree:
    """Counts and order statistics of ranges of a permutation, for many ranges at a time."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.before = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.before.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def _down(self, before, left, right, ones):
        left0, right0 = before[left], before[right]
        zeros = before[-1]
        return (np.where(ones, left - left0 + zeros, left0),
                np.where(ones, right - right0 + zeros, right0))

    def below(self, left, right, bound) -> np.ndarray:
        """How many values of [left, right) are smaller than ``bound``."""
        count = np.where(bound >> self.bits > 0, right - left, 0)
        bound = np.where(bound >> self.bits > 0, 0, bound)
        for depth, before in enumerate(self.before):
            ones = (bound >> (self.bits - 1 - depth)) & 1 == 1
            count += np.where(ones, before[right] - before[left], 0)
            left, right = self._down(before, left, right, ones)
        return count

    def nth(self, left, right, place) -> np.ndarray:
        """The value of rank ``place`` (from 0) in [left, right)."""
        value = np.zeros(len(left), np.int64)
        for before in self.before:
            zeros = before[right] - before[left]
            ones = place >= zeros
            place = np.where(ones, place - zeros, place)
            value = value << 1 | ones
            left, right = self._down(before, left, right, ones)
        return value


def suffix_ranks(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array and, for each power of two, the first place there of all suffixes that agree so far.

    The list ends before the power at which all suffixes differ. The last code must occur once.
    """
    suffixes = np.argsort(codes, kind="stable").astype(np.int64)
    ordered = codes[suffixes]
    places = np.arange(len(codes))
    first = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], places, 0))
    rank = np.empty(len(codes), np.int32)
    rank[suffixes] = first
    ranks, length = [], 1
    tied = places
    while True:
        first = rank[suffixes[tied]]
        equal = first[1:] == first[:-1]
        tied = tied[np.r_[False, equal] | np.r_[equal, False]] if len(tied) > 1 else tied[:0]
        if not len(tied):
            return suffixes, ranks
        ranks.append(rank)
        own = suffixes[tied]
        keys = rank[own].astype(np.int64) * len(codes) + rank[own + length]
        order = np.argsort(keys, kind="stable")
        own, keys = own[order], keys[order]
        suffixes[tied] = own
        fresh = np.r_[True, keys[1:] != keys[:-1]]
        rank = rank.copy()
        rank[own] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
        length *= 2


class Repeats:
    """Occurrences and common extensions inside one word array."""

    def __init__(self, codes: np.ndarray):
        self.suffixes, self.ranks = suffix_ranks(codes)
        self.tree = WaveletTree(self.suffixes) if len(self.ranks) > BLOCK_BITS else None

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on agree."""
        found = np.zeros(len(a), np.int64)
        for bit in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[bit]
            found += (rank[a + found] == rank[b + found]).astype(np.int64) << bit
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` agree."""
        found = np.zeros(len(a), np.int64)
        for bit in range(len(self.ranks) - 1, -1, -1):
            rank, low = self.ranks[bit], a - found - (1 << bit)
            same = (low >= 0) & (rank[np.maximum(low, 0)] == rank[np.maximum(b - a + low, 0)])
            found += same.astype(np.int64) << bit
        return found

    def stretch(self, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the longest stretch with ``period`` around ``place`` and its copy."""
        return (place - self.left(place, place + period),
                place + period + self.right(place, place + period))

    def candidates(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, period) pairs; among them every run of at most ``longest`` words."""
        for bits in range(BLOCK_BITS, len(self.ranks)):
            block = 1 << bits
            small = bits == BLOCK_BITS
            if not small and 2 * (2 * block - 1) > longest:
                return
            windows = SMALL_WINDOWS if small else ((2 * block - 1, 3 * block - 2), (3 * block - 1, 4 * block - 2))
            rank = self.ranks[bits]
            place = np.arange(0, len(rank), 2 if small else block)
            left = rank[place].astype(np.int64)
            right = left + np.bincount(rank, minlength=len(rank))[left]
            near = np.flatnonzero(right - left > 1)
            place, left, right = place[near], left[near], right[near]
            near = (self.tree.below(left, right, place + windows[-1][1] + 1)
                    > self.tree.below(left, right, place + windows[0][0]))
            place, left, right = place[near], left[near], right[near]
            for low, high in windows:
                yield from self._in_window(place, left, right, low, high)

    def _in_window(self, place, left, right, low, high):
        begin = self.tree.below(left, right, place + low)
        end = self.tree.below(left, right, place + high + 1)
        some = end > begin
        place, left, right, begin, end = place[some], left[some], right[some], begin[some], end[some]
        first = self.tree.nth(left, right, begin) - place
        number = end - begin
        if low == 1:  # a later occurrence so near only repeats the first one's period
            yield place, first
            return
        few = number <= 2
        yield place[few], first[few]
        more = number > 1
        last = self.tree.nth(left[more], right[more], end[more] - 1) - place[more]
        two = number[more] == 2
        yield place[more][two], last[two]
        last, place, first, number = last[~two], place[more][~two], first[more][~two], number[more][~two]
        step = (last - first) // (number - 1)
        begin1, end1 = self.stretch(place, step)
        begin2, end2 = self.stretch(place + first, step)
        other = begin1 != begin2
        place, first, last, step = place[other], first[other], last[other], step[other]
        by_begin, by_end = (begin2 - begin1)[other], (end2 - end1)[other]
        yield place, by_begin
        yield place, by_end
        touching = (end1 - begin2)[other]
        most = np.minimum(np.minimum(by_begin, by_end) + touching, last)
        members = np.where(touching >= 0, np.maximum((most - first) // step + 1, 0), 0)
        at = np.repeat(np.arange(len(place)), members)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(members) - members, members)
        yield place[at], first[at] + turn * step[at]


def find_runs(codes: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Columns begin, end, period of all runs, by begin and then period. The last code must occur once."""
    repeats = Repeats(codes)
    if repeats.tree is None:
        return np.empty((0, 3), np.int64)
    found = []
    for place, period in repeats.candidates(longest):
        fits = (period > 0) & (place + period < len(codes))
        place, period = place[fits], period[fits]
        begin, end = repeats.stretch(place, period)
        real = end - begin >= np.maximum(least, 2 * period)
        found.append(np.stack([begin[real], end[real], period[real]], 1))
    runs = np.unique(np.concatenate(found), axis=0)
    same = np.zeros(len(runs), bool)
    same[1:] = (runs[1:, :2] == runs[:-1, :2]).all(1)
    runs = runs[~same]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice_runs(texts: pa.Array, least: int) -> tuple[list, list]:
    """The runs and the collapsed text of each text."""
    codes, words, starts = coded_words(texts)
    count = len(texts)
    lengths = np.diff(starts)
    shift = np.arange(count)
    joined = np.empty(len(codes) + count, np.int32)
    closed = starts[1:] + shift
    joined[closed] = len(words) + shift
    inside = np.ones(len(joined), bool)
    inside[closed] = False
    joined[inside] = codes
    runs = find_runs(joined, int(lengths.max(initial=0)), least)
    begins = starts[:-1] + shift
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    depth = np.zeros(len(joined) + 1, np.int32)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    kept = (np.cumsum(depth[:-1]) == 0) & inside
    written = np.array(words.to_pylist() + [None], object)[np.minimum(joined, len(words))]
    collapsed = [" ".join(written[b:e][kept[b:e]]) for b, e in zip(begins, closed)]
    rows = [[] for _ in range(count)]
    for at, begin, end, period in zip(owner.tolist(), *runs.T.tolist()):
        start = int(begin - begins[at])
        rows[at].append({"start": start, "length": end - begin, "period": period})
    return rows, collapsed


def _run_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            at = 0
            for texts in slices(as_strings(batch["text"])):
                rows, collapsed = _slice_runs(texts, least)
                own = batch.slice(at, len(texts))
                at += len(texts)
                kept = [own.column(i) for i, n in enumerate(own.schema.names) if n != "text"]
                names = [n for n in own.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(rows, kind), pa.array(collapsed, pa.string())],
                    names=[*names, "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``shielded(docs)`` without the text, with ``runs`` (by start, then period) and ``collapsed``.

    ``collapsed`` joins by one space the words that no run holds after its first period. Starts count words
    from 0. Nothing is shuffled.
    """
    if least < 3 << BLOCK_BITS:
        raise ValueError(f"runs need {3 << BLOCK_BITS} words at least")
    docs = shielded(docs, "doc_id", "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(_run_batches(least), f"{kept}, {RUN_DDL}")


def with_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeats its own words from some word on.

    With h the CRC-32 of the decimal id, g = h // 10 and n words: if h % 10 = 0, word i >= a = g % n becomes
    word a + (i - a) % p with p = 1 + (n - a) // (3 + g % 8). A null id leaves its text alone.
    """
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    loops = (F.col("h") % 10 == 0) & F.col("text").rlike(WORD_PATTERN)
    placed = chosen.withColumn("w", F.when(loops, words)).withColumns({
        "n": F.size("w").cast("long"), "g": F.floor(F.col("h") / 10)})
    placed = placed.withColumn("a", F.when(loops, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    looped = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[int(a + (i - a) % p)])), ' ')")
    return placed.select("doc_id", F.when(loops, looped).otherwise(F.col("text")).alias("text"))
