"""Cross-tokenizer alignment by galloping intersection.

Two tokenizers cut the same bytes, a space and then the text. Each document's token ends are two rising
lists. The shorter one drives: every end doubles its step in the longer list until it is passed and then
halves back. Ends far apart go first, from the list's beginning; then those between, from where the one
before them was found, so steps stay as short as the lists' ratio asks. Ends found in both lists cut the
tokens into groups; differences of their ranks are the groups' ranges of tokens on either side, and all
tokens of a group are linked with each other.

How often two ids are linked is counted over all documents. Blocks of documents of bounded size are
tokenized once and written: per document its distinct linked pairs, and per block its distinct pairs with the
number of its documents. The latter, far fewer than the links, are summed up by pair; each block then gets the
counts of its own pairs back and looks its documents' links up in them. A pair that is in every document is
one row per block, a block's pairs are bounded by its size, and nothing is broadcast but the largest count
per id, one row per id of the first vocabulary.

Defined cases: a text that is null or empty, or whose tokens of either kind do not join to its bytes (the
second tokenizer may alter characters), has no tokens: zeros and an empty group text. Repeated rows and null ids
are documents of their own; other columns stay in ``_rest``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.packing import NOT_PLAIN
from tickloom.llm.text import as_strings, shielded, slices
from tickloom.session import scratch_path

#: Bytes of text whose documents ask for counts together.
BLOCK_BYTES = 24 << 20
#: Ends of the driving list apart that gallop together: the widest from the list's beginning, then those
#: between from where the one before them was found.
STRIDES = (64, 16, 4, 1)
STRIDE_RATIO = 4
#: Distinct text parts that a task keeps ids for before it starts anew.
KEPT_PARTS = 500_000
#: Token pairs of a group beyond which its ids are counted before they are paired.
WIDE_GROUP = 4096
#: Pairs that are expanded at a time.
PAIRS_AT_ONCE = 4_000_000


def byte_values() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 letters stand for themselves, the other bytes in order for the letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + turn): b for turn, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a byte-level vocabulary file and their bytes; no string in a text is special."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        value = byte_values()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.pieces = [b""] * self.tokenizer.get_vocab_size()
        for piece, at in vocabulary.items():
            self.pieces[at] = bytes(value.get(c, 0) for c in piece)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        coded = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in coded]


class PieceTokenizer:
    """Ids of a sentence-piece model, which puts a space before the text by itself, and their bytes.

    No piece holds a space after another character, so parts between spaces are cut alike on their own.
    """

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\u2581" in name.lstrip("\u2581") for name in names):
            raise ValueError("the model has pieces that reach over a space")
        self.pieces = [bytes([int(name[3:-1], 16)]) if self.model.is_byte(i)
                       else name.replace("\u2581", " ").encode() for i, name in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class KnownParts:
    """A tokenizer's ids for the parts of texts between spaces that were met before.

    A part stands for itself with a space before it; both tokenizers cut there.
    """

    def __init__(self, coder):
        self.coder = coder
        self.lengths = np.array([len(p) for p in coder.pieces], np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids, self.ends, self.right = np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, bool)

    def same_bytes(self, ids: list[int], text: str) -> bool:
        return b"".join([self.coder.pieces[i] for i in ids]) == b" " + text.encode()

    def learn(self, parts: list[str]) -> None:
        got = self.coder.encode(parts)
        right = [self.same_bytes(ids, part) for ids, part in zip(got, parts)]
        flat = np.fromiter(itertools.chain.from_iterable(got), np.int64)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.right = np.concatenate([self.right, np.array(right, bool)])

    def put_together(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts one after the other, and how many each has."""
        begins = self.ends[places]
        sizes = self.ends[places + 1] - begins
        return self.ids[spread(begins, sizes)], sizes


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... (sizes[0] of them), begins[1], ..."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def gallop(wanted: np.ndarray, start: np.ndarray, stop: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each ``wanted`` the first place in values[start:stop], rising, that is not below it.

    Steps double from ``start`` until the value is reached or passed; the last step is then halved.
    """
    low = start - 1
    high = start.copy()
    step = 1
    going = np.flatnonzero(high < stop)
    while len(going):
        going = going[values[high[going]] < wanted[going]]
        low[going] = high[going]
        high[going] = np.minimum(high[going] + step, stop[going])
        going = going[high[going] < stop[going]]
        step *= 2
    while True:
        open_ = np.flatnonzero(high - low > 1)
        if not len(open_):
            return high
        middle = (low[open_] + high[open_]) // 2
        under = values[middle] < wanted[open_]
        low[open_[under]] = middle[under]
        high[open_[~under]] = middle[~under]


def intersect(short: np.ndarray, first: np.ndarray, long: np.ndarray, start: np.ndarray,
              stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``short`` and ``long`` of the values in both.

    ``first``: place in ``short`` where the own list of each value begins; ``start``, ``stop``: that
    list's counterpart in ``long``.
    """
    place = start.copy()
    turn = np.arange(len(short)) - first
    for apart in STRIDES:
        wider = apart * STRIDE_RATIO
        some = np.flatnonzero((turn % apart == 0) & ((turn % wider != 0) | (apart == STRIDES[0])))
        back = turn[some] % wider if apart != STRIDES[0] else turn[some]
        place[some] = gallop(short[some], place[some - back], stop[some], long)
    inside = np.flatnonzero(place < stop)
    both = inside[long[place[inside]] == short[inside]]
    return both, place[both]


def common_ends(ends_a, starts_a, ends_b, starts_b) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common ends in both lists of all documents (``starts``: first place of each, and the end)."""
    counts_a, counts_b = np.diff(starts_a), np.diff(starts_b)
    found = []
    for a_drives in (True, False):
        chosen = (counts_a <= counts_b) == a_drives
        s, l, s_starts, l_starts = ((ends_a, ends_b, starts_a, starts_b) if a_drives
                                    else (ends_b, ends_a, starts_b, starts_a))
        owner = np.repeat(np.arange(len(chosen)), np.diff(s_starts))
        mine = np.flatnonzero(chosen[owner])
        owner = owner[mine]
        fewer = np.concatenate([[0], np.cumsum(np.diff(s_starts) * chosen)])[:-1]
        at, place = intersect(s[mine], fewer[owner], l, l_starts[owner], l_starts[owner + 1])
        found.append((mine[at], place) if a_drives else (place, mine[at]))
    in_a = np.concatenate([f[0] for f in found])
    in_b = np.concatenate([f[1] for f in found])
    order = np.argsort(in_a, kind="stable")
    return in_a[order], in_b[order]


def linked_pairs(a: np.ndarray, b: np.ndarray, owner: np.ndarray, begin_a, size_a, begin_b, size_b,
                 sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair) of all groups with the number of links: owner, a * sizes[1] + b, links.

    Groups are expanded some at a time. In a wide group the distinct ids are paired, with the product
    of their numbers.
    """
    space = sizes[0] * sizes[1]
    area = size_a * size_b
    wide = area > WIDE_GROUP
    found = []
    for at in np.flatnonzero(wide):
        ids_a, times_a = np.unique(a[begin_a[at]:begin_a[at] + size_a[at]], return_counts=True)
        ids_b, times_b = np.unique(b[begin_b[at]:begin_b[at] + size_b[at]], return_counts=True)
        keys = owner[at] * space + (ids_a[:, None] * sizes[1] + ids_b)
        found.append((keys.ravel(), np.outer(times_a, times_b).ravel()))
    narrow = np.flatnonzero(~wide)
    until = np.cumsum(area[narrow])
    begin = 0
    while begin < len(narrow):
        done = until[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(until, done + PAIRS_AT_ONCE, side="right")))
        some = narrow[begin:end]
        begin = end
        left = np.repeat(spread(begin_a[some], size_a[some]), np.repeat(size_b[some], size_a[some]))
        right = spread(np.repeat(begin_b[some], size_a[some]), np.repeat(size_b[some], size_a[some]))
        keys = np.sort(np.repeat(owner[some] * space, area[some]) + a[left] * sizes[1] + b[right])
        fresh = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        found.append((keys[fresh], np.diff(np.r_[fresh, len(keys)])))
    if not found:
        return (np.empty(0, np.int64),) * 3
    keys, links = (np.concatenate(x) for x in zip(*found))
    if len(found) > 1:
        order = np.argsort(keys, kind="stable")
        keys, links = keys[order], links[order]
        fresh = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, links = keys[fresh], np.add.reduceat(links, fresh)
    own, pairs = np.divmod(keys, space)
    return own, pairs, links


class Aligner:
    """Groups and links of texts under two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.coders = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.known = [KnownParts(c) for c in self.coders]
        self.sizes = tuple(len(c.pieces) for c in self.coders)
        self.place: dict[str, int] = {}
        written = [[str(i) for i in range(n)] for n in self.sizes]
        self.written = [(np.array([w + "," for w in names], object), np.array([w + close for w in names], object))
                        for names, close in zip(written, "|;")]

    def _places(self, parts: list[str]) -> np.ndarray:
        """Where the parts' ids are kept; new parts are tokenized."""
        new = [p for p in parts if p not in self.place]
        if len(self.place) + len(new) > KEPT_PARTS:
            self.place = {}
            new = parts
            for known in self.known:
                known.forget()
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            for known in self.known:
                known.learn(new)
        return np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))

    def tokens(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tokenizer the ids of all texts and where each text's begin; unequal texts have none."""
        spaced = pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type))
        whole = np.asarray(pc.match_substring_regex(spaced, NOT_PLAIN))
        plain = pc.split_pattern(texts, " ")
        coded = plain.flatten().dictionary_encode()
        starts = np.asarray(plain.offsets).astype(np.int64)
        counts = np.where(whole, 0, np.diff(starts))
        codes = np.asarray(coded.indices)[spread((starts[:-1] - starts[0]), counts)]
        needed = np.unique(codes)
        places = np.zeros(len(coded.dictionary), np.int64)
        places[needed] = self._places(coded.dictionary.take(pa.array(needed)).to_pylist())
        places = places[codes]
        owner = np.repeat(np.arange(len(texts)), counts)
        right = np.ones(len(texts), bool)
        for known in self.known:
            right[owner[~known.right[places]]] = False
        odd = np.flatnonzero(whole & (np.asarray(pc.binary_length(texts)) > 0))
        odd_texts = texts.take(pa.array(odd)).to_pylist()
        odd_ids = [known.coder.encode(odd_texts) for known in self.known]
        for known, own in zip(self.known, odd_ids):
            right[odd] &= np.array([known.same_bytes(ids, t) for ids, t in zip(own, odd_texts)], bool)
        places = places[right[owner]]
        owner = owner[right[owner]]
        out = []
        for known, own in zip(self.known, odd_ids):
            ids, sizes = known.put_together(places)
            total = np.bincount(owner, sizes, len(texts)).astype(np.int64)
            begins = np.cumsum(total) - total
            kept = [i for i, at in zip(own, odd) if right[at]]
            lengths = np.array([len(i) for i in kept], np.int64)
            total[odd[right[odd]]] = lengths
            begins[odd[right[odd]]] = len(ids) + np.cumsum(lengths) - lengths
            ids = np.concatenate([ids, *[np.array(i, np.int64) for i in kept]])
            out.append((ids[spread(begins, total)], np.concatenate([[0], np.cumsum(total)])))
        return out

    def align(self, texts: pa.Array) -> dict:
        """Tokens, groups and links of each text."""
        (a, starts_a), (b, starts_b) = self.tokens(texts)
        ends_a, ends_b = (np.cumsum(k.lengths[ids]) for k, ids in zip(self.known, (a, b)))
        in_a, in_b = common_ends(ends_a, starts_a, ends_b, starts_b)
        begin_a, begin_b = np.r_[0, in_a[:-1] + 1][:len(in_a)], np.r_[0, in_b[:-1] + 1][:len(in_b)]
        size_a, size_b = in_a + 1 - begin_a, in_b + 1 - begin_b
        owner = np.searchsorted(starts_a, in_a, side="right") - 1
        links = linked_pairs(a, b, owner, begin_a, size_a, begin_b, size_b, self.sizes)
        groups = np.bincount(owner, minlength=len(texts))
        return {"n_a": np.diff(starts_a), "n_b": np.diff(starts_b), "n_groups": groups,
                "n_links": np.bincount(owner, size_a * size_b, len(texts)).astype(np.int64),
                "groups": self._written(a, starts_a, b, in_a, in_b, size_a, size_b), "links": links}

    def _written(self, a, starts_a, b, in_a, in_b, size_a, size_b) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        out = np.empty(len(a) + len(b), object)
        shift_a = np.repeat(np.cumsum(size_b) - size_b, size_a)
        shift_b = np.repeat(np.cumsum(size_a), size_b)
        for ids, last, shift, (inner, closing) in ((a, in_a, shift_a, self.written[0]), (b, in_b, shift_b, self.written[1])):
            words = inner[ids]
            words[last] = closing[ids[last]]
            out[np.arange(len(ids)) + shift] = words
        group = np.searchsorted(in_a, starts_a)
        cuts = np.concatenate([[0], np.cumsum(size_a + size_b)])[group]
        return ["".join(out[s:e])[:-1] for s, e in zip(cuts, cuts[1:])]


ALIGNED_DDL = "n_a long, n_b long, n_groups long, n_links long, groups string"
BLOCK_DDL = "block long, pairs array<long>, tallies array<long>, links binary, weights binary"


def _align_blocks(path_a: str, path_b: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        key = "<u4" if math.prod(aligner.sizes) < 1 << 32 else "<u8"
        task = TaskContext.get().partitionId() << 32
        block, size, seen, schema = 0, 0, [], None

        def summary():
            pairs, tallies = np.unique(np.concatenate(seen), return_counts=True)
            empty = [pa.nulls(1, f.type) for f in schema][:-5]
            return pa.RecordBatch.from_arrays(
                [*empty, pa.array([task + block]), pa.array([pairs], pa.list_(pa.int64())),
                 pa.array([tallies], pa.list_(pa.int64())), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())],
                schema=schema)

        for batch in batches:
            texts, at = as_strings(batch["text"]), 0
            kept = [n for n in batch.schema.names if n != "text"]
            for some in slices(texts):
                got = aligner.align(some)
                own, pairs, weights = got["links"]
                cuts = np.searchsorted(own, np.arange(len(some) + 1))
                seen.append(pairs)
                groups = got["groups"]
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                packed = [[x[s:e].tobytes() for s, e in zip(cuts, cuts[1:])]
                          for x in (pairs.astype(key), weights.astype("<u4"))]
                none = pa.nulls(len(some), pa.list_(pa.int64()))
                rows = batch.slice(at, len(some))
                at += len(some)
                result = pa.RecordBatch.from_arrays(
                    [*[rows[n] for n in kept], *[pa.array(got[n]) for n in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(groups, pa.string()), pa.array(np.full(len(some), task + block)), none, none,
                     *[pa.array(x, pa.binary()) for x in packed]],
                    names=[*kept, "n_a", "n_b", "n_groups", "n_links", "groups",
                           "block", "pairs", "tallies", "links", "weights"])
                schema = result.schema
                yield result
                size += some.nbytes
                if size >= BLOCK_BYTES:
                    yield summary()
                    block, size, seen = block + 1, 0, []
        if seen:
            yield summary()
    return run


def _look_up(kept: list[str]):
    """Per document the sums over its links, from the block's counts."""
    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        pairs = counts["pair"].to_numpy()
        order = np.argsort(pairs)
        pairs = pairs[order]
        tally = counts["tally"].to_numpy()[order]
        best = counts["best"].to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for links, weights in zip(docs["links"].to_pylist(), docs["weights"].to_pylist()):
            weight = np.frombuffer(weights, "<u4").astype(np.int64)
            own = np.searchsorted(pairs, np.frombuffer(links, "<u4" if len(links) == len(weights) else "<u8"))
            n_best.append(int(weight[best[own]].sum()))
            count_sum.append(int((weight * tally[own]).sum()))
        return docs.select(kept).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64()))
    return run


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, digest: bool = False) -> DataFrame:
    """``shielded(docs)`` without the text, with token, group and link figures per document.

    Adds ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3`` with decimal ids, or its
    SHA-256 in hex if ``digest``; empty without tokens), ``n_best`` (links whose pair is in as many documents as
    any of its first id) and ``count_sum`` (over links, the documents that hold the pair). The paths must be
    readable on every executor.
    """
    spark = docs.sparkSession
    docs = shielded(docs, "doc_id", "text")
    kept = [f for f in docs.schema if f.name != "text"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    path = scratch_path(spark, "aligned")
    docs.mapInArrow(_align_blocks(byte_vocabulary, piece_model, digest),
                    f"{ddl}, {ALIGNED_DDL}, {BLOCK_DDL}").write.parquet(path)

    asked = spark.read.parquet(path).where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("pairs", "tallies")).alias("p")).select("block", "p.pairs", "p.tallies")
    radix = _piece_count(piece_model)
    counts = asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("tallies").alias("tally")).withColumn(
        "id", F.expr(f"pair div {radix}"))
    largest = counts.groupBy(F.col("id").alias("of")).agg(F.max("tally").alias("most"))
    judged = counts.join(F.broadcast(largest), F.col("id") == F.col("of")).select(
        "pair", "tally", (F.col("tally") == F.col("most")).alias("best"))
    answers = asked.select("block", "pairs").join(judged, F.col("pairs") == F.col("pair")).select(
        "block", "pair", "tally", "best")

    names = [*[f.name for f in kept], "n_a", "n_b", "n_groups", "n_links", "groups"]
    rows = spark.read.parquet(path).where("pairs IS NULL").select(*names, "block", "links", "weights")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _look_up(names), f"{ddl}, {ALIGNED_DDL}, n_best long, count_sum long")


def _piece_count(path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
