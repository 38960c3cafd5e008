"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing: p(w | h) = (c(hw) + MU p(w | h')) / (c(h) + MU),
where h' is h without its first word, ending at p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). All n-grams of the
training documents count; nothing is cut off. As an automaton: a state is a known context, an arc from h
by w weighs log10 p(w | h) for a known hw and leads to the longest known suffix of hw, and a failure arc
from h to h' weighs log10 MU / (c(h) + MU). A text is read once from left to right; its state is carried
and the weights of arcs and failure arcs add up.

The automaton of a large corpus fits no machine, so each block of documents gets the part that its own
texts can reach: a block sends its distinct n-gram hashes, sorted and as differences, to buckets by hash; a
bucket adds up the training counts and answers each block in the order of its question; the block builds its
states and arcs from the answers and reads its texts, a slice of them at a time. Words and pairs are asked first, and the answer also says
whether another block holds the n-gram. A longer n-gram is in another block only if both n-grams one shorter
inside it are, so only those are asked for; the count of any other is the block's own. Words and n-grams are
known by 64-bit hashes.

Defined cases: a null or empty text is its end alone; a null ``doc_id`` counts as the empty id; repeated
rows are documents each; without training documents every token has the probability of an unknown one.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.neardup import mixed
from tickloom.llm.text import as_strings, lowered_words, parts_for, text_bytes, tidied_cogroup, tidied_group

ORDER = 3
MU = 1_000.0
FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 10 << 20
BUCKET_BYTES = 4 << 20
LANE = 512
SLICE_TOKENS = 1 << 19  # an automaton is built for whole texts of about so many tokens

_A = np.uint64(0x9E3779B97F4A7C15)
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(b""))
BEGIN_HASH = np.uint64(xxhash.xxh3_64_intdigest(b" "))  # no word holds a space

GRAMS_DDL = "bucket int, level int, block int, keys binary, counts binary"
ANSWERS_DDL = "block int, level int, bucket int, n int, counts binary, shared binary"
GRAMS_SCHEMA = pa.schema([("bucket", pa.int32()), ("level", pa.int32()), ("block", pa.int32()),
                          ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERS_SCHEMA = pa.schema([("block", pa.int32()), ("level", pa.int32()), ("bucket", pa.int32()),
                            ("n", pa.int32()), ("counts", pa.binary()), ("shared", pa.binary())])


def pack_keys(keys: np.ndarray) -> bytes:
    """The first of rising keys, then differences of as many bytes as the largest needs; the first byte tells how many."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    short = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + short.tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    width = packed[0]
    short = np.frombuffer(packed, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(short) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(packed, np.uint8, 8, 1)
    steps[1:, :width] = short
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def rising(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in rising order, and the keys in that order.

    The places stand in the low bits of what is sorted, which is much faster than ``argsort``. Keys without room
    for them lose their low bits; if any come out of order then, ``argsort`` is taken.
    """
    keys, bits = keys.astype(np.uint64, copy=False), len(keys).bit_length()
    room = min(bits, 64 - int(keys.max(initial=0)).bit_length())
    low = np.uint64((1 << bits) - 1)
    order = keys << np.uint64(room)
    order &= ~low
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.view(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys)
        ordered = keys[order]
    return order, ordered


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and the number of every key among them."""
    order, ordered = rising(keys)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return ordered[fresh], order[fresh].astype(np.int32), number


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count; those from 255 on follow as four bytes each."""
    return (np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u4").tobytes())


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, "<u4", offset=n)
    return counts


def word_hashes(words: pa.Array) -> np.ndarray:
    """The hash of each word's UTF-8 bytes."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1].tolist()
    data = memoryview(data) if data else b""
    return np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in pairwise(ends)), np.uint64, len(words))


class Tokens:
    """The tokens of some texts (words, then an end each) as hashes, and the n-grams that end at each."""

    def __init__(self, texts: pa.Array, order: int):
        codes, words, starts = lowered_words(texts)
        own = word_hashes(words)
        docs = np.arange(len(starts) - 1)
        self.starts = starts + np.arange(len(starts))
        ends = self.starts[1:] - 1
        self.hashes = np.empty(len(codes) + len(docs), np.uint64)
        word_spots = np.ones(len(self.hashes), bool)
        word_spots[ends] = False
        self.hashes[word_spots] = own[codes]
        self.hashes[ends] = END_HASH
        self.place = np.arange(len(self.hashes)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        self.order = order

    def cut(self, first: int, last: int) -> Tokens:
        """The tokens of the texts from ``first`` to before ``last``."""
        part = object.__new__(Tokens)
        begin, end = self.starts[first], self.starts[last]
        part.starts = self.starts[first:last + 1] - begin
        part.hashes, part.place, part.order = self.hashes[begin:end], self.place[begin:end], self.order
        return part

    def slices(self) -> list[tuple[int, int]]:
        """First and last text of consecutive runs of about ``SLICE_TOKENS`` tokens, a text at least."""
        runs, first, texts = [], 0, len(self.starts) - 1
        while first < texts:
            last = int(np.searchsorted(self.starts, self.starts[first] + SLICE_TOKENS, side="right")) - 1
            runs.append((first, max(first + 1, last)))
            first = runs[-1][1]
        return runs

    def keys(self, level: int) -> np.ndarray:
        """Hash of the n-gram of ``level`` tokens that ends at each token, counting one begin mark.

        Defined where ``place >= level - 2``.
        """
        with np.errstate(over="ignore"):
            keys = mixed(self.hashes)
            for _ in range(1, level):
                before = np.concatenate([[BEGIN_KEY], keys[:-1]])
                before[self.place == 0] = BEGIN_KEY
                keys = mixed(before * _A + self.hashes)
        return keys


BEGIN_KEY = mixed(np.array([BEGIN_HASH]))[0]


class Level:
    """The distinct n-grams of one length in a block: sorted keys, where each is, its count in the block."""

    def __init__(self, tokens: Tokens, level: int, taught: np.ndarray, begins: int):
        self.level = level
        self.there = np.flatnonzero(tokens.place >= level - 2).astype(np.int32)
        keys, weights = tokens.keys(level)[self.there], taught[self.there]
        if level == 1:  # the begin mark is a context as often as documents teach
            keys, weights = np.append(keys, BEGIN_KEY), np.append(weights, begins)
        self.keys, self.some, self.at = distinct_keys(keys)
        self.counts = np.bincount(self.at, weights=weights, minlength=len(self.keys)).astype(np.int64)
        self.asked = np.ones(len(self.keys), bool)
        self.shared = np.zeros(len(self.keys), bool)

    def cut(self, part: Tokens, begin: int, end: int) -> Level:
        """The n-grams that end at the tokens from ``begin`` to before ``end``, whose tokens are ``part``; no keys."""
        cut = object.__new__(Level)
        cut.level = self.level
        cut.there = np.flatnonzero(part.place >= self.level - 2).astype(np.int32)
        first, last = np.searchsorted(self.there, [begin, end])
        at = self.at[first:last]
        if self.level == 1:  # the begin mark
            at = np.append(at, self.at[-1])
        used = np.zeros(len(self.counts), bool)
        used[at] = True
        cut.counts = self.counts[used]
        cut.at = (np.cumsum(used, dtype=np.int32) - 1)[at]
        cut.some = np.empty(len(cut.counts), np.int32)
        cut.some[cut.at] = np.arange(len(at), dtype=np.int32)
        return cut

    def spread(self, tokens: Tokens) -> np.ndarray:
        """Place in ``keys`` of the n-gram that ends at each token; -1 where there is none."""
        whole = np.full(len(tokens.hashes), -1, np.int32)
        whole[self.there] = self.at[:len(self.there)]
        return whole

    def ask_if_shared(self, tokens: Tokens, shorter: Level) -> None:
        """Ask only for n-grams whose both shorter ones are in another block."""
        spot, at = self.there[self.some], shorter.spread(tokens)
        self.asked = shorter.shared[at[spot]] & shorter.shared[at[spot - 1]]

    def take(self, rows: list[dict]) -> None:
        """Put the answers in, which come in the order of the keys."""
        rows = sorted(rows, key=lambda r: r["bucket"])
        if rows and rows[0]["counts"] is not None:
            self.counts[self.asked] = np.concatenate([unpack_counts(r["counts"], r["n"]) for r in rows])
        if rows:
            self.shared[self.asked] = np.concatenate(
                [np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=r["n"]) for r in rows]).astype(bool)


def _levels(block: pa.Table, order: int, answers: list[dict]) -> tuple[Tokens, list[Level]]:
    """A block's n-grams up to ``order``, with the answers that are there; the last level may still be open."""
    tokens = Tokens(as_strings(block["text"]), order)
    learns = ~np.asarray(block["held_out"].to_pylist(), bool)
    taught = np.repeat(learns, np.diff(tokens.starts))
    levels = []
    for number in range(1, order + 1):
        level = Level(tokens, number, taught, int(learns.sum()))
        if number > 2:
            level.ask_if_shared(tokens, levels[-1])
        level.take([r for r in answers if r["level"] == number])
        levels.append(level)
    return tokens, levels


def _asking(levels: list[Level], block: int, bits: int) -> pa.Table:
    """Rows that ask for the open n-grams, cut by bucket."""
    rows = []
    for level in levels:
        keys, counts = level.keys[level.asked], level.counts[level.asked]
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            if end > begin:
                rows.append({"bucket": int(bucket[begin]), "level": level.level, "block": block,
                             "keys": pack_keys(keys[begin:end]), "counts": pack_counts(counts[begin:end])})
    return pa.Table.from_pylist(rows, schema=GRAMS_SCHEMA)


def _grams(order: int, bits: int):
    def run(block: pa.Table) -> pa.Table:
        """The distinct words and pairs of a block with their training counts."""
        return _asking(_levels(block, min(order, 2), [])[1], block["block"][0].as_py(), bits)
    return run


def _longer(level: int, bits: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        """The distinct n-grams of ``level`` tokens that may be in another block."""
        if not block.num_rows:
            return GRAMS_SCHEMA.empty_table()
        return _asking(_levels(block, level, answers.to_pylist())[1][-1:], block["block"][0].as_py(), bits)
    return run


def _sums(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Distinct keys of packed rows, their summed counts, the place of every packed key in them, keys a row."""
    unpacked = [unpack_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in unpacked]
    counts = np.concatenate([unpack_counts(r["counts"], n) for r, n in zip(rows, sizes)])
    distinct, _, inverse = distinct_keys(np.concatenate(unpacked))
    return distinct, np.bincount(inverse, weights=counts, minlength=len(distinct)), inverse, sizes


def _answer(bucket: pa.Table) -> pa.Table:
    """For each block, the training counts of the n-grams it asked for, in its order, and which others hold too."""
    found, rows = [], bucket.to_pylist()
    for level in sorted({r["level"] for r in rows}):
        asked = [r for r in rows if r["level"] == level]
        _, totals, inverse, sizes = _sums(asked)
        shared = (np.bincount(inverse) > 1)[inverse]  # a block asks once for each
        answers = totals[inverse].astype(np.int64)
        at = 0
        for row, size in zip(asked, sizes):
            found.append({"block": row["block"], "level": level, "bucket": row["bucket"], "n": size,
                          "counts": pack_counts(answers[at:at + size]),
                          "shared": np.packbits(shared[at:at + size]).tobytes()})
            at += size
    return pa.Table.from_pylist(found, schema=ANSWERS_SCHEMA)


def _size(bucket: pa.Table) -> pa.Table:
    """Training tokens and distinct training tokens of a bucket."""
    rows = [r for r in bucket.to_pylist() if r["level"] == 1]
    n = v = 0
    if rows:
        keys, totals, _, _ = _sums(rows)
        token = keys != BEGIN_KEY
        n, v = int(totals[token].sum()), int((totals[token] > 0).sum())
    return pa.table({"n": pa.array([n], pa.int64()), "v": pa.array([v], pa.int64())})


class Automaton:
    """States and arcs that the n-grams of some tokens can reach.

    ``levels``: the distinct n-grams with their training counts.
    """

    def __init__(self, tokens: Tokens, levels: list[Level], n: int, v: int, mu: float):
        order = tokens.order
        counts = [level.counts.astype(np.float64) for level in levels]
        self.base_total = n + 0.5 * (v + 1)
        begin_word, self.word = levels[0].at[-1], levels[0].at[:-1]
        self.width = len(counts[0])
        self.word_count = counts[0]
        chance = (counts[0] + 0.5) / self.base_total
        self.word_log = np.log10(chance)
        # level 1: node of a known word, arcs from the root
        known = counts[0] > 0
        node_of = np.where(known, np.cumsum(known), 0)  # 0: the root
        nodes = int(known.sum()) + 1
        fail, held = [np.zeros(nodes, np.int64)], [np.concatenate([[0.0], counts[0][known]])]
        words_known = np.flatnonzero(known)
        arcs, weights = [words_known], [self.word_log[words_known]]
        targets = [node_of[words_known] if order > 1 else np.zeros(len(words_known), np.int64)]
        lower_node, lower_chance, lower_at = node_of, chance, self.word
        self.start = int(node_of[begin_word]) if order > 1 else 0
        begin_count = counts[0][begin_word]
        for level in range(2, order + 1):
            own = levels[level - 1]
            spot, count = own.there[own.some], counts[level - 1]
            suffix = lower_at[spot]
            at_begin = tokens.place[spot] == level - 2  # its context starts with the begin mark
            if level == 2:
                context_node = np.where(at_begin, self.start, lower_node[lower_at[spot - 1]])
                context_count = np.where(at_begin, begin_count, lower_count(counts[0], lower_at, spot))
            else:
                context_node = lower_node[lower_at[spot - 1]]
                context_count = counts[level - 2][lower_at[spot - 1]]
            here = (count + mu * lower_chance[suffix]) / (context_count + mu)
            known = count > 0
            node = np.zeros(len(count), np.int64)
            if level < order:
                node[known] = nodes + np.arange(int(known.sum()))
                nodes += int(known.sum())
                fail.append(lower_node[suffix[known]])
                held.append(count[known])
            arcs.append(context_node[known] * self.width + self.word[spot[known]])
            weights.append(np.log10(here[known]))
            targets.append(node[known] if level < order else lower_node[suffix[known]])
            lower_node, lower_chance, lower_at = node, here, own.spread(tokens)
        arcs = np.concatenate(arcs)
        order_, arcs = rising(arcs)
        self.arcs = arcs.astype(np.int64)
        self.weights, self.targets = np.concatenate(weights)[order_], np.concatenate(targets)[order_]
        self.fail = np.concatenate(fail)
        self.fail_log = np.log10(mu / (np.concatenate(held) + mu))
        self.unknown_log = np.log10(0.5 / self.base_total)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state of each lane and the weight of its way there."""
        state, weight = state.copy(), np.zeros(len(state))
        todo = np.arange(len(state))
        while len(todo):
            wanted = state[todo] * self.width + word[todo]
            at = np.empty(len(wanted), np.int64)
            by = np.argsort(wanted)  # near arcs are looked up one after the other
            at[by] = np.searchsorted(self.arcs, wanted[by])
            at = np.minimum(at, max(len(self.arcs) - 1, 0))
            hit = self.arcs[at] == wanted if len(self.arcs) else np.zeros(len(todo), bool)
            weight[todo[hit]] += self.weights[at[hit]]
            state[todo[hit]] = self.targets[at[hit]]
            todo = todo[~hit]
            lost = state[todo] == 0
            weight[todo[lost]] += self.unknown_log
            todo = todo[~lost]
            weight[todo] += self.fail_log[state[todo]]
            state[todo] = self.fail[state[todo]]
        return state, weight

    def read(self, starts: np.ndarray, order: int) -> np.ndarray:
        """The log10 probability of each text, read from left to right.

        Long texts are read in lanes; a lane begins ``order - 1`` tokens early from the root, after which
        it is in the state of the whole text, since states are no longer than that.
        """
        lengths = np.diff(starts)
        lanes = np.maximum(1, -(-lengths // LANE))
        doc = np.repeat(np.arange(len(lengths)), lanes)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        own = starts[doc] + number * LANE
        stop = np.minimum(own + LANE, starts[doc + 1])
        begin = np.where(number > 0, np.maximum(own - (order - 1), starts[doc]), own)
        by_length = np.argsort(-(stop - begin), kind="stable")
        doc, own, stop, begin = doc[by_length], own[by_length], stop[by_length], begin[by_length]
        span = stop - begin
        state = np.where(begin == starts[doc], self.start, 0)
        total = np.zeros(len(doc))
        active = len(doc)
        for t in range(int(span[0]) if len(span) else 0):
            while active and span[active - 1] <= t:
                active -= 1
            spot = begin[:active] + t
            state[:active], weight = self.step(state[:active], self.word[spot])
            total[:active] += np.where(spot >= own[:active], weight, 0.0)
        return np.bincount(doc, total, len(lengths))


def lower_count(counts: np.ndarray, at: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Count of the token before each spot (of any token where there is none)."""
    return counts[at[spot - 1]]


SCORES = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(order: int, mu: float):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"doc_id": block["doc_id"], **{n: pa.array([], k) for n, k in (
                ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))}})
        rows = answers.to_pylist()
        n, v = rows[0]["size"]["n"], rows[0]["size"]["v"]
        tokens, levels = _levels(block, order, rows)
        del rows, answers
        for level in levels:  # the automaton needs the counts alone
            level.keys = level.some = level.asked = level.shared = None
            level.counts = level.counts.astype(np.min_scalar_type(level.counts.max(initial=0)))
        known, base, whole = [], [], []
        for first, last in tokens.slices():
            part = tokens.cut(first, last)
            grams = [level.cut(part, tokens.starts[first], tokens.starts[last]) for level in levels]
            automaton = Automaton(part, grams, n, v, mu)
            sums = lambda x: np.add.reduceat(x, part.starts[:-1])  # noqa: B023, E731  every text has a token
            known.append(sums((automaton.word_count > 0)[automaton.word].astype(np.int64)))
            base.append(sums(automaton.word_log[automaton.word]))
            whole.append(automaton.read(part.starts, order))
            del part, grams, automaton
        return pa.table({
            "doc_id": block["doc_id"], "held_out": block["held_out"],
            "n_tokens": pa.array(np.diff(tokens.starts)),
            "n_known": pa.array(np.concatenate(known)),
            "train_tokens": pa.array(np.full(block.num_rows, n, np.int64)),
            "base_score": pa.array(np.concatenate(base)),
            "score": pa.array(np.concatenate(whole))})
    return run


def score(docs: DataFrame, order: int = ORDER, mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all rows of ``docs``.

    The blocks' texts and their packed n-grams are each shuffled once (their exchanges are reused); the answers
    about words and pairs, which longer n-grams and the scores both need, are made twice from the same exchange.
    """
    total = text_bytes(docs)
    blocks = parts_for(total, BLOCK_BYTES)
    bits = (parts_for(total, BUCKET_BYTES) - 1).bit_length()
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = F.crc32(name.cast("binary")) % FOLDS == HELD_OUT
    dealt = docs.select("doc_id", "text", held.alias("held_out"), F.pmod(
        F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    grams = dealt.groupBy("block").applyInArrow(tidied_group(_grams(order, bits)), GRAMS_DDL)
    sizes = grams.groupBy("bucket").applyInArrow(tidied_group(_size), "n long, v long").agg(
        F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).alias("s"))
    answers = grams.groupBy("bucket").applyInArrow(tidied_group(_answer), ANSWERS_DDL)
    for level in range(3, order + 1):
        told = answers.withColumn("counts", F.lit(None).cast("binary"))  # only which n-grams others hold
        asked = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
            tidied_cogroup(_longer(level, bits)), GRAMS_DDL)
        answers = answers.unionByName(asked.groupBy("bucket").applyInArrow(tidied_group(_answer), ANSWERS_DDL))
    answers = answers.withColumn("size", sizes.scalar())
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        tidied_cogroup(_score(order, mu)), f"doc_id {kind}, {SCORES}")
