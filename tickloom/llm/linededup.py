"""Line dedup through sharded minimal perfect hash arrays.

A line's key is the line stripped of ASCII white space at both ends, A-Z lower-cased. Documents are dealt
into blocks of bounded size. Each block sends the distinct 128-bit hashes of its keys, packed per shard,
with the number of its documents that hold them. A shard builds a minimal perfect hash over its distinct
hashes (levels of bit arrays; a key's slot is the rank of its bit) that indexes two compact arrays:
fingerprints of 32 bits and document counts. The blocks' packed hashes then probe those arrays, and what
is frequent goes back to the block, which drops the lines. Lines themselves are never joined or shuffled.

The arrays hold every key that is probed here, so answers are exact; a key that is foreign to an index
(``ShardIndex.counts`` on other texts) is taken for a member once in 2**32.

Defined cases: a null or empty text has one empty line; an empty key is never frequent; each row is a
document, repeated rows too; a line repeated inside a document counts once; other columns are kept
in ``_rest`` (see ``text.restored``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.text import as_strings, parts_for, shielded, text_bytes

MIN_DOCS = 10
BLOCK_BYTES = 8 << 20
#: Text per shard; a shard's distinct hashes (16 bytes each) are a small part of it.
SHARD_BYTES = 32 << 20
SLOTS_PER_KEY = 2.0
MAX_LEVELS = 64

HASH = np.dtype([("hi", "<u8"), ("lo", "<u8")])
LINES_DDL = "shard int, block int, hashes binary, docs binary"
INDEX_DDL = "shard int, n long, levels array<binary>, sizes array<long>, prints binary, counts binary"
HITS_DDL = "block int, hashes binary"


def line_keys(text: str) -> list[bytes]:
    return [line.strip() for line in text.encode().lower().split(b"\n")]


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of each key for each level."""
    with np.errstate(over="ignore"):
        x = hashes["hi"] + hashes["lo"] * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))


class ShardIndex:
    """Minimal perfect hash of one shard with its fingerprint and count arrays."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, tallies: np.ndarray):
        self.levels, self.prints, self.tallies = levels, prints, tallies
        self.before, self.ranks, seen = [], [], 0
        for bits in levels:
            self.before.append(seen)
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - bits)
            seen += int(bits.sum())

    @classmethod
    def build(cls, hashes: np.ndarray, tallies: np.ndarray) -> ShardIndex:
        """``hashes``: distinct keys. Keys that meet alone on a level own their bit; the others go on."""
        levels, left = [], hashes
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("the same hash was given twice")
            size = max(64, int(len(left) * SLOTS_PER_KEY))
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        index = cls(levels, np.empty(0, np.uint32), np.empty(0, np.uint32))
        slots = index.slots(hashes)
        prints, counts = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), tallies.dtype)
        prints[slots] = hashes["lo"].astype("<u4")
        counts[slots] = tallies
        index.prints, index.tallies = prints, counts
        return index

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit."""
        found = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = (_mixed(hashes[todo], level) % np.uint64(len(bits))).astype(np.int64)
            own = bits[at]
            found[todo[own]] = self.before[level] + self.ranks[level][at[own]]
            todo = todo[~own]
        return found

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Documents that hold each key; 0 for keys that are not in the index."""
        slots = self.slots(hashes)
        out = np.zeros(len(hashes), np.int64)
        there = np.flatnonzero(slots >= 0)
        there = there[self.prints[slots[there]] == hashes["lo"][there].astype("<u4")]
        out[there] = self.tallies[slots[there]]
        return out

    def row(self, shard: int) -> dict:
        return {"shard": shard, "n": len(self.prints),
                "levels": [np.packbits(bits).tobytes() for bits in self.levels],
                "sizes": [len(bits) for bits in self.levels],
                "prints": self.prints.tobytes(), "counts": self.tallies.astype("<u4").tobytes()}

    @classmethod
    def from_row(cls, row: dict) -> ShardIndex:
        levels = [np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
                  for bits, size in zip(row["levels"], row["sizes"])]
        return cls(levels, np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["counts"], "<u4"))


def _as_table(rows: list[dict], like: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=like)


LINES_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary())])
INDEX_SCHEMA = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("levels", pa.list_(pa.binary())),
                          ("sizes", pa.list_(pa.int64())), ("prints", pa.binary()), ("counts", pa.binary())])
HITS_SCHEMA = pa.schema([("block", pa.int32()), ("hashes", pa.binary())])


def _block_lines(shards: int):
    def run(block: pa.Table) -> pa.Table:
        """The distinct line hashes of a block with their document counts, packed per shard."""
        held: dict[bytes, int] = {}
        for text in as_strings(block["text"]).to_pylist():
            for key in set(line_keys(text)):
                if key:
                    held[key] = held.get(key, 0) + 1
        hashes = np.frombuffer(b"".join(map(key_hash, held)), HASH)
        docs = np.fromiter(held.values(), "<u4", len(held))
        shard = (hashes["hi"] % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        number = block["block"][0].as_py()
        rows = [{"shard": int(shard[part[0]]), "block": number, "hashes": hashes[part].tobytes(),
                 "docs": docs[part].tobytes()} for part in np.split(order, cuts) if len(part)]
        return _as_table(rows, LINES_SCHEMA)
    return run


def _build(shard: pa.Table) -> pa.Table:
    """One index row from all packed hashes of a shard."""
    hashes = np.concatenate([np.frombuffer(b, HASH) for b in shard["hashes"].to_pylist()])
    docs = np.concatenate([np.frombuffer(b, "<u4") for b in shard["docs"].to_pylist()])
    distinct, inverse = np.unique(hashes, return_inverse=True)
    tallies = np.bincount(inverse, weights=docs, minlength=len(distinct)).astype("<u4")
    return _as_table([ShardIndex.build(distinct, tallies).row(shard["shard"][0].as_py())], INDEX_SCHEMA)


def _probe(min_docs: int):
    def run(lines: pa.Table, index: pa.Table) -> pa.Table:
        """The hashes of each block that at least ``min_docs`` documents hold."""
        rows = []
        if lines.num_rows and index.num_rows:
            arrays = ShardIndex.from_row(index.to_pylist()[0])
            for number, packed in zip(lines["block"].to_pylist(), lines["hashes"].to_pylist()):
                hashes = np.frombuffer(packed, HASH)
                frequent = hashes[arrays.counts(hashes) >= min_docs]
                if len(frequent):
                    rows.append({"block": number, "hashes": frequent.tobytes()})
        return _as_table(rows, HITS_SCHEMA)
    return run


def _drop(block: pa.Table, hits: pa.Table) -> pa.Table:
    """The block's documents without their frequent lines."""
    packed = b"".join(hits["hashes"].to_pylist())
    frequent = {packed[i:i + 16] for i in range(0, len(packed), 16)}
    kept, totals, dropped = [], [], []
    for text in as_strings(block["text"]).to_pylist():
        lines = text.split("\n")
        stay = [line for line, key in zip(lines, line_keys(text)) if not key or key_hash(key) not in frequent]
        kept.append("\n".join(stay))
        totals.append(len(lines))
        dropped.append(len(lines) - len(stay))
    out = block.drop_columns(["block"])
    return (out.append_column("_kept", pa.array(kept, pa.string()))
            .append_column("_lines", pa.array(totals, pa.int64()))
            .append_column("_dropped", pa.array(dropped, pa.int64())))


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``shielded(docs)`` with ``_kept`` (the text that stays), ``_lines`` and ``_dropped``.

    Both users of the blocks reuse one exchange of the texts, both users of the packed hashes another.
    """
    docs = shielded(docs, "doc_id", "text")
    total = text_bytes(docs)
    blocks, shards = parts_for(total, BLOCK_BYTES), parts_for(total, SHARD_BYTES)
    names = [F.col(f"`{c}`") for c in docs.columns]
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(blocks)).cast("int")
    dealt = docs.select(*names, spread.alias("block"))
    lines = dealt.groupBy("block").applyInArrow(_block_lines(shards), LINES_DDL)
    index = lines.groupBy("shard").applyInArrow(_build, INDEX_DDL)
    hits = lines.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), HITS_DDL)
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema]
    schema = T.StructType([*fields, T.StructField("_kept", T.StringType()), T.StructField("_lines", T.LongType()),
                           T.StructField("_dropped", T.LongType())])
    return dealt.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(_drop, schema)
