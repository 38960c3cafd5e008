"""Packing by power-of-two decomposition.

A document's ids (those of the tokenizer, then one end id) are cut into pieces whose lengths are powers
of two: as many of ``max_len`` as fit, then the binary digits of the rest from large to small. Every
piece is a sequence of its own, so no sequence crosses documents and none needs padding; sequences of
equal length share a bucket, which is the leading part of their id.

Tokenizing whole texts would spend most of the time on words seen before. The pre-tokenizer never lets a
piece reach over a single space before a word, from a letter or digit into punctuation, or over a single line break
between others, so texts are cut there (a part keeps the space before it), each distinct part is tokenized once
per worker process, and the ids are put together again. New parts that begin with a space go to the tokenizer one
behind the other, since the tokens that begin with a space show where each begins. Texts where a space is followed
by white space or by the end, or that hold a special token's string or the mark of cuts, are tokenized whole. Known
parts are plain arrays; when there are too many, those used most often stay.

Defined cases: a null or empty text has the end id alone; repeated rows are packed each; null ids stay.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import as_strings, slices, tidied

MAX_LEN = 2048
END_ID = 1
#: Distinct text parts that a worker process keeps ids for, from task to task, before it drops the less used half.
KEPT_PARTS = 500_000
#: New parts that are tokenized one behind the other.
JOINED_PARTS = 1000
#: Stands where texts are cut.
MARK = "\x00"
#: A space before white space (as the pre-tokenizer sees it) or at the end.
NOT_PLAIN = (r" ([\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|$)")
LETTERS = r"0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
#: A line break between others, and a letter or digit before punctuation.
LONE_BREAK = rf"([!-~\x{{C0}}-\x{{24F}}])\n([{LETTERS}])"
WORD_END = rf"([{LETTERS}])([!-/:-@\[-`{{-~])"


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... (sizes[0] of them), begins[1], ..."""
    until = np.cumsum(sizes)
    return np.repeat(begins - (until - sizes), sizes) + np.arange(until[-1] if len(until) else 0)


class PartTokenizer:
    """Ids of texts, remembering the ids of their parts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.not_plain = "|".join([NOT_PLAIN, r"\x00", *map(re.escape, special)])
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids of tokens that begin with a space
        self.opens[[at for token, at in vocabulary.items() if token.startswith("\u0120")]] = True
        self.parts, self.ids = pa.array([], pa.large_string()), np.empty(0, "<u4")
        self.ends, self.uses = np.zeros(1, np.int64), np.empty(0, np.int32)

    @property
    def place(self) -> dict[str, int]:
        """Where each known part is."""
        return {part: at for at, part in enumerate(self.parts.to_pylist())}

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        if not texts:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        got = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))

    def _encoded_joined(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``_encoded`` of parts that begin with a space."""
        each = np.append(np.arange(0, len(parts), JOINED_PARTS), len(parts))
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(each, pa.int32()), parts), pa.scalar("", parts.type))
        ids, sizes = self._encoded(rows.to_pylist())
        begins = np.flatnonzero(self.opens[ids])
        until = np.cumsum(sizes)
        if not np.array_equal(np.searchsorted(begins, until - sizes), each[:-1]) or len(begins) != len(parts):
            return self._encoded(parts.to_pylist())
        return ids, np.diff(np.append(begins, len(ids)))

    def _learn(self, parts: pa.Array | list[str]) -> None:
        parts = pa.array(parts, pa.large_string())
        spaced = pc.starts_with(parts, " ")
        other = parts.filter(pc.invert(spaced))
        found = [self._encoded_joined(parts.filter(spaced)), self._encoded(other.to_pylist())]
        self.parts = pa.concat_arrays([self.parts, parts.filter(spaced), other])
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in found)])
        sizes = np.concatenate([sizes for _, sizes in found])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.uses = np.append(self.uses, np.zeros(len(parts), np.int32))

    def _drop(self) -> None:
        """Leave the parts used most often, of those alike the newest."""
        kept = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) - KEPT_PARTS // 2:])
        sizes = np.diff(self.ends)[kept]
        self.ids = self.ids[spread(self.ends[kept], sizes)]
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.parts, self.uses = self.parts.take(pa.array(kept)), self.uses[kept] // 2

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        ids, lengths = self.encoded(texts)
        yield from np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []

    def encoded(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with ``end_id`` behind it if there is one; ids of each text."""
        is_whole = pc.match_substring_regex(texts, self.not_plain)
        whole = np.flatnonzero(np.asarray(is_whole))
        rest, rest_sizes = self._encoded(texts.filter(is_whole).to_pylist())
        marked = pc.if_else(is_whole, "", texts) if len(whole) else texts
        marked = pc.replace_substring_regex(marked, LONE_BREAK, f"\\1{MARK}\n{MARK}\\2")
        marked = pc.replace_substring_regex(marked, WORD_END, f"\\1{MARK}\\2")
        marked = pc.split_pattern(pc.replace_substring(marked, " ", f"{MARK} "), MARK)
        starts = np.asarray(marked.offsets)
        starts = starts - starts[0]
        coded = marked.flatten().dictionary_encode()
        del marked
        places = pc.index_in(coded.dictionary, self.parts)
        if places.null_count:
            self._learn(coded.dictionary.filter(places.is_null()))
            places = pc.index_in(coded.dictionary, self.parts)
        places, codes = np.asarray(places), np.asarray(coded.indices)
        self.uses[places] += 1
        begin, length = self.ends[places][codes], np.diff(self.ends)[places][codes]
        # a text that was tokenized whole is one empty part so far
        begin[starts[whole]] = len(self.ids) + np.cumsum(rest_sizes) - rest_sizes
        length[starts[whole]] = rest_sizes
        until = np.concatenate([[0], np.cumsum(length)])
        lengths = until[starts[1:]] - until[starts[:-1]]
        flat = np.concatenate([self.ids, rest])
        if len(self.parts) > KEPT_PARTS:
            self._drop()
        if end_id is None:
            return flat[spread(begin, length)], lengths
        begin, length = np.insert(begin, starts[1:], len(flat)), np.insert(length, starts[1:], 1)
        return np.append(flat, np.uint32(end_id))[spread(begin, length)], lengths + 1


_CODERS: dict[str, PartTokenizer] = {}


def coder_of(path: str) -> PartTokenizer:
    """This worker process's tokenizer of a file; the parts it has met serve later tasks."""
    if path not in _CODERS:
        _CODERS.clear()
        _CODERS[path] = PartTokenizer(path)
    return _CODERS[path]


def piece_lengths(total: int, max_len: int = MAX_LEN) -> list[int]:
    """Powers of two, large ones first, that add up to ``total``."""
    lengths = [max_len] * (total // max_len)
    rest = total % max_len
    return lengths + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def cut(totals: np.ndarray, max_len: int = MAX_LEN) -> tuple[np.ndarray, np.ndarray]:
    """``piece_lengths`` of several totals one after the other, and how many pieces each has."""
    full = totals // max_len
    bits = np.arange(max_len.bit_length() - 2, -1, -1)
    has = (totals[:, None] >> bits & 1).astype(bool)
    number = full + has.sum(1)
    lengths = np.full(int(number.sum()), max_len, np.int64)
    row, bit = np.nonzero(has)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(has.sum(1)) - has.sum(1), has.sum(1))
    begins = np.cumsum(number) - number
    lengths[begins[row] + full[row] + nth] = 1 << bits[bit]
    return lengths, number


PIECE_DDL = "start long, length long, doc_tokens long, ids binary"
#: Texts whose ids are put together at a time.
TEXT_BYTES = 4 << 20


def _pieces(tokenizer: str, max_len: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tokenizer)
        for batch in batches:
            doc_ids = batch["doc_id"]
            for texts in slices(as_strings(batch["text"]), TEXT_BYTES):
                own, doc_ids = doc_ids.slice(0, len(texts)), doc_ids.slice(len(texts))
                ids, totals = coder.encoded(texts, end_id)
                length, number = cut(totals, max_len)
                until = np.concatenate([[0], np.cumsum(length)])  # a document's pieces lie one after the other
                start = until[:-1] - np.repeat(np.cumsum(totals) - totals, number)
                parts = pa.Array.from_buffers(pa.binary(), len(length), [
                    None, pa.py_buffer((until * 4).astype("<i4")), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(np.repeat(np.arange(len(texts)), number))), pa.array(start), pa.array(length),
                     pa.array(np.repeat(totals, number)), parts],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"])
    return run


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor has; ``ids`` holds little-endian
    unsigned 32-bit ids. A ``sequence_id`` begins with the bucket (the binary logarithm of the length)
    and goes on with the place in the input partition, so a task that runs again over a written table
    gives the same ids. Nothing is shuffled.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(
        tidied(_pieces(tokenizer, max_len, end_id)), f"doc_id {kind}, {PIECE_DDL}")
    bucket = F.round(F.log2(F.col("length"))).cast("long")
    number = F.shiftleft(bucket, 58) + F.monotonically_increasing_id()
    return pieces.withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("long"))
