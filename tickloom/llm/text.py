"""Helpers shared by the text operators: table access, sizes and word splitting in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here: space and U+0009 to U+000D.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with the ``used`` columns as they are and all others inside one struct, ``_rest``.

    So no other column can clash with those that an operator adds.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    packed = [F.struct(*rest).alias("_rest")] if rest else []
    return docs.select(*used, *packed)


def restored(shielded_docs: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` from rows made of ``shielded(docs)``; ``changed``: new values by name."""
    plain = set(shielded_docs.columns)
    inside = {f.name for f in shielded_docs.schema["_rest"].dataType} if "_rest" in plain else set()
    def value(name):
        if name in changed:
            return changed[name]
        return F.col("_rest").getField(name) if name in inside else F.col(f"`{name}`")
    return shielded_docs.select(*[value(c).alias(c) for c in docs.columns])


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one aggregate row on the driver."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def parts_for(total_bytes: int, bytes_each: int) -> int:
    """How many parts of about ``bytes_each`` hold ``total_bytes``; one at least."""
    return max(1, -(-total_bytes // bytes_each))


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "").cast(pa.large_string())


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive runs of whole texts of about ``most`` bytes, so that working arrays stay small."""
    ends = np.asarray(pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())))
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(begin, end - begin)
        begin = end


def give_back() -> None:
    """Return the memory that this process has freed to the system: a worker process outlives its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidied(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that leaves no freed memory behind when its task ends.

    For ``applyInArrow`` too, which knows by the annotations that the rows of a group come in parts.
    """
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return inner


def tidied_group(run: Callable) -> Callable:
    """``tidied`` for ``applyInArrow``: after each group."""
    def inner(group: pa.Table) -> pa.Table:
        try:
            return run(group)
        finally:
            give_back()
    return inner


def tidied_cogroup(run: Callable) -> Callable:
    """``tidied_group`` for two groups of one key."""
    def inner(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()
    return inner


def lowered_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of lower-cased (A-Z only) texts: code of each word, distinct words, first word of each text.

    The third array has one entry more than there are texts. Splitting is at ASCII white space.
    """
    return coded_words(pc.ascii_lower(texts))


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``lowered_words`` without the lower-casing."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    codes = np.asarray(coded.indices)
    starts = np.asarray(lists.offsets)
    starts = starts - starts[0]
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if blank >= 0:  # texts that begin or end with white space give empty words
        real = codes != blank
        starts = np.concatenate([[0], np.cumsum(real)])[starts]
        codes = codes[real]
    return codes, coded.dictionary, starts


def word_counts(texts: pa.Array) -> np.ndarray:
    """How many words each of some large strings without nulls has."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, "<i8")[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", "u1")[ends[0]:ends[-1]]
    ends = ends - ends[0]
    space = (data == 32) | (data - np.uint8(9) < 5)
    begins = ~space
    begins[1:] &= space[:-1]
    here = ends[:-1][np.diff(ends) > 0]
    begins[here] = ~space[here]
    found = np.concatenate([[0], np.cumsum(begins)])
    return found[ends[1:]] - found[ends[:-1]]
