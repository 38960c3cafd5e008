"""The training-data pipeline: stages over documents, each working on all that its predecessor kept.

Toxic documents go; lines found in ten documents or more go; one document of each near-duplicate class
stays; each document is emitted as often as its source's target asks; what is left is packed. Documents
whose lines all go stay with an empty text. All stages but the last return the columns of ``documents``.

Defined cases: null texts are scored, compared and packed as empty ones (one document without words stays for all
of them); null ids and null sources are values like others; of rows equal in id and text one stays; ties
between rows are decided as each stage's module says; empty tables give empty results; other columns of
``documents``, whatever their names, come through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import linededup, mixing, neardup, packing, toxicity
from tickloom.llm.text import restored
from tickloom.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return restored(toxicity.classify(docs, labels).where(~F.col("_rejected")), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more hold; ``n_chars`` follows."""
    changed = {"text": F.col("_kept")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_kept").cast(docs.schema["n_chars"].dataType)
    return restored(linededup.drop_frequent_lines(docs), docs, **changed)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the classifier and the tokenizer; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
