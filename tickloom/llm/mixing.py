"""Mixing sources to target weights with built-in functions only.

Tokens (words) are summed per source, every source gets a target share of all words, and each document
is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli copy with probability equal to the
fraction, where ``rate`` is the source's target divided by its words.

Targets: sources in code point order (null last) weigh ``weights`` in turn; a target stops at
``ceiling`` times the source's words and the excess goes to the others by weight. With sources sorted by
ceiling per weight, the common level is the largest quotient (words left) / (weight left) on the way,
so one running sum over the table of sources replaces the repeated sharing.

Defined cases: a null or empty text has size 0 and takes nothing; a null source is a source of its own;
an empty table gives an empty result; repeated rows draw alike; a null ``doc_id`` draws by its text; other
columns are kept in ``_rest`` (see ``text.restored``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import WORD_PATTERN, restored, shielded

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the document and the seed alone."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2 ** 52))


def source_targets(sized: DataFrame, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """One row per source of ``sized(source, size)``: source, source_size, target.

    The windows without a partition run over the sources only, after their documents were summed.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    cyclic = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    weighed = (sources.withColumn("weight", cyclic)
               .withColumn("most", F.col("source_size") * ceiling))
    order = (F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", left / weight_left)
    level = F.max("level").over(whole)
    return levels.select("source", "source_size",
                         F.least(F.col("most").cast("double"), level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """``shielded(docs)`` with ``_size``, ``_source_size``, ``_target`` and ``_copies`` (how often to emit each).

    The join with the sources carries no hint: Spark broadcasts it below its measured threshold, and
    otherwise a hot source is split by the adaptive skew join.
    """
    docs = shielded(docs, "doc_id", "source", "text")
    sized = docs.select(F.col("source"), word_count(F.col("text")).alias("size"))
    targets = source_targets(sized, weights, ceiling).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"))
    drawn = docs.withColumn("_size", word_count(F.col("text"))).withColumn(
        "_draw", draw(F.col("doc_id"), F.col("text"), seed))
    joined = drawn.join(
        targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    once_more = F.col("_draw") < rate - F.floor(rate)
    return joined.withColumn("_copies", F.floor(rate).cast("long") + once_more.cast("long"))


def emit(docs: DataFrame, weights=WEIGHTS, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """The mixture itself: each document as often as ``mix`` says, in the columns of ``docs``."""
    mixed = mix(docs, weights, ceiling, seed)
    turns = F.sequence(F.lit(1), F.col("_copies").cast("int"))
    return restored(mixed.where("_copies > 0").withColumn("_turn", F.explode(turns)), docs)
