"""Homomorphic multiset fingerprints of documents with built-in functions only.

A paragraph is a line. It is hashed to a wide vector of ``LANES`` small signed numbers (eight per 64-bit
hash), and so is each of its sentences; a document's fingerprint is the sum of the vectors of its
paragraphs, each lane modulo ``MODULUS``. Hence the order of paragraphs does not matter, a paragraph is
inserted or deleted by adding or subtracting its vector (``combine``, ``remove``), and equal multisets
have equal fingerprints. Because lanes are signed with mean 0, the inner product of two fingerprints
estimates how many pieces they share; ``likeness`` is 2ab / (aa + bb), cut to 0..1.

Defined cases: a null text counts as empty; an empty text has one empty paragraph; the next document of
the last one is the first, of an only one itself; rows that repeat both id and text count as one document
when neighbours are sought and each keep a result row; ties in ``doc_id`` are ordered by the MD5 of the
text; a null ``doc_id`` comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import scratch_path, shared_dir

LANES = 64
MODULUS = 2 ** 24
HEX_DIGITS = 6
SENTENCE_END = r"\n|(?<=[.!?]) "
KEYS_PER_PART = 500_000


def pieces(text: Column) -> Column:
    """A text's paragraphs and their sentences, marked apart."""
    paragraphs = F.transform(F.split(text, "\n", -1), lambda p: F.concat(F.lit("p"), p))
    sentences = F.transform(F.split(text, SENTENCE_END, -1), lambda s: F.concat(F.lit("s"), s))
    return F.concat(paragraphs, sentences)


def lane_sums(piece: Column, times: Column) -> list[Column]:
    """Sums of each lane over the rows of a group, ``times``: how often the group repeats its pieces."""
    sums = []
    for word in range(LANES // 8):
        hashed = F.xxhash64(F.lit(word), piece)
        for byte in range(8):
            lane = F.shiftright(hashed, 8 * byte).bitwiseAND(F.lit(255)) * 2 - 255
            sums.append((F.sum(lane) / times).cast("long").alias(f"_l{word * 8 + byte}"))
    return sums


def as_text(vector: Column) -> Column:
    """The canonical form of a vector: its lanes modulo ``MODULUS`` in hexadecimal digits."""
    lane = lambda x: F.lpad(F.lower(F.hex(F.pmod(x, F.lit(MODULUS)))), HEX_DIGITS, "0")
    return F.array_join(F.transform(vector, lane), "")


def parsed(fingerprint: Column) -> Column:
    """The vector of a canonical form, lanes between -MODULUS/2 and MODULUS/2."""
    def lane(at):
        digits = F.substring(fingerprint, at.cast("int") * HEX_DIGITS + 1, F.lit(HEX_DIGITS))
        value = F.conv(digits, 16, 10).cast("long")
        return F.when(value >= MODULUS // 2, value - MODULUS).otherwise(value)
    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lane)


def combine(left: Column, right: Column) -> Column:
    """The fingerprint of both paragraph multisets together."""
    return as_text(F.zip_with(parsed(left), parsed(right), lambda a, b: a + b))


def remove(whole: Column, part: Column) -> Column:
    """The fingerprint of ``whole`` without the paragraphs of ``part``."""
    return as_text(F.zip_with(parsed(whole), parsed(part), lambda a, b: a - b))


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common pieces of two vectors, 0 to 1."""
    def dot(a, b):
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y)
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    size = dot(left, left) + dot(right, right)
    return F.when(size == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) * dot(left, right) / size)))


def vectors(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``_vector`` for ``texts(keys, _text)``; rows with equal keys must have equal texts."""
    exploded = texts.select(*keys, F.posexplode(pieces(F.col("_text"))).alias("_at", "_piece"))
    rows = F.sum((F.col("_at") == 0).cast("long"))
    names = [F.col(f"_l{i}") for i in range(LANES)]
    summed = exploded.groupBy(*keys).agg(*lane_sums(F.col("_piece"), rows))
    return summed.select(*keys, F.array(*names).alias("_vector"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` columns ``doc_id`` and ``text`` to doc_id, fingerprint."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    keyed = keyed.withColumn("_tie", F.md5(F.col("_text").cast("binary")))
    counts = keyed.groupBy("doc_id", "_tie").agg(F.count("*").alias("_m"))
    found = vectors(keyed, ["doc_id", "_tie"])
    joined = found.join(counts.withColumnsRenamed({"doc_id": "_id", "_tie": "_t"}),
                        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t")))
    return (joined.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_m").cast("int"))))
            .select("doc_id", as_text(F.col("_vector")).alias("fingerprint")))


def neighbours(keyed: DataFrame) -> DataFrame:
    """Each distinct document with the next one: _key, doc_id, _n, _times, _next.

    Only keys travel. They are dealt by range and fixed with ``checkpoint()``, since range bounds are
    sampled; the last key of a part gets the first of the next part from a table of one row per part.
    """
    spark = keyed.sparkSession
    shared_dir(spark)
    keys = keyed.groupBy("_key", "doc_id", "_tie").agg(
        F.max("_n").alias("_n"), F.count("*").alias("_times"))
    total = keyed.count()
    dealt = (keys.repartitionByRange(max(1, -(-total // KEYS_PER_PART)), "doc_id", "_tie")
             .withColumn("_part", F.spark_partition_id()).checkpoint())
    inside = Window.partitionBy("_part").orderBy("doc_id", "_tie")
    ordered = dealt.withColumn("_next", F.lead("_key").over(inside))
    firsts = dealt.groupBy("_part").agg(F.min(F.struct("doc_id", "_tie", "_key"))["_key"].alias("_first"))
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("_part", F.coalesce(
        F.lead("_first").over(Window.orderBy("_part")), F.first("_first").over(parts)).alias("_after"))
    return (ordered.join(following, "_part")
            .select("_key", "doc_id", "_n", "_times", F.coalesce("_next", "_after").alias("_next")))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts, with their likeness.

    The edited text has its last half replaced by the first half as many code points of the next
    document. Result: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Texts travel once (both joins reuse one exchange by key), borrowed heads once.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    tie = F.md5(F.col("_text").cast("binary"))
    key = F.concat_ws(":", F.col("doc_id").cast("string"), tie)
    after = neighbours(texts.select(key.alias("_key"), "doc_id", tie.alias("_tie"), F.length("_text").alias("_n")))
    bodies = texts.select(key.alias("_key"), "_text")
    half = (F.col("_n") / 2).cast("int")
    wanted = after.select(F.col("_key").alias("_taker"), "_next", "_n")
    heads = (wanted.join(bodies, wanted["_next"] == bodies["_key"])
             .select("_taker", F.substring(F.col("_text"), F.lit(1), half).alias("_head")))
    heads = heads.groupBy("_taker").agg(F.first("_head").alias("_head"))
    n = F.length("_text")
    kept = F.substring(F.col("_text"), F.lit(1), (n - (n / 2).cast("int")).cast("int"))
    edited = bodies.join(heads, bodies["_key"] == heads["_taker"]).select(
        "_key", "_text", F.concat(kept, F.col("_head")).alias("_edited"))
    both = edited.select("_key", F.sha2(F.col("_edited").cast("binary"), 256).alias("_sha"), F.explode(F.array(
        F.struct(F.lit(0).alias("v"), F.col("_text").alias("t")),
        F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))).alias("_e"))
    own = vectors(both.select("_key", "_sha", F.col("_e.v").alias("_version"), F.col("_e.t").alias("_text")),
                  ["_key", "_sha", "_version"])
    version = lambda v: F.max(F.when(F.col("_version") == v, F.col("_vector")))
    paired = own.groupBy("_key", "_sha").agg(version(0).alias("_vector"), version(1).alias("_edited"))
    path = scratch_path(spark, "fingerprints")
    paired.join(after, "_key").write.parquet(path)
    done = spark.read.parquet(path)
    nexts = done.select(F.col("_key").alias("_next"), F.col("_vector").alias("_next_vector"))
    joined = done.join(nexts, "_next")
    return joined.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(
        "doc_id", F.col("_n").cast("long").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
        as_text(F.col("_vector")).alias("fingerprint"), as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_vector"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_vector"), F.col("_next_vector")).alias("near_next"))
