import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside, as extra columns of a caller.
CLASHING = ["block", "_rest", "_kept", "p_toxic", "_size", "tie", "_key", "bucket"]


def documents(spark, texts, sources=None):
    """Rows numbered from 0."""
    rows = [(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, white space, one long text, repeated rows, null ids, clashing columns."""
    rng = random.Random(5)
    long_text = " ".join(words(rng, 20_000))
    rows = [(0, None, "en", None, 0), (1, "", "en", "s", 0), (2, " \t\n\x0b ", "en", "s", 5),
            (3, long_text, "en", "s", len(long_text)), (4, "same row here", "en", "t", 13),
            (4, "same row here", "en", "t", 13), (None, "no id at all", None, "t", None),
            (None, None, None, None, None), (5, "é ü  double\n\nlines ", "fr", "u", 20)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
