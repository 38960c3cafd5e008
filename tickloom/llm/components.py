"""Connected components of a link table as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialize


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``v`` and ``class``: the smallest vertex reachable from ``v``, for each vertex with a link.

    Large stars and small stars in turn: every vertex is hung on the smallest one in sight, so that the
    number of links never grows and paths shorten by half. Each round is cut by ``checkpoint()``.
    A hub's links are joined with one row of its own and never gathered in one place.
    """
    edges = materialize(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("w"))
        .where("u <> w").distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("v"), F.col("w").alias("class"))
    while True:
        both = edges.union(edges.select("w", "u"))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        larger = edges.select(F.col("w").alias("u"), F.col("u").alias("x"))
        stars = (larger.join(least, "u").where("x <> m")
                 .select(F.col("x").alias("u"), F.col("m").alias("w")).distinct())
        lows = stars.groupBy("u").agg(F.min("w").alias("m"))
        hung = (stars.join(lows, "u").select(F.col("w").alias("u"), F.col("m").alias("w")).where("u <> w")
                .union(lows.select("u", F.col("m").alias("w"))).distinct())
        hung = materialize(hung)
        figures = [df.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(20,0)"))).first()
                   for df in (edges, hung)]
        if figures[0] == figures[1]:
            break
        edges = hung
    classes = edges.select(F.col("u").alias("v"), F.col("w").alias("class"))
    return classes.union(edges.select(F.col("w"), F.col("w")).distinct())
