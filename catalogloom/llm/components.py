"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogloom.llm.shared import kept


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root`` (the smallest id reachable) of every id in ``links(x, y)``.

    Large stars hook larger neighbours to the smallest, small stars the smaller
    ones; both keep the number of links, and rounds grow with the logarithm of
    the size. Minima combine before the shuffle, so a hub is no hot key. Each
    round is written to the shared folder. No links give no rows.
    """
    edges = kept(_ordered(links.select(F.col("x").alias("u"), F.col("y").alias("v"))), "links")
    while not _are_stars(edges):
        edges = kept(_small(_large(edges)), "links")
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each id has one root, and no root another one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs")).where("ups + downs > 1").isEmpty()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    hooked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return hooked


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    hooked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return _ordered(hooked.union(least.select("u", F.col("_m").alias("v"))))
