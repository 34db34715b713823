"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def kept(df: DataFrame, path: str) -> DataFrame:
    """The rows written to the shared folder and read again, so that no lineage grows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, folder: str) -> DataFrame:
    """node and component (the smallest node reachable) of every node with a link.

    `links` has long columns a and b, each link once, in any direction. Rounds
    of large and small stars: a node points its neighbours to the smallest of
    them, until all point to the smallest of the component. A node with very
    many links is only aggregated by minimum and joined, which adaptive
    execution splits. Each round is written below `folder`.
    """
    now = kept(_ordered(links.select("a", "b")), f"{folder}/round0")
    state, turn = _state(now), 0
    while True:
        turn += 1
        now = kept(_small_star(_large_star(now)), f"{folder}/round{turn}")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.sum(mixed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(mixed, 32))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _ordered(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a").select("b", "m").unionAll(least)
    return _ordered(joined.toDF("a", "b"))
