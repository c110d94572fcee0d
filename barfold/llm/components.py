"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barfold.sources.scratch import materialise, release


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``links`` (``a``, ``b``: long).

    Each round hooks every node to the smallest neighbour it knows; the rounds grow with the logarithm
    of the longest path. A round's result is a table in the shared checkpoint folder, deleted after the next round. Neighbours
    are reduced to their minimum before any shuffle by node, and a node with many links is split by
    adaptive joins. Loops, repeated links and no links at all are fine.
    """
    now = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _print(now)
    while True:
        before, now = now, materialise(_small_star(_large_star(now)))
        release(before)
        mark = _print(now)
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node")))


def small(frame: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A narrow table for a join: stored, and broadcast if it is found to have at most ``rows`` rows."""
    stored = materialise(frame)
    return F.broadcast(stored) if stored.count() <= rows else stored


def _print(links: DataFrame) -> tuple:
    """Number of links and a sum that tells one set of links from another."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.max("u"), F.max("v")).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
