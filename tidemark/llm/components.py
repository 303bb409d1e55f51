"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round only takes minima by key, which Spark combines before the shuffle, and joins on them: a node with very many
edges is never gathered into one row or task. The number of rounds grows with the logarithm of the largest component. A round has no more
rows than twice the edges, so that their number decides in how many files it is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, in_few_files


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.xxhash64("u", "v") % 1_000_000_007)), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges(a, b), undirected, any order and repeats; returns (node, component): the smallest id reachable, only for nodes
    whose component differs from themselves."""
    now = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = _state(now)
    while before[0]:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        low = now.groupBy("u").agg(F.min("v").alias("m"))  # the smallest neighbour is below u, or u is its own minimum
        large = (
            both.where("v > u").alias("e").join(low.alias("l"), F.col("e.u") == F.col("l.u"), "left")
            .select(F.col("e.v").alias("u"), F.coalesce("l.m", F.col("e.u")).alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        large = scratch.keep(in_few_files(large, before[0]), "large")
        scratch.drop(now)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.alias("e").join(low.alias("l"), F.col("e.u") == F.col("l.u"))
            .select(F.col("e.v").alias("u"), F.col("l.m").alias("v")).where("u > v")
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = scratch.keep(in_few_files(small, before[0]), "small")
        scratch.drop(large)
        after = _state(now)
        if after == before:
            break
        before = after
    return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
