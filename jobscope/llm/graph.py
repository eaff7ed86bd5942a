"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b), a > b. Minima are partial aggregates, so hub vertices do not gather."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(low, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b): the smallest node it reaches.

    Each round's edges are a written table, so lineage stays short and a lost
    executor costs one round; rounds grow with the logarithm of the longest chain.
    """
    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a > b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        new = written(_stars(_stars(e, True), False), "edges")
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(e)
        e = new
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
