"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, meet


def _with_least(pairs: DataFrame, least: Column, rows: int) -> DataFrame:
    """``pairs``, ``rows`` at most, with m, the smallest node known at ``a``. A hub's pairs are
    not shuffled."""
    by_node = materialize(pairs.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "by-node")
    return meet(pairs, by_node, ["a"], "n", rows).drop("n")


def _both(x: str, y: str) -> Column:
    return F.explode(F.array(F.struct(F.col(x).alias("a"), F.col(y).alias("b")), F.struct(F.col(y).alias("a"), F.col(x).alias("b"))))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest one: one pair an edge at most."""
    both = edges.select(_both("a", "b").alias("e")).select("e.*")
    told = _with_least(both, F.least(F.min("b"), F.col("a")), 2 * n)
    return told.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(down: DataFrame, n: int) -> DataFrame:
    """Every node and its smaller neighbours (a > b) are tied to the smallest of them."""
    told = _with_least(down, F.min("b"), n)
    pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return told.select(F.explode(pairs).alias("e")).select("e.*").where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node of each component, for every node that has an edge.

    ``edges`` has long columns a and b. Each step ends in a written table, so a lost executor
    costs one step; sums of the edges tell when nothing changes any more.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, told = materialize(ordered, "edges"), None
    n = now.count()
    for _ in range(most_rounds):
        now = materialize(_small_star(materialize(_large_star(now, n), "stars"), n), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == told:
            break
        told, n = mark, mark[0]
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return materialize(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "roots")
