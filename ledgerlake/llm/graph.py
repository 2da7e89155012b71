"""Connected components of a link table as joins and grouped minima."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, functions as F

from .common import written


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has
    a link.

    A round gives each node the smallest node next to it, follows that choice
    once more, and contracts: links are rewritten to the chosen nodes, and
    those inside one node go.  What is left shrinks with every round; the
    rounds' choices are joined up at the end.  Each round is written out."""
    pair = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    pair = written(pair, "links")
    rounds, left = [], 1
    while left:
        choice = _both(pair).groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        choice = written(choice, "choices")
        jump = choice.select(F.col("node").alias("up"), F.col("up").alias("top"))
        choice = written(choice.join(jump, "up").select("node", F.col("top").alias("up")), "choices")
        rounds.append(choice)
        x = pair.join(choice.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
        y = x.join(choice.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        seen = Observation(f"links-{uuid.uuid4().hex[:8]}")
        pair = written(y.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b")
                       .distinct().observe(seen, F.count(F.lit(1)).alias("left")), "links")
        left = (seen.get or {}).get("left")
    out = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = out.select(F.col("node").alias("up"), F.col("up").alias("top"))
        out = earlier.join(later, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
    return out.select("node", F.col("up").alias("component"))
