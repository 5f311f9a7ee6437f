"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node ties its larger (or its smaller) neighbours and itself to
    the smallest of them."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = near.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``edges``
    (columns ``a`` and ``b``, any order, null ends left out).  Only the edges
    move; each round is written to the shared checkpoint folder.  Raises if
    the rounds do not suffice rather than returning a partial answer."""
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        # after a small star every node but the roots points to a smaller one
        now = materialise(_star(_star(now, True), False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            tied = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return tied.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = tuple(state)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
