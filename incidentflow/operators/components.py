"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.session import materialise, releasing


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours and itself to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select("b", "m").unionAll(least.select("a", "m")).toDF("a", "b")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) of every node in ``edges``
    (columns ``a``, ``b`` of any orderable type; direction, repeats and loops do
    not matter; rows with a null end are left out).

    Only edges move, each round is written and the round before it removed.
    Raises if the rounds do not suffice rather than giving a partial answer.
    """
    spark = edges.sparkSession
    nodes = edges.where("a IS NOT NULL AND b IS NOT NULL")
    with releasing(spark) as scratch:
        nodes = now = materialise(nodes.distinct(), "component-edges")
        before = None
        for _ in range(most_rounds):
            now = materialise(_small_star(_large_star(now)).where("a <> b").distinct(), "component-edges")
            state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
            if tuple(state) == before:
                break
            before = tuple(state)
            scratch.drop_between()
        else:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
        every = nodes.select(F.col("a").alias("node")).unionAll(nodes.select("b")).distinct()
        found = every.join(now.withColumnsRenamed({"a": "node", "b": "component"}), "node", "left")
        return scratch.keep(materialise(found.select("node", F.coalesce("component", "node").alias("component")), "components"))
