"""Density clusters of places by grid cells, and the risk of each cluster.

The plane is cut into square cells.  A cell with at least ``least`` rows is
dense; dense cells that touch (sides or corners) belong to one cluster, a
component of the graph of cells; a thinner cell that touches a dense one is that
cluster's border (the smallest cluster's, if it touches several); all else is
noise.  Rows are counted into cells once (one aggregate, whatever a cell holds);
neighbours and components only concern cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.operators.components import connected_components
from incidentflow.operators.nearest import placed
from incidentflow.session import materialise

#: One of each pair of opposite neighbours.
_FORWARD = [(0, 1), (1, -1), (1, 0), (1, 1)]
_AROUND = [(y, x) for y in (-1, 0, 1) for x in (-1, 0, 1) if (y, x) != (0, 0)]


def _cell(lat: str, lon: str, size: float) -> Column:
    return F.struct(F.floor(F.col(lat) / size).alias("y"), F.floor(F.col(lon) / size).alias("x"))


def _shifted(cell: str, steps: list[tuple[int, int]]) -> Column:
    move = lambda y, x: F.struct((F.col(f"{cell}.y") + y).alias("y"), (F.col(f"{cell}.x") + x).alias("x"))
    return F.explode(F.array(*[move(y, x) for y, x in steps]))


def grid_cells(points: DataFrame, size: float, least: int, lat: str = "latitud_wgs84", lon: str = "longitud_wgs84") -> DataFrame:
    """``cell`` (struct ``y, x``), ``n``, ``dense``, ``cluster`` (the smallest
    cell of its component; null for noise) of every cell with a placed row."""
    counts = points.where(placed(lat, lon)).groupBy(_cell(lat, lon, size).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.withColumn("dense", F.col("n") >= least), "grid-cells")
    dense = counts.where("dense").select("cell")
    near = dense.select(F.col("cell").alias("a"), _shifted("cell", _FORWARD).alias("b"))
    touching = near.join(dense.select(F.col("cell").alias("b")), "b").select("a", "b")
    # every dense cell is a node, alone or not
    found = connected_components(touching.unionAll(dense.select(F.col("cell").alias("a"), F.col("cell").alias("b"))))
    found = found.select(F.col("node").alias("cell"), F.col("component").alias("cluster"))
    reach = found.select(_shifted("cell", _AROUND).alias("cell"), "cluster").groupBy("cell").agg(F.min("cluster").alias("border"))
    out = counts.join(found, "cell", "left").join(reach, "cell", "left")
    return out.select("cell", "n", "dense", F.coalesce("cluster", "border").alias("cluster"))


def cluster_points(
    points: DataFrame, size: float = 0.005, least: int = 30, lat: str = "latitud_wgs84", lon: str = "longitud_wgs84", out: str = "cluster"
) -> DataFrame:
    """Every row of ``points`` with ``out``: ``"<y>:<x>"`` of its cluster's
    smallest cell, null for noise and for rows without a place (a null or
    non-finite coordinate).  Repeated rows count each; an empty table gives none."""
    name = "_" * (1 + max(len(c) for c in points.columns))
    cells = materialise(grid_cells(points, size, least, lat, lon).where("cluster IS NOT NULL"), "clusters")
    label = F.concat_ws(":", "cluster.y", "cluster.x")
    own = cells.select(F.col("cell").alias(f"{name}c"), label.alias(f"{name}l"))
    keyed = points.withColumn(name, F.when(placed(lat, lon), _cell(lat, lon, size)))
    found = keyed.join(own, F.col(name) == F.col(f"{name}c"), "left")
    return found.withColumn(out, F.col(f"{name}l")).select(*[c for c in points.columns if c != out], out)


def cluster_risk(clustered: DataFrame, label: str, cluster: str = "cluster", lat: str = "latitud_wgs84", lon: str = "longitud_wgs84") -> DataFrame:
    """Per cluster: rows, positives, their rate, and the box it covers; noise
    (a null cluster) is left out."""
    return (
        clustered.where(F.col(cluster).isNotNull())
        .groupBy(cluster)
        .agg(
            F.count(F.lit(1)).alias("volume"),
            F.sum(F.col(label).cast("long")).alias("positives"),
            F.avg(F.col(label).cast("double")).alias("risk"),
            F.min(lat).alias("south"),
            F.max(lat).alias("north"),
            F.min(lon).alias("west"),
            F.max(lon).alias("east"),
        )
    )
