"""Density clusters and connected components against brute force."""

import os
import random

import pytest
from pyspark.sql import functions as F

from incidentflow import session
from incidentflow.operators.cluster import cluster_points, cluster_risk
from incidentflow.operators.components import connected_components
from incidentflow.session import materialise, releasing


def _components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_equal_union_find(spark):
    pick = random.Random(4)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(70)] + [(7, 7), (5000, 5000)]
    edges += edges[:5]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == _components(edges)
    assert connected_components(df.limit(0)).count() == 0
    with pytest.raises(RuntimeError):
        connected_components(df, most_rounds=1)


def test_scratch_tables_are_removed(spark):
    before = set(session._WRITTEN)
    with releasing(spark) as scratch:
        materialise(spark.range(3), "gone")
        kept = scratch.keep(materialise(spark.range(5), "kept"))
        gone = scratch.paths[0]
    assert kept.count() == 5 and not os.path.exists(gone.removeprefix("file:"))
    assert len(set(session._WRITTEN) - before) == 1


def brute(points, size, least):
    cells = {}
    for _, lat, lon, _ in points:
        if lat is not None and lon is not None and abs(lat) < 1e9 and abs(lon) < 1e9:
            cells.setdefault((int(lat // size), int(lon // size)), 0)
            cells[int(lat // size), int(lon // size)] += 1
    dense = {c for c, n in cells.items() if n >= least}
    near = lambda c: [(c[0] + y, c[1] + x) for y in (-1, 0, 1) for x in (-1, 0, 1)]
    comp = _components([(c, d) for c in dense for d in near(c) if d in dense])
    out = {}
    for pid, lat, lon, _ in points:
        found = None
        if lat is not None and lon is not None and abs(lat) < 1e9 and abs(lon) < 1e9:
            c = (int(lat // size), int(lon // size))
            found = comp.get(c) or min((comp[d] for d in near(c) if d in comp), default=None)
        out[pid] = found and f"{found[0]}:{found[1]}"
    return out


def test_clusters_equal_brute_force(spark):
    pick = random.Random(2)
    points = []
    for _ in range(12):
        y, x = pick.uniform(-3, 3), pick.uniform(-3, 3)
        points += [(y + pick.gauss(0, 0.2), x + pick.gauss(0, 0.2)) for _ in range(60)]
    points += [(pick.uniform(-4, 4), pick.uniform(-4, 4)) for _ in range(200)] + [(0.05, 0.05)] * 400
    points += [(None, 1.0), (1.0, None), (float("nan"), 0.0), (float("inf"), 0.0)]
    rows = [(i, *p, int(i % 9 == 0)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "pid long, latitud_wgs84 double, longitud_wgs84 double, bad int").withColumn("cell", F.lit("mine"))
    out = cluster_points(df, 0.25, 5)
    assert out.columns == [*df.columns, "cluster"]
    want = brute(rows, 0.25, 5)
    assert {r.pid: r.cluster for r in out.collect()} == want
    risk = {r.cluster: (r.volume, r.positives) for r in cluster_risk(out, "bad").collect()}
    assert risk == {c: (sum(v == c for v in want.values()), sum(v == c and pid % 9 == 0 for pid, v in want.items())) for c in set(want.values()) - {None}}
    assert cluster_points(df.limit(0)).count() == 0
    assert cluster_points(df, 0.25, 10**6).where("cluster IS NOT NULL").count() == 0
