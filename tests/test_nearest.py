"""Nearest station by the cell index, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from incidentflow.operators import enrich
from incidentflow.operators.nearest import PLACE_LIMIT, nearest_station

POINTS, STATIONS = "pid long, latitud_wgs84 double, longitud_wgs84 double", "codi_estacio string, latitud_wgs84 double, longitud_wgs84 double"


def _placed(lat, lon):
    return lat is not None and lon is not None and abs(lat) <= PLACE_LIMIT and abs(lon) <= PLACE_LIMIT


def brute(points, stations):
    out = []
    for pid, lat, lon in points:
        seen = [((lat - a) * (lat - a) + (lon - o) * (lon - o), c) for c, a, o in stations if c is not None and _placed(a, o)] if _placed(lat, lon) else []
        if seen:
            out.append((pid, min(seen)[1], min(seen)[0]))
    return sorted(out, key=str)


def _got(spark, points, stations, **kw):
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(stations, STATIONS)
    return sorted(((r.pid, r.st, r.d) for r in nearest_station(p, s, out="st", distance_col="d", **kw).collect()), key=str)


def _points(pick, n):
    near = [(i, round(pick.uniform(41.2, 41.6), 4), round(pick.uniform(1.9, 2.4), 4)) for i in range(n)]
    far = [(n + i, pick.choice([-1, 1]) * 10 ** pick.uniform(-3, 9), pick.choice([-1, 1]) * 10 ** pick.uniform(-3, 9)) for i in range(n // 3)]
    nan, inf = float("nan"), float("inf")
    odd = [(None, 41.3, 2.0), (None, 41.3, 2.0), (9001, nan, 2.1), (9002, inf, 2.1), (9003, 41.4, -inf), (9004, None, 2.1), (9005, 1e10, 2.0), (9006, 0.0, 0.0), (9006, 0.0, 0.0)]
    return near + far + odd


@pytest.mark.parametrize("n", [1, 10, 300])
def test_same_call_for_few_and_many_stations(spark, n):
    pick = random.Random(n)
    stations = [(f"S{i:03d}", round(pick.uniform(41.3, 41.5), 3), round(pick.uniform(2.0, 2.3), 3)) for i in range(n)]
    stations += [("S_dup", stations[0][1], stations[0][2]), (None, 41.4, 2.1), ("N", None, 2.1), ("I", float("inf"), 2.1)]
    points = _points(pick, 200) + [(8000 + k, a, o) for k, (_, a, o) in enumerate(stations)]
    assert _got(spark, points, stations) == brute(points, stations)


def test_clusters_outliers_and_lines(spark):
    pick = random.Random(5)
    cluster = [(f"C{i}", 41.4 + pick.gauss(0, 1e-4), 2.1 + pick.gauss(0, 1e-4)) for i in range(200)]
    cases = {
        "one far outlier": cluster + [("Z", 0.0, 0.0)],
        "a line": [(f"L{i}", 41.4, 2.0 + i / 100) for i in range(60)],
        "a grid with ties everywhere": [(f"G{i}{j}", 41.0 + i, 2.0 + j) for i in range(6) for j in range(6)],
        "one place": [(f"P{i}", 41.4, 2.1) for i in range(30)],
    }
    points = _points(pick, 100) + [(7000 + i, 41.0 + i / 2, 2.0 + j / 2) for i in range(12) for j in range(12)]
    for name, stations in cases.items():
        for per_tile in (1, 16):
            assert _got(spark, points, stations, per_tile=per_tile) == brute(points, stations), name


def test_no_stations_and_other_columns(spark):
    p = spark.createDataFrame([(1, 41.3, 2.0, "x", 5)], POINTS + ", _cell string, codi_estacio int")
    none = spark.createDataFrame([], STATIONS)
    assert nearest_station(p, none).count() == 0
    got = nearest_station(p, spark.createDataFrame([("A", 41.0, 2.0)], STATIONS), out="st").first()
    assert (got._cell, got.codi_estacio, got.st) == ("x", 5, "A")


def test_points_move_at_most_once(spark):
    """Only scans, the projection of the cell and the join with the index touch
    the points: broadcast here; one exchange of them without broadcasts."""
    pick = random.Random(3)
    stations = spark.createDataFrame([(f"S{i}", pick.uniform(41.3, 41.5), pick.uniform(2.0, 2.3)) for i in range(300)], STATIONS)
    points = spark.range(1000).select(F.col("id").alias("pid"), (41.3 + F.col("id") / 5000).alias("latitud_wgs84"), F.lit(2.1).alias("longitud_wgs84"))
    plan = nearest_station(points, stations)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Aggregate" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = nearest_station(points, stations)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and out.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_within_groups(spark):
    pick = random.Random(9)
    stations = [(f"S{i}", d, pick.uniform(41.3, 41.5), pick.uniform(2.0, 2.3)) for i in range(60) for d in range(5) if pick.random() < 0.4]
    points = [(i, i % 7, pick.uniform(41.2, 41.6), pick.uniform(1.9, 2.4)) for i in range(300)] + [(999, None, 41.4, 2.1)]
    s = spark.createDataFrame([*stations, ("N", None, 41.4, 2.1)], "codi_estacio string, day int, latitud_wgs84 double, longitud_wgs84 double")
    p = spark.createDataFrame(points, "pid long, on int, latitud_wgs84 double, longitud_wgs84 double")
    want = []
    for d in range(5):
        want += brute([(i, a, o) for i, on, a, o in points if on == d], [(c, a, o) for c, on, a, o in stations if on == d])
    got = nearest_station(p, s, out="st", distance_col="d", within={"on": "day"})
    assert sorted(((r.pid, r.st, r.d) for r in got.collect()), key=str) == sorted(want, key=str)


def test_fallback_to_the_next_nearest_with_a_reading(spark):
    a = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", 41.0, 2.0), (2, "2024-01-02 00:00:00", 41.0, 2.0), (3, "2024-01-03 23:00:00", 41.0, 2.0),
         (4, "2024-01-04 00:00:00", 41.0, 2.0), (5, None, 41.0, 2.0), (6, "2024-01-01 00:00:00", None, 2.0)],
        "numero_expedient long, t string, latitud_wgs84 double, longitud_wgs84 double",
    ).withColumn("data_accident", F.to_timestamp_ntz("t")).drop("t")
    wide = spark.createDataFrame(
        [("2024-01-01", "NEAR", 41.0, 2.01, 1.0), ("2024-01-01", "FAR", 41.0, 2.5, 2.0),
         ("2024-01-02", "FAR", 41.0, 2.5, 3.0), ("2024-01-02", "EVEN", 41.0, 1.5, 4.0),
         ("2024-01-03", "LOST", None, None, 5.0)],
        "d string, codi_estacio string, latitud_wgs84 double, longitud_wgs84 double, TM double",
    ).selectExpr("CAST(d AS DATE) AS data_lectura", "* EXCEPT (d)")
    located = enrich.located_on_day(a, wide)
    assert located.columns == [*a.columns, "meteo_estacio_proxima"]
    got = {r.numero_expedient: (r.meteo_estacio_proxima, r.TM) for r in enrich.join_daily_readings(located, wide).collect()}
    assert got == {1: ("NEAR", 1.0), 2: ("EVEN", 4.0)}  # the tie of day 2 goes to the smaller code
    persons = spark.createDataFrame([(1, 30), (2, 40), (2, 41)], "numero_expedient long, edat int")
    assert enrich.unify(a, persons, wide, fallback="next_nearest").count() == 3
    assert enrich.unify(a, persons, wide).count() == 1
    with pytest.raises(ValueError):
        enrich.unify(a, persons, wide, fallback="other")
