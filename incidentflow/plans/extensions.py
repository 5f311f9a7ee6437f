"""Queries of what the blueprint names beyond the reference's own operators:
spatial clusters and their risk, the area under the curve on time windows,
encoders of a range of dates, joins on a stored layout, models that are saved."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentflow.functions import labels as L
from incidentflow.ml import dated, monitor, saved
from incidentflow.operators import cluster, enrich, profile
from incidentflow.plans import catalog, standins, zones
from incidentflow.plans import model_table as MT
from incidentflow.plans import oracle as O
from incidentflow.plans.catalog import register
from incidentflow.session import materialise, scratch_path
from incidentflow.sources import layout

# --------------------------------------------------------------- clusters
CELL, LEAST = 0.004, 6

_CLUSTERS = {
    "k_points": f"SELECT *, {O.LABEL_SQL} AS accident_greu, CAST(floor(latitud_wgs84 / CAST({CELL} AS DOUBLE)) AS BIGINT) AS y, "
    f"CAST(floor(longitud_wgs84 / CAST({CELL} AS DOUBLE)) AS BIGINT) AS x FROM t_accidents_ts",
    "k_dense": f"SELECT y, x FROM k_points WHERE y IS NOT NULL AND x IS NOT NULL GROUP BY y, x HAVING COUNT(*) >= {LEAST}",
    "k_reach": "SELECT y, x, y AS ry, x AS rx FROM k_dense UNION SELECT d.y, d.x, r.ry, r.rx FROM k_reach r JOIN k_dense d ON abs(d.y - r.y) <= 1 AND abs(d.x - r.x) <= 1",
    "k_cells": "SELECT y, x, MIN((ry, rx)) AS c FROM k_reach GROUP BY y, x",
    "k_border": "SELECT p.y, p.x, MIN(c) AS c FROM (SELECT DISTINCT y, x FROM k_points) p JOIN k_cells d ON abs(d.y - p.y) <= 1 AND abs(d.x - p.x) <= 1 GROUP BY p.y, p.x",
    "k_out": "SELECT p.*, CASE WHEN coalesce(d.c, b.c) IS NOT NULL THEN concat(coalesce(d.c, b.c)[1], ':', coalesce(d.c, b.c)[2]) END AS cluster "
    "FROM k_points p LEFT JOIN k_cells d ON d.y = p.y AND d.x = p.x LEFT JOIN k_border b ON b.y = p.y AND b.x = p.x",
}


def _k(body: str) -> str:
    return O.with_ctes(body, _CLUSTERS).replace("WITH ", "WITH RECURSIVE ", 1)


def _clustered(spark, d):
    acc = zones.trusted_accidents(spark, d).withColumn("accident_greu", L.severity_label())
    return cluster.cluster_points(acc, CELL, LEAST)


@register("spatial_clusters", _k("SELECT numero_expedient, latitud_wgs84, longitud_wgs84, cluster FROM k_out"))
def spatial_clusters(spark, d):
    """The density cluster of every accident (null: noise or no place)."""
    return _clustered(spark, d).select("numero_expedient", "latitud_wgs84", "longitud_wgs84", "cluster")


@register(
    "cluster_risk",
    _k(
        "SELECT cluster, COUNT(*) AS volume, CAST(SUM(accident_greu) AS BIGINT) AS positives, ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS risk, "
        "MIN(latitud_wgs84) AS south, MAX(latitud_wgs84) AS north, MIN(longitud_wgs84) AS west, MAX(longitud_wgs84) AS east "
        "FROM k_out WHERE cluster IS NOT NULL GROUP BY cluster"
    ),
)
def cluster_risk(spark, d):
    return cluster.cluster_risk(_clustered(spark, d), "accident_greu").withColumn("risk", F.round("risk", 9))


# ---------------------------------------------------------------- windows
def _timed_scores(spark, d):
    acc = enrich.with_event_timestamp(standins.accidents(spark, d)).withColumn("label", L.severity_label())
    return acc.select(
        F.col("data_accident").alias("scored_at"), "label", ((F.col("numero_expedient") * 7919 % 1000) / F.lit(1000.0)).alias("score")
    )


@register(
    "auc_windows",
    O.with_ctes(
        "SELECT window_start, CAST(SUM(pos) AS BIGINT) AS pos, CAST(SUM(neg) AS BIGINT) AS neg, "
        "ROUND(CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN SUM(pos * (below + neg * 0.5)) / (SUM(pos) * SUM(neg)) END, 9) AS roc_auc, "
        "coalesce(ROUND(CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN SUM(pos * (below + neg * 0.5)) / (SUM(pos) * SUM(neg)) END, 9) < 0.9, false) AS alert "
        "FROM (SELECT *, coalesce(SUM(neg) OVER (PARTITION BY window_start ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
        "FROM (SELECT make_timestamp(nk_any, mes_any, dia_mes, 0, 0, 0) AS window_start, (numero_expedient * 7919 % 1000) / CAST(1000 AS DOUBLE) AS score, "
        f"SUM({O.LABEL_SQL}) AS pos, SUM(1 - {O.LABEL_SQL}) AS neg FROM s_accidents GROUP BY ALL)) GROUP BY window_start"
    ),
)
def auc_windows(spark, d):
    """The area under the ROC curve of every day's scores, alerted below 0.9."""
    out = monitor.auc_windows(_timed_scores(spark, d), "scored_at", "1 day")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---------------------------------------------------------------- layouts
@register("unify_persons_layout", catalog.SQL["unify_persons"])
def unify_persons_layout(spark, d):
    """Accidents and persons stored for their join: bucketed by accident, heavy
    accidents apart; the join moves no ordinary row."""
    acc = materialise(zones.trusted_accidents(spark, d), "layout-accidents")
    per = zones.trusted_persons(spark, d)
    per = materialise(per.select("numero_expedient", *[c for c in enrich.PERSON_COLUMNS if c in per.columns]), "layout-persons")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sides = [layout.write_layout(df, "numero_expedient", buckets) for df in (acc, per)]
    return layout.join_layouts(*sides).select(*acc.columns, *per.columns[1:])


# ------------------------------------------------------------------ dates
_RANGE = ("2024-01-08", "2024-01-15")


@register(
    "target_encode_dated",
    O.with_ctes(
        "SELECT numero_expedient, ROUND(ratio_greu_barri, 9) AS ratio_greu_barri FROM w_enc",
        {
            "w_all": f"SELECT *, {O.LABEL_SQL} AS accident_greu, CASE WHEN date_trunc('week', make_timestamp(nk_any, mes_any, dia_mes, 0, 0, 0)) "
            f"BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}' THEN 'train' ELSE 'other' END AS split FROM s_accidents",
            **O.te_ctes("w", "w_all"),
        },
    ),
)
def target_encode_dated(spark, d):
    """Every accident encoded by the statistics of two weeks, merged from what
    is kept per week (in two batches, as rows come in)."""
    acc = enrich.with_event_timestamp(standins.accidents(spark, d)).withColumn("accident_greu", L.severity_label())
    path, levels = scratch_path(spark, "dated"), MT.HIERARCHY
    for batch in (0, 1):
        dated.add_batch(acc.where(F.col("numero_expedient") % 2 == batch), path, f"b{batch}", levels, "accident_greu", "data_accident", "week")
    model = dated.encoder_for(spark, path, levels, *_RANGE)
    return model.transform(acc).select("numero_expedient", F.round("ratio_greu_barri", 9).alias("ratio_greu_barri"))


# ----------------------------------------------------------------- models
@register("saved_model_scores")
def saved_model_scores(spark, d):
    """Every prepared row scored by the model after it was saved and loaded."""
    _, spec, model, encoders, rows = catalog.fitted(spark, d)
    path = scratch_path(spark, "model")
    saved.save_model(saved.whole_pipeline(encoders, spec, model), path)
    return saved.score_rows(saved.load_model(path), rows).select("split", "numero_expedient", "accident_greu", "score")


# --------------------------------------------------------------- profiles
_TABLES = {
    "accidents": ("s_accidents", O.ACCIDENT_COLUMNS),
    "persons": ("s_persons", [("numero_expedient", "bigint"), ("desc_tipus_vehicle_implicat", "string"), ("edat", "double"),
                              ("descripcio_tipus_persona", "string"), ("descripcio_motiu_desplacament_conductor", "string")]),
    "readings": ("s_meteo", [("data_lectura", "date"), ("codi_estacio", "string"), ("acronim", "string"), ("valor", "double")]),
}


@register("full_profile", O.full_profile_sql(_TABLES))
def full_profile(spark, d):
    """All three tables, every column: types, rows, nulls, distinct values (and
    which, where they are few), numeric statistics."""
    return profile.full_profile({name: getattr(standins, name)(spark, d) for name in _TABLES})
