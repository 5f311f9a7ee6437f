"""The registered queries: one DataFrame builder and (where SQL can say it)
one DuckDB SQL twin per operator of the blueprint.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables of that
folder through the stand-in projections, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.functions import labels as L
from incidentflow.functions.mapping import map_or_keep as _map_or_keep
from incidentflow.ml import contributions as CO
from incidentflow.ml import features as FE
from incidentflow.ml import metrics as ME
from incidentflow.ml import models as MO
from incidentflow.operators import enrich, profile, quality, sampling
from incidentflow.operators.ordered import row_numbers
from incidentflow.plans import model_table as MT
from incidentflow.plans import oracle as O
from incidentflow.plans import standins, zones
from incidentflow.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# ----------------------------------------------------------- 1. integration
@register(
    "station_coords",
    O.with_ctes(
        "SELECT DISTINCT CODI_ESTACIO AS codi_estacio, CAST(LATITUD AS DOUBLE) AS latitud_wgs84, "
        "CAST(LONGITUD AS DOUBLE) AS longitud_wgs84 FROM s_catalogue WHERE CODI_ESTACIO IS NOT NULL"
    ),
)
def station_coords(spark, d):
    return enrich.station_coords(standins.station_catalogue(spark, d), lat="LATITUD", lon="LONGITUD")


@register("pivot_readings", O.with_ctes("SELECT * FROM t_meteo_wide"))
def pivot_readings(spark, d):
    return zones.wide_readings(spark, d)


@register(
    "left_join_coords",
    O.with_ctes(
        "SELECT m.*, c.latitud_wgs84, c.longitud_wgs84 FROM t_meteo m "
        "LEFT JOIN s_stations c ON m.codi_estacio = c.codi_estacio"
    ),
)
def left_join_coords(spark, d):
    return enrich.attach_coords(zones.trusted_readings(spark, d), standins.stations(spark, d))


def _nearest(spark, d, **index):
    wide = zones.wide_readings_table(spark, d)
    located = enrich.with_nearest_station(
        zones.trusted_accidents(spark, d), enrich.meteo_stations(wide), distance_col="dist_sq", **index
    )
    return located.select("numero_expedient", "meteo_estacio_proxima", "dist_sq")


@register("nearest_station", O.with_ctes("SELECT * FROM nearest"))
def nearest_station(spark, d):
    return _nearest(spark, d)


@register("nearest_station_grid", O.with_ctes("SELECT * FROM nearest"))
def nearest_station_grid(spark, d):
    """The same through an index with many tiles of few stations."""
    return _nearest(spark, d, per_tile=2)


@register(
    "unify_persons",
    O.with_ctes(
        "SELECT a.*, p.desc_tipus_vehicle_implicat, p.edat, p.descripcio_tipus_persona, "
        "p.descripcio_motiu_desplacament_conductor FROM t_accidents_ts a JOIN t_persons p "
        "ON a.numero_expedient = p.numero_expedient"
    ),
)
def unify_persons(spark, d):
    acc = zones.trusted_accidents(spark, d)
    per = zones.trusted_persons(spark, d).withColumnRenamed("numero_expedient", "__pk")
    person_cols = [c for c in enrich.PERSON_COLUMNS if c in per.columns]
    return acc.join(per, acc.numero_expedient == per.__pk).select(*acc.columns, *person_cols)


@register("join_daily_readings", O.with_ctes("SELECT * FROM with_weather"))
def join_daily_readings(spark, d):
    wide = zones.wide_readings_table(spark, d)
    return enrich.join_daily_readings(zones.located_accidents(spark, d, wide), wide)


@register("join_daily_readings_fallback", O.with_ctes("SELECT * FROM with_weather_fallback"))
def join_daily_readings_fallback(spark, d):
    """Readings of the nearest station that has any on the accident's day."""
    wide = zones.wide_readings_table(spark, d)
    return enrich.join_daily_readings(enrich.located_on_day(zones.trusted_accidents(spark, d), wide), wide)


@register("unified", O.with_ctes("SELECT * FROM unified"))
def unified(spark, d):
    return zones.unified(spark, d)


@register("surrogate_key", O.with_ctes("SELECT *, row_number() OVER (ORDER BY numero_expedient) - 1 AS accident_row_id FROM t_accidents_ts"))
def surrogate_key(spark, d):
    """Row id that can be recomputed: the row's number in key order, counted
    within ranges of the key (no single-task sort)."""
    acc = zones.trusted_accidents(spark, d)
    return row_numbers(acc, [], [F.col("numero_expedient")], "__n").withColumn("accident_row_id", F.col("__n") - 1).drop("__n")


@register(
    "star_except_rename",
    O.with_ctes(
        "SELECT * EXCLUDE (nk__any, mes__any), nk__any AS nk_any, mes__any AS mes_any, "
        "make_timestamp(CAST(nk__any AS INTEGER), CAST(mes__any AS INTEGER), CAST(dia_mes AS INTEGER), "
        "CAST(COALESCE(hora_dia, 0) AS INTEGER), 0, 0) AS data_accident FROM s_persons_cal"
    ),
)
def star_except_rename(spark, d):
    return enrich.normalise_person_calendar(standins.persons_with_calendar(spark, d))


# --------------------------------------------------------------- 2. quality
@register(
    "impute_text",
    O.with_ctes(
        "SELECT * REPLACE (COALESCE(descripcio_motiu_desplacament_conductor, 'Desconegut') "
        "AS descripcio_motiu_desplacament_conductor) FROM s_persons"
    ),
)
def impute_text(spark, d):
    return quality.fill_text(standins.persons(spark, d))


@register(
    "impute_zero",
    O.with_ctes(
        "SELECT * REPLACE (COALESCE(numero_morts, 0) AS numero_morts, "
        "COALESCE(numero_lesionats_lleus, 0) AS numero_lesionats_lleus, "
        "COALESCE(numero_lesionats_greus, 0) AS numero_lesionats_greus, "
        "COALESCE(numero_victimes, 0) AS numero_victimes) FROM s_accidents"
    ),
)
def impute_zero(spark, d):
    return quality.fill_zero(standins.accidents(spark, d))


@register("dedup_rows", O.with_ctes("SELECT DISTINCT * FROM s_persons"))
def dedup_rows(spark, d):
    return quality.dedup_rows(standins.persons(spark, d))


@register("denial_sum_rule", O.with_ctes("SELECT * FROM t_accidents"))
def denial_sum_rule(spark, d):
    return quality.clean_accidents(standins.accidents(spark, d)).valid


@register("denial_age_rule", O.with_ctes("SELECT * FROM t_persons"))
def denial_age_rule(spark, d):
    return quality.clean_persons(standins.persons(spark, d)).valid


@register("denial_range_by_prefix", O.with_ctes("SELECT * FROM t_meteo"))
def denial_range_by_prefix(spark, d):
    return quality.clean_readings(standins.readings(spark, d)).valid


@register("quarantine_counts", O.quarantine_sql())
def quarantine_counts(spark, d):
    return quality.quarantine_counts(
        {
            "accidents": quality.prepared_for_rules("accidents", standins.accidents(spark, d)),
            "persons": quality.prepared_for_rules("persons", standins.persons(spark, d)),
            "readings": quality.prepared_for_rules("readings", standins.readings(spark, d)),
        }
    )


# --------------------------------------------------------------- 3. profile


@register("null_profile", O.null_profile_sql())
def null_profile(spark, d):
    return profile.null_profile(standins.accidents(spark, d), "accidents")


@register("numeric_profile", O.numeric_profile_sql())
def numeric_profile(spark, d):
    return profile.numeric_profile(standins.accidents(spark, d), "accidents")


@register("distinct_profile", O.distinct_profile_sql())
def distinct_profile(spark, d):
    return profile.distinct_profile(standins.accidents(spark, d), "accidents")


@register("distinct_with_null", O.distinct_with_null_sql())
def distinct_with_null(spark, d):
    return profile.distinct_with_null(standins.accidents(spark, d), "accidents")


@register("low_card_values", O.low_card_values_sql())
def low_card_values(spark, d):
    return profile.low_card_values(standins.accidents(spark, d), "accidents")


@register("numeric_summary", O.numeric_summary_sql())
def numeric_summary(spark, d):
    return profile.numeric_summary(standins.accidents(spark, d), "accidents")


@register("table_profile", O.table_profile_sql())
def table_profile(spark, d):
    return profile.table_profile({"accidents": standins.accidents(spark, d)})


@register("describe_table", O.describe_sql("accidents", O.with_ctes("SELECT * FROM s_accidents")))
def describe_table(spark, d):
    return profile.describe_table(standins.accidents(spark, d), "accidents")


@register("preview_topn", O.with_ctes("SELECT * FROM s_accidents ORDER BY numero_expedient LIMIT 5"))
def preview_topn(spark, d):
    from incidentflow.sources.zones import preview

    return preview(standins.accidents(spark, d), 5, order_by=["numero_expedient"])


# ------------------------------------------------------------ 8. sources
@register("resource_catalogue", O.resource_catalogue_sql("/en/"))
def resource_catalogue(spark, d):
    from incidentflow.sources.resources import select_resources

    return select_resources(standins.resource_catalogue(spark, d), "/en/")


# ---------------------------------------------------- 4. labels and splits

_MODEL = O.model_ctes(MT.STANDIN_GROUPINGS)


def _m(body: str) -> str:
    return O.with_ctes(body, _MODEL)


def _labeled_accidents(spark, d):
    return standins.accidents(spark, d).withColumn("accident_greu", L.severity_label())


def _split_accidents(spark, d):
    return sampling.stratified_split(_labeled_accidents(spark, d), "numero_expedient", ["nom_barri"], "accident_greu")


@register("label_rule", _m("SELECT numero_expedient, numero_morts, numero_lesionats_greus, accident_greu FROM a_lab"))
def label_rule(spark, d):
    return _labeled_accidents(spark, d).select("numero_expedient", "numero_morts", "numero_lesionats_greus", "accident_greu")


@register("split_strata", _m("SELECT numero_expedient, stratum FROM a_strata"))
def split_strata(spark, d):
    return sampling.build_strata(_labeled_accidents(spark, d), ["nom_barri"], "accident_greu").select("numero_expedient", "stratum")


@register("stratified_split", _m("SELECT numero_expedient, nom_barri, accident_greu, split FROM a_split"))
def stratified_split(spark, d):
    return _split_accidents(spark, d).select("numero_expedient", "nom_barri", "accident_greu", "split")


@register(
    "group_split",
    _m("SELECT numero_expedient, desc_tipus_vehicle_implicat, edat, descripcio_tipus_persona, accident_greu, split FROM u_split"),
)
def group_split(spark, d):
    return MT.split_rows(spark, d).select(
        "numero_expedient", "desc_tipus_vehicle_implicat", "edat", "descripcio_tipus_persona", "accident_greu", "split"
    )


@register(
    "hash_sample",
    _m(
        "SELECT numero_expedient, nom_barri, accident_greu FROM a_lab "
        "ORDER BY md5('42:' || CAST(numero_expedient AS VARCHAR)), numero_expedient LIMIT 500"
    ),
)
def hash_sample(spark, d):
    return sampling.hash_sample(_labeled_accidents(spark, d), "numero_expedient", 500).select(
        "numero_expedient", "nom_barri", "accident_greu"
    )


@register(
    "stratified_folds",
    _m(
        "SELECT numero_expedient, accident_greu, CAST((row_number() OVER (PARTITION BY accident_greu "
        "ORDER BY md5('42:' || CAST(numero_expedient AS VARCHAR)), numero_expedient) - 1) % 3 AS INTEGER) AS fold "
        "FROM a_split WHERE split = 'train'"
    ),
)
def stratified_folds(spark, d):
    train = _split_accidents(spark, d).where(F.col("split") == "train")
    return sampling.stratified_folds(train, "numero_expedient", "accident_greu", 3).select("numero_expedient", "accident_greu", "fold")


@register(
    "split_summary",
    _m(
        'SELECT split, COUNT(*) AS "rows", ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS accident_greu_rate, '
        "COUNT(DISTINCT nom_barri) AS n_barris FROM a_split GROUP BY split"
    ),
)
def split_summary(spark, d):
    return _split_accidents(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.col("accident_greu").cast("double")), 9).alias("accident_greu_rate"),
        F.count_distinct("nom_barri").alias("n_barris"),
    )


@register(
    "split_sanity",
    _m(
        'SELECT split, COUNT(*) AS "rows", ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS target_rate, '
        "CAST(SUM(accident_greu) AS BIGINT) AS positive_count FROM u_split GROUP BY split"
    ),
)
def split_sanity(spark, d):
    return MT.split_rows(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.col("accident_greu").cast("double")), 9).alias("target_rate"),
        F.sum(F.col("accident_greu").cast("long")).alias("positive_count"),
    )


@register(
    "label_distribution",
    _m(
        "SELECT s.split, l.accident_greu, CAST(COALESCE(c.n, 0) AS BIGINT) AS n, "
        "COALESCE(c.n, 0) / CAST(s.total AS DOUBLE) AS share "
        "FROM (SELECT split, COUNT(*) AS total FROM a_split GROUP BY split) s "
        "CROSS JOIN (VALUES (0), (1)) l(accident_greu) "
        "LEFT JOIN (SELECT split, accident_greu, COUNT(*) AS n FROM a_split GROUP BY split, accident_greu) c "
        "ON c.split = s.split AND c.accident_greu = l.accident_greu"
    ),
)
def label_distribution(spark, d):
    """Per split, count and share of each label value, absent values as 0:
    one aggregate per split, then two rows per split (no join)."""
    agg = _split_accidents(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("accident_greu") == 0).alias("n0"),
        F.count_if(F.col("accident_greu") == 1).alias("n1"),
    )
    rows = F.inline(F.array(*[F.struct(F.lit(v).alias("accident_greu"), F.col(f"n{v}").alias("n")) for v in (0, 1)]))
    return agg.select("split", "total", rows).select(
        "split", "accident_greu", "n", (F.col("n") / F.col("total")).alias("share")
    )


@register("projection_policy", O.policy_sql(FE.SELECTION_POLICY, O.with_ctes("SELECT * FROM u_split", O.model_ctes(MT.STANDIN_GROUPINGS))))
def projection_policy(spark, d):
    # only the names count: nothing is run for them
    return FE.projection_policy(zones.unified_columns(spark, d).withColumns({"accident_greu": F.lit(0), "split": F.lit("")}))


# ------------------------------------------------------------- 5. features
@register(
    "flag_from_measure",
    O.with_ctes("SELECT data_lectura, codi_estacio, PPT, CAST(COALESCE(PPT, 0) > 0 AS INTEGER) AS hi_ha_pluja FROM t_meteo_wide"),
)
def flag_from_measure(spark, d):
    return zones.wide_readings(spark, d).select("data_lectura", "codi_estacio", "PPT", L.flag_from_measure("PPT").alias("hi_ha_pluja"))


@register(
    "map_or_keep",
    O.with_ctes(
        "SELECT numero_expedient, "
        + O._case_map("desc_tipus_vehicle_implicat", MT.STANDIN_GROUPINGS["desc_tipus_vehicle_implicat"])
        + " AS desc_tipus_vehicle_implicat, "
        + O._case_map("descripcio_motiu_desplacament_conductor", MT.STANDIN_GROUPINGS["descripcio_motiu_desplacament_conductor"])
        + " AS descripcio_motiu_desplacament_conductor, edat, descripcio_tipus_persona FROM t_persons"
    ),
)
def map_or_keep(spark, d):
    p = zones.trusted_persons(spark, d)
    g = MT.STANDIN_GROUPINGS
    return p.select(
        "numero_expedient",
        _map_or_keep("desc_tipus_vehicle_implicat", g["desc_tipus_vehicle_implicat"]).alias("desc_tipus_vehicle_implicat"),
        _map_or_keep("descripcio_motiu_desplacament_conductor", g["descripcio_motiu_desplacament_conductor"]).alias(
            "descripcio_motiu_desplacament_conductor"
        ),
        "edat",
        "descripcio_tipus_persona",
    )


@register(
    "category_risk",
    _m(
        "SELECT desc_tipus_vehicle_implicat AS category, COUNT(accident_greu) AS volumen, "
        "ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS tasa_graves FROM u_split "
        "WHERE split = 'train' AND desc_tipus_vehicle_implicat IS NOT NULL "
        "GROUP BY desc_tipus_vehicle_implicat HAVING COUNT(accident_greu) > 0"
    ),
)
def category_risk(spark, d):
    train = MT.split_rows(spark, d).where(F.col("split") == "train")
    return FE.category_risk(train, "desc_tipus_vehicle_implicat", min_volume=0).withColumn(
        "tasa_graves", F.round("tasa_graves", 9)
    )


@register(
    "target_encode",
    _m("SELECT numero_expedient, split, ROUND(ratio_greu_barri, 9) AS ratio_greu_barri FROM ate_enc"),
)
def target_encode(spark, d):
    rows = _split_accidents(spark, d)
    return MT.target_encoded(rows).select("numero_expedient", "split", F.round("ratio_greu_barri", 9).alias("ratio_greu_barri"))


@register("ordinal_encode", _m("SELECT * FROM u_enc"))
def ordinal_encode(spark, d):
    return MT.encoded_rows(spark, d)


@register(
    "class_weight",
    _m(
        "SELECT CAST(SUM(accident_greu) AS BIGINT) AS positive_count, "
        "CAST(COUNT(accident_greu) - SUM(accident_greu) AS BIGINT) AS negative_count, "
        "(COUNT(accident_greu) - SUM(accident_greu)) / CAST(SUM(accident_greu) AS DOUBLE) AS scale_pos_weight "
        "FROM u_split WHERE split = 'train'"
    ),
)
def class_weight(spark, d):
    return FE.class_weight(MT.split_rows(spark, d).where(F.col("split") == "train"), "accident_greu")


# -------------------------------------------------------------- 6. metrics

_MET = {**O.SCORED}


def _s(body: str) -> str:
    return O.with_ctes(body, _MODEL, _MET)


def _scored(spark, d):
    return standins.scored_rows(spark, d)


@register(
    "apply_threshold",
    _s("SELECT split, row_key, label, score, CAST(score >= CAST(0.5 AS DOUBLE) AS INTEGER) AS pred FROM scored"),
)
def apply_threshold(spark, d):
    return _scored(spark, d).withColumn("pred", L.apply_threshold("score", 0.5))


@register(
    "confusion_matrix",
    _s(
        "SELECT c.split, l.label, p.pred, CAST(CASE WHEN l.label = 0 AND p.pred = 0 THEN tn WHEN l.label = 0 THEN fp "
        "WHEN p.pred = 0 THEN fn ELSE tp END AS BIGINT) AS n FROM cm c CROSS JOIN (VALUES (0), (1)) l(label) "
        "CROSS JOIN (VALUES (0), (1)) p(pred)"
    ),
)
def confusion_matrix(spark, d):
    return ME.confusion_matrix(_scored(spark, d), ["split"], 0.5)


@register("classification_report", _s(O.report_sql()))
def classification_report(spark, d):
    return ME.classification_report(_scored(spark, d), ["split"], 0.5)


@register("roc_auc", _s("SELECT * FROM auc"))
def roc_auc(spark, d):
    return ME.roc_auc(_scored(spark, d), ["split"])


@register("average_precision", _s("SELECT * FROM ap"))
def average_precision(spark, d):
    return ME.average_precision(_scored(spark, d), ["split"])


@register(
    "roc_points",
    _s(
        "SELECT split, score AS threshold, CASE WHEN NN > 0 THEN cum_neg / CAST(NN AS DOUBLE) ELSE 0.0 END AS fpr, "
        "CASE WHEN PP > 0 THEN cum_pos / CAST(PP AS DOUBLE) ELSE 0.0 END AS tpr FROM ("
        "SELECT *, SUM(pos) OVER w AS cum_pos, SUM(neg) OVER w AS cum_neg, SUM(pos) OVER (PARTITION BY split) AS PP, "
        "SUM(neg) OVER (PARTITION BY split) AS NN FROM sc WINDOW w AS (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) "
        "UNION ALL SELECT DISTINCT split, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM sc"
    ),
)
def roc_points(spark, d):
    return ME.roc_points(_scored(spark, d), ["split"])


@register("threshold_sweep", _s("SELECT * FROM sweep"))
def threshold_sweep(spark, d):
    return ME.threshold_sweep(_scored(spark, d), ["split"])


@register("best_threshold", _s("SELECT * EXCLUDE (rank) FROM ranked WHERE rank = 1"))
def best_threshold(spark, d):
    return ME.best_threshold(ME.threshold_sweep(_scored(spark, d), ["split"]), ["split"])


@register("topk_thresholds", _s("SELECT * FROM ranked WHERE rank <= 10"))
def topk_thresholds(spark, d):
    return ME.topk_thresholds(ME.threshold_sweep(_scored(spark, d), ["split"]), ["split"], 10)


@register(
    "metric_summary",
    _s(
        "SELECT s.split, s.threshold, a.roc_auc, p.average_precision, s.f1, s.precision, s.recall FROM sweep s "
        "JOIN (SELECT threshold AS t FROM ranked WHERE split = 'val' AND rank = 1) b ON s.threshold = b.t "
        "JOIN auc a ON a.split = s.split JOIN ap p ON p.split = s.split"
    ),
)
def metric_summary(spark, d):
    return ME.metric_summary(_scored(spark, d), "split", "val")


# ---------------------------------------------------------------- 7. models

# The model queries use the library's defaults: 400 trees, and for the random
# search 20 draws x 3 folds of 200-800 trees.


def _model_inputs(spark, d, prepared=None):
    prepared = MT.materialised_rows(spark, d) if prepared is None else prepared
    encoders, rows = MT.encode(prepared)
    rows = materialise(rows, "encoded_rows")
    spec = MO.build_spec(rows, MT.feature_columns(rows), F.col("split") == "train")
    return rows, spec, encoders


# Rows, features, model and encoders of a folder, fitted once in a session.
_FITTED: dict[tuple[str, str], tuple] = {}


def fitted(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        prepared = MT.materialised_rows(spark, d)
        rows, spec, encoders = _model_inputs(spark, d, prepared)
        model, _ = MO.fit_gbt(rows.where(F.col("split") == "train"), spec)
        _FITTED[key] = (rows, spec, model, encoders, prepared)
    return _FITTED[key]


@register("gbt_scores")
def gbt_scores(spark, d):
    rows, spec, model, *_ = fitted(spark, d)
    return MO.score(model, rows, spec).select("split", "numero_expedient", "accident_greu", "score")


@register("random_search")
def random_search(spark, d):
    rows, spec, _ = _model_inputs(spark, d)
    train = sampling.group_folds(rows.where(F.col("split") == "train"), "numero_expedient", "accident_greu", 3)
    table, _, _ = MO.random_search(train, spec, "fold")
    return table


def _contributions(spark, d):
    rows, spec, model, *_ = fitted(spark, d)
    train = rows.where(F.col("split") == "train")
    feats = model.transform(MO.add_missing_indicators(train, spec))
    return CO.contributions(feats, model.stages[-1], ["numero_expedient", "split"]), spec


@register("contributions")
def contributions(spark, d):
    return _contributions(spark, d)[0]


@register("importance")
def importance(spark, d):
    contribs, spec = _contributions(spark, d)
    return CO.importance(contribs, spec.names)
