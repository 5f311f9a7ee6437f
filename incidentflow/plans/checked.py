"""Queries that give operators a result to check: sources and zone tables read
back, quarantined rows, category groups, metrics by model, the model's scores and
contributions against what must hold of them."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from incidentflow.functions.labels import severity_label
from incidentflow.functions.mapping import MOTIVE_GROUPS, VEHICLE_GROUPS, apply_groupings
from incidentflow.ml import features as FE
from incidentflow.ml import metrics as ME
from incidentflow.ml import models as MO
from incidentflow.ml import saved
from incidentflow.operators import quality
from incidentflow.plans import catalog, standins
from incidentflow.plans import model_table as MT
from incidentflow.plans import oracle as O
from incidentflow.plans.catalog import register
from incidentflow.schemas import table_name_from_path
from incidentflow.session import materialise, scratch_path
from incidentflow.sources import detect, zones


# ------------------------------------------------------------- quarantine
def _quarantined(rejected):
    names = {c: F.array_join(c, ",") for c in ("violated_rules", "unknown_rules")}
    return rejected.withColumns(names)


@register("quarantine_accidents", O.quarantined_sql("p_accidents", [("victims_below_casualties", O._ACC_RULE)]))
def quarantine_accidents(spark, d):
    return _quarantined(quality.clean_accidents(standins.accidents(spark, d)).rejected)


@register("quarantine_persons", O.quarantined_sql("p_persons", O._PER_RULES))
def quarantine_persons(spark, d):
    return _quarantined(quality.clean_persons(standins.persons(spark, d)).rejected)


@register("quarantine_readings", O.quarantined_sql("p_meteo", O._MET_RULES))
def quarantine_readings(spark, d):
    return _quarantined(quality.clean_readings(standins.readings(spark, d)).rejected)


# ---------------------------------------------------------------- sources
@register("csv_detected_readings", O.with_ctes("SELECT *, 't2025_lectures' AS source_table FROM s_meteo"))
def csv_detected_readings(spark, d):
    """The readings written as a CSV and read back under the types found in
    it, with the table name of the file."""
    path = f"{scratch_path(spark, 'csv')}/2025_Lectures.csv"
    standins.readings(spark, d).write.option("header", True).csv(path)
    return detect.read_detected(spark, path).withColumn("source_table", F.lit(table_name_from_path(path)))


@register("zone_round_trip", O.with_ctes("SELECT 'persons' AS table_name, * FROM s_persons"))
def zone_round_trip(spark, d):
    """The persons saved under their declared types, copied sorted to another
    zone and read back from every table that zone lists."""
    roots = [scratch_path(spark, f"zone{k}") for k in range(2)]
    persons = standins.persons(spark, d)
    texts = persons.select(*[F.col(c).cast("string").alias(c) for c in persons.columns])
    zones.save_typed(texts, persons.schema, zones.zone_table_path(roots[0], "persons"))
    source = zones.read_zone_table(spark, roots[0], "persons")
    zones.write_table(source, zones.zone_table_path(roots[1], "sorted"), sort_within=["numero_expedient"])
    zones.copy_table(spark, zones.zone_table_path(roots[1], "sorted"), zones.zone_table_path(roots[0], "copied"))
    names = zones.list_tables(spark, roots[0])
    # the copy and the original are the same rows: each table's name for one of them
    back = zones.read_zone_table(spark, roots[0], names[0])
    return back.select(F.lit(names[1]).alias("table_name"), *persons.columns)


# ------------------------------------------------------------- categories
def _listed(mapping: dict[str, str]) -> list[str]:
    return [*mapping, "Una altra cosa"]


def _quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _grouped_sql() -> str:
    def one(column, mapping, key):
        values = _listed(mapping)
        groups = [mapping.get(v, v) for v in values]
        at = f"CAST({key} % {len(values)} AS INT) + 1"
        return f"({_quoted(values)})[{at}] AS {column}_abans, ({_quoted(groups)})[{at}] AS {column}"

    return (
        f"SELECT l_orderkey, l_linenumber, {one('desc_tipus_vehicle_implicat', VEHICLE_GROUPS, 'l_partkey')}, "
        f"{one('descripcio_motiu_desplacament_conductor', MOTIVE_GROUPS, 'l_suppkey')} FROM lineitem"
    )


@register("grouped_categories", _grouped_sql())
def grouped_categories(spark, d):
    """The vehicle and motive groups of the source's own dictionaries, over
    values of these dictionaries dealt to the persons (and one they lack)."""
    rows = spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dealt = {"desc_tipus_vehicle_implicat": (VEHICLE_GROUPS, "l_partkey"), "descripcio_motiu_desplacament_conductor": (MOTIVE_GROUPS, "l_suppkey")}
    for column, (mapping, key) in dealt.items():
        values = _listed(mapping)
        value = F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))
        rows = rows.withColumns({column: value, f"{column}_abans": value})
    return apply_groupings(rows).drop("l_partkey", "l_suppkey")


@register(
    "category_risk_common",
    catalog._m(
        "SELECT descripcio_motiu_desplacament_conductor AS category, COUNT(accident_greu) AS volumen, "
        "ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS tasa_graves FROM u_split "
        "WHERE split = 'train' AND descripcio_motiu_desplacament_conductor IS NOT NULL "
        "GROUP BY descripcio_motiu_desplacament_conductor HAVING COUNT(accident_greu) > 20"
    ),
)
def category_risk_common(spark, d):
    """Risk of the motives with more than 20 rows, the default volume."""
    train = MT.split_rows(spark, d).where(F.col("split") == "train")
    return FE.category_risk(train, "descripcio_motiu_desplacament_conductor").withColumn("tasa_graves", F.round("tasa_graves", 9))


# ---------------------------------------------------------------- metrics
def _two_models(spark, d):
    """The synthetic score and a second one, as two models' scores."""
    rows = materialise(standins.scored_rows(spark, d), "scored-rows")
    other = rows.withColumn("score", (F.col("row_key") * 104729 % 1000) / F.lit(1000.0))
    return rows.select(F.lit("first").alias("model"), "*").unionByName(other.select(F.lit("second").alias("model"), "*"))


def _mm(body: str, more: dict[str, str] | None = None) -> str:
    both = (
        "SELECT 'first' AS model, split, row_key, label, score FROM scored UNION ALL "
        "SELECT 'second', split, row_key, label, (row_key * 104729 % 1000) / CAST(1000 AS DOUBLE) FROM scored"
    )
    # the metrics' own SQL, over groups of a model and a split
    by_model = {"m_scored": both}
    for name in ("sc", "sweep_raw", "sweep", "ranked", "auc", "ap"):
        sql = O.SCORED[name].replace("s.split", "s.model, s.split").replace("PARTITION BY split", "PARTITION BY model, split")
        sql = sql.replace("GROUP BY split", "GROUP BY model, split").replace("SELECT split", "SELECT model, split")
        by_model[f"m_{name}"] = re.sub(r"FROM (scored|sweep_raw|sweep|sc)\b", r"FROM m_\1", sql)
    return O.with_ctes(body, catalog._MODEL, catalog._MET, by_model, more or {})


@register(
    "metric_summary_by_model",
    _mm(
        "SELECT s.model, s.split, s.threshold, a.roc_auc, p.average_precision, s.f1, s.precision, s.recall FROM m_sweep s "
        "JOIN (SELECT model, threshold AS t FROM m_ranked WHERE split = 'val' AND rank = 1) b ON s.threshold = b.t AND s.model = b.model "
        "JOIN m_auc a ON a.split = s.split AND a.model = s.model JOIN m_ap p ON p.split = s.split AND p.model = s.model"
    ),
)
def metric_summary_by_model(spark, d):
    return ME.metric_summary(_two_models(spark, d), "split", "val", model="model")


@register(
    "reports_at_chosen_threshold",
    _mm(
        O.report_sql().replace("SELECT split,", "SELECT model, split,").replace("FROM cm", "FROM m_cm"),
        {
            "m_at": "SELECT s.model, s.split, s.label, s.score >= b.threshold AS pos FROM m_scored s "
            "JOIN m_ranked b ON b.model = s.model AND b.split = 'val' AND b.rank = 1",
            "m_cm": "SELECT model, split, COUNT(*) FILTER (WHERE label = 0 AND NOT pos) AS tn, COUNT(*) FILTER (WHERE label = 0 AND pos) AS fp, "
            "COUNT(*) FILTER (WHERE label = 1 AND NOT pos) AS fn, COUNT(*) FILTER (WHERE label = 1 AND pos) AS tp FROM m_at GROUP BY model, split",
        },
    ),
)
def reports_at_chosen_threshold(spark, d):
    """Classification report of every model and split at the threshold that is
    best for the model on the validation rows."""
    scored = materialise(_two_models(spark, d), "two-models")
    chosen = ME.chosen_thresholds(scored, "split", "val", "model")
    decided = ME.at_chosen_threshold(scored, chosen, "model").withColumn("margin", F.col("score") - F.col("threshold"))
    return ME.classification_report(decided, ["model", "split"], 0.0, score="margin")


@register(
    "risk_by_place_and_hour",
    catalog._m(
        "SELECT nom_barri, hora_dia, COUNT(accident_greu) AS volumen, ROUND(AVG(CAST(accident_greu AS DOUBLE)), 9) AS tasa_graves "
        "FROM a_lab WHERE nom_barri IS NOT NULL AND hora_dia IS NOT NULL GROUP BY nom_barri, hora_dia HAVING COUNT(accident_greu) > 20"
    ),
)
def risk_by_place_and_hour(spark, d):
    """Risk by neighbourhood and hour, where there are more than 20 accidents."""
    acc = standins.accidents(spark, d).withColumn("accident_greu", severity_label())
    return FE.risk_by(acc, ["nom_barri", "hora_dia"]).withColumn("tasa_graves", F.round("tasa_graves", 9))


# ----------------------------------------------------------------- models
@register("score_checks", catalog._m("SELECT split, COUNT(*) AS n_rows, COUNT(*) AS n_probabilities, COUNT(*) AS n_same_when_loaded FROM u_split GROUP BY split"))
def score_checks(spark, d):
    """Per split: rows, rows whose score is a probability, and rows that the
    model scores the same after it was saved and loaded."""
    rows, spec, model, encoders, prepared = catalog.fitted(spark, d)
    path = scratch_path(spark, "model")
    saved.save_model(saved.whole_pipeline(encoders, spec, model), path)
    numbered = materialise(prepared.withColumn("row", F.monotonically_increasing_id()), "prepared-numbered")
    encoded = numbered
    for e in encoders:
        encoded = e.transform(encoded)
    here = MO.score(model, encoded, spec).select("row", F.col("score").alias("here"))
    there = saved.score_rows(saved.load_model(path), numbered).select("row", "split", "score")
    same = there.join(here, "row")
    return same.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("score").between(0, 1)).alias("n_probabilities"),
        F.count_if(F.col("score") == F.col("here")).alias("n_same_when_loaded"),
    )


@register(
    "contribution_checks",
    catalog._m("SELECT split, COUNT(*) AS n_rows, COUNT(*) AS n_adding_up, COUNT(*) AS n_margins FROM u_split WHERE split = 'train' GROUP BY split"),
)
def contribution_checks(spark, d):
    """Per split: training rows, those whose bias and contributions add up to
    the margin, and those whose margin is the log-odds of the score."""
    rows, spec, model, *_ = catalog.fitted(spark, d)
    train = materialise(rows.where(F.col("split") == "train").withColumn("row", F.monotonically_increasing_id()), "train-numbered")
    from incidentflow.ml import contributions as CO

    parts = CO.contributions(model.transform(MO.add_missing_indicators(train, spec)), model.stages[-1], ["row", "split"])
    scored = MO.score(model, train, spec).select("row", "score")
    added = F.col("bias") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return parts.join(scored, "row").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(added - F.col("margin")) < 1e-9).alias("n_adding_up"),
        F.count_if(F.abs(F.log(F.col("score") / (1 - F.col("score"))) - F.col("margin")) < 1e-6).alias("n_margins"),
    )
