"""The modelling table of the stand-in data: unified rows, label, group-aware
split, leakage and policy drops, rain flag, category groupings, train-only
target and ordinal encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.functions.labels import flag_from_measure, severity_label
from incidentflow.functions.mapping import apply_groupings
from incidentflow.ml import features as FE
from incidentflow.operators.sampling import group_split
from incidentflow.plans import zones
from incidentflow.session import materialise

LABEL = "accident_greu"
KEY = "numero_expedient"

# Category groupings for the stand-in values (vehicle column
# holds part type words, motive column holds brands).
STANDIN_GROUPINGS = {
    "desc_tipus_vehicle_implicat": {
        "ECONOMY": "Grup_Economic",
        "STANDARD": "Grup_Economic",
        "PROMO": "Grup_Promocio",
        "SMALL": "Grup_Petit",
    },
    "descripcio_motiu_desplacament_conductor": {
        "Brand#12": "Motiu_A",
        "Brand#13": "Motiu_A",
        "Brand#21": "Motiu_B",
        "Desconegut": "Desconegut",
    },
}
HIERARCHY = ["nom_districte", "nom_barri"]


def labeled_unified(spark: SparkSession, d: str) -> DataFrame:
    return zones.unified(spark, d).withColumn(LABEL, severity_label())


def split_rows(spark: SparkSession, d: str, materialised: bool = True) -> DataFrame:
    """Unified rows with the label and the accident-level (group) split.
    The unified table is written once first: the split reads it several
    times (group table, strata counts, join back)."""
    base = labeled_unified(spark, d)
    if materialised:
        base = materialise(base, "unified")
    return group_split(base, KEY, ["nom_barri"], LABEL)


def prepared_rows(spark: SparkSession, d: str) -> DataFrame:
    """Leakage and policy drops (the key is kept as row id), rain flag,
    groupings.  Still categorical; nothing fitted yet."""
    rows = split_rows(spark, d).drop(*FE.LEAKAGE_COLUMNS)
    rows = FE.apply_policy(rows, keep=[KEY])
    rows = rows.withColumn("hi_ha_pluja", flag_from_measure("PPT")).drop(*FE.NOISY_COLUMNS)
    return apply_groupings(rows, STANDIN_GROUPINGS)


def target_encoder(rows: DataFrame):
    enc = FE.HierarchicalTargetEncoder(levelCols=HIERARCHY, labelCol=LABEL, outputCol="ratio_greu_barri")
    return enc.fit(rows.where(F.col("split") == "train"))


def target_encoded(rows: DataFrame) -> DataFrame:
    return target_encoder(rows).transform(rows)


def materialised_rows(spark: SparkSession, d: str) -> DataFrame:
    """Prepared rows written once to the shared checkpoint folder: the fits
    and transforms that follow read them instead of re-running the joins."""
    return materialise(prepared_rows(spark, d), "model_rows")


def encode(rows: DataFrame) -> tuple[list, DataFrame]:
    """The encoders fitted on the training rows, and all rows encoded."""
    te = target_encoder(rows)
    out = te.transform(rows).drop(*HIERARCHY)
    cats = FE.categorical_columns(out, exclude=["split"])
    oe = FE.OrdinalEncoder(inputCols=cats).fit(out.where(F.col("split") == "train"))
    return [te, oe], oe.transform(out)


def encoded_rows(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """Fully encoded rows: numeric features, label, split and key."""
    return encode(materialised_rows(spark, d) if rows is None else rows)[1]


def feature_columns(df: DataFrame) -> list[str]:
    skip = {LABEL, "split", KEY, "weight"}
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in skip and t in numeric]
