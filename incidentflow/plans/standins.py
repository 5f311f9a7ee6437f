"""Stand-in inputs projected from the driver's TPC-H-like tables.

Roles: order = accident, lineitem = person involved, event = weather reading,
supplier = station, nation = neighbourhood, region = district.  NULLs are
injected on purpose so the NULL semantics of every rule are exercised.  The
same projections exist as SQL text in ``plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.session import read_table

# Joins with the small dimensions (nation, region, part, stations) are left to
# the planner: it broadcasts a side only when its measured size (file
# statistics, and AQE's run-time shuffle statistics) is under
# spark.sql.autoBroadcastJoinThreshold, and shuffles otherwise.


def _int(c: Column) -> Column:
    return c.cast("int")


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("nom_barri"), F.col("r_name").alias("nom_districte")
    )
    k = F.col("o_orderkey")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("numero_expedient"),
            "nom_districte",
            "nom_barri",
            F.lit(2024).alias("nk_any"),
            F.lit(1).alias("mes_any"),
            _int(1 + k % 30).alias("dia_mes"),
            _int(F.when(k % 25 != 24, k % 25)).alias("hora_dia"),
            _int(F.when(k % 97 == 0, 1).otherwise(F.when(k % 5 - 1 != 0, 0))).alias("numero_morts"),
            _int(k % 3).alias("numero_lesionats_lleus"),
            _int(F.when((F.col("o_orderpriority") == "1-URGENT") & (k % 4 == 0), 1).otherwise(0)).alias(
                "numero_lesionats_greus"
            ),
            _int(k % 4).alias("numero_victimes"),
            # decimal literals on purpose: the same exact arithmetic as the SQL text
            F.expr(
                "CASE WHEN o_orderkey % 50 = 0 THEN NULL "
                "ELSE CAST(41.32 + (o_orderkey * 7919 % 1000) * 0.00015 AS DOUBLE) END"
            ).alias("latitud_wgs84"),
            F.expr("CAST(2.07 + (o_orderkey * 104729 % 1000) * 0.00015 AS DOUBLE)").alias("longitud_wgs84"),
        )
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    flag = F.col("l_returnflag")
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("numero_expedient"),
        F.col("p_type").alias("desc_tipus_vehicle_implicat"),
        F.expr("CAST(NULLIF(l_quantity, 7.0) * 2.5 AS DOUBLE)").alias("edat"),
        F.when(flag == "R", "Conductor").when(flag == "A", "Vianant").alias("descripcio_tipus_persona"),
        F.when(F.col("p_brand") != "Brand#11", F.col("p_brand")).alias("descripcio_motiu_desplacament_conductor"),
    )


def persons_with_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons as the raw file spells them: ``nk__any``/``mes__any`` plus day
    and hour, so the calendar rename and the person timestamp can be shown."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    k = F.col("l_orderkey")
    return lineitem.select(
        k.alias("numero_expedient"),
        F.lit(2024).alias("nk__any"),
        F.lit(1).alias("mes__any"),
        _int(1 + k % 30).alias("dia_mes"),
        _int(F.when(k % 25 != 24, k % 25)).alias("hora_dia"),
        F.col("l_linenumber").alias("ordre_persona"),
        F.col("l_quantity").alias("edat"),
    )


ACRONYM_OF_EVENT = {
    # Event type -> reading acronym of the stand-in readings.
    "click": "TM",
    "view": "HRM",
    "purchase": "PPT",
    "error": "DVM10",
}
OTHER_ACRONYM = "RS24H"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    acronym = F.lit(OTHER_ACRONYM)
    for event_type, code in reversed(list(ACRONYM_OF_EVENT.items())):
        acronym = F.when(F.col("event_type") == event_type, code).otherwise(acronym)
    return events.select(
        F.to_date("ts").alias("data_lectura"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("codi_estacio"),
        acronym.alias("acronim"),
        F.when(F.col("event_id") % 41 != 0, F.col("value") - 20).alias("valor"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier is a station, spread over the accidents' area.  Some
    readings come from stations that are not among them."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    return supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("codi_estacio"),
        F.expr("CAST(41.32 + (s_suppkey * 7907 % 1000) * 0.00015 AS DOUBLE)").alias("latitud_wgs84"),
        F.expr("CAST(2.07 + (s_suppkey * 104711 % 1000) * 0.00015 AS DOUBLE)").alias("longitud_wgs84"),
    )


def station_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue grain (one row per station and acronym), like the shipped CSV:
    the acronyms each station reports, joined to the station's coordinates."""
    reported = readings(spark, sf_dir).select(
        F.col("codi_estacio").alias("CODI_ESTACIO"), F.col("acronim").alias("ACRONIM")
    ).distinct()
    coords = stations(spark, sf_dir).select(
        F.col("codi_estacio").alias("CODI_ESTACIO"),
        F.col("latitud_wgs84").alias("LATITUD"),
        F.col("longitud_wgs84").alias("LONGITUD"),
    )
    return reported.join(coords, "CODI_ESTACIO")


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the metric operators: label of the severity rule, a synthetic
    score with ties on purpose, and the hash split of the accidents."""
    from incidentflow.functions.labels import severity_label
    from incidentflow.operators.sampling import stratified_split

    acc = accidents(spark, sf_dir).withColumn("label", severity_label())
    split = stratified_split(acc, key="numero_expedient", strata_cols=["nom_barri"], label="label")
    return split.select(
        "split",
        F.col("numero_expedient").alias("row_key"),
        "label",
        ((F.col("numero_expedient") * 7919 % 1000) / F.lit(1000.0)).alias("score"),
    )


# Formats given to the stand-in resources by page id modulo 3.
RESOURCE_FORMATS = ["CSV", "JSON", "text/csv"]


def resource_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-data resource catalogue stand-in: one resource per web page, its
    id taken from the link's ``page`` query parameter (else the page id), its
    name from the page title."""
    from incidentflow.sources.resources import resource_id_of

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    fmt = F.element_at(F.array(*[F.lit(f) for f in RESOURCE_FORMATS]), (F.col("page_id") % 3 + 1).cast("int"))
    return pages.select(
        F.col("url").alias("api_link"),
        F.coalesce(resource_id_of("url", "page"), F.col("page_id").cast("string")).alias("resource_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"),
        fmt.alias("format"),
        F.col("url"),
    )
