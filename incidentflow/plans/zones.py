"""The zone tables of the stand-in data, built from the driver tables:
trusted (cleaned) accidents, persons and readings, wide readings, unified."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.operators import enrich, quality
from incidentflow.plans import standins
from incidentflow.session import materialise


# The stand-in readings can only produce these acronyms (see
# ``standins.ACRONYM_OF_EVENT``), so the pivot is given its columns instead
# of discovering them with an extra job.
STANDIN_ACRONYMS = sorted({*standins.ACRONYM_OF_EVENT.values(), standins.OTHER_ACRONYM})


def trusted_accidents(spark: SparkSession, d: str) -> DataFrame:
    return enrich.with_event_timestamp(quality.clean_accidents(standins.accidents(spark, d)).valid)


def trusted_persons(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_persons(standins.persons(spark, d)).valid


def trusted_readings(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_readings(standins.readings(spark, d)).valid


def wide_readings(spark: SparkSession, d: str) -> DataFrame:
    """Pivot of the readings that pass the rules.  The pivot keeps the
    maximum per acronym, which repeated rows cannot change, so the full-row
    de-duplication of the trusted table is skipped here: same values, one
    shuffle of the readings fewer."""
    checked = quality.apply_rules(standins.readings(spark, d), quality.reading_rules()).valid
    return enrich.readings_wide(checked, standins.stations(spark, d), values=STANDIN_ACRONYMS)


def wide_readings_table(spark: SparkSession, d: str) -> DataFrame:
    """The wide readings written once as a zone table (one row per station
    and day).  Joins against it then see its real file size: the planner
    broadcasts it when it is under the broadcast threshold and uses a
    shuffle join when it is not, and the station list and the join read the
    table instead of re-running the pivot."""
    return materialise(wide_readings(spark, d), "readings_wide")


def located_accidents(spark: SparkSession, d: str, wide: DataFrame) -> DataFrame:
    return enrich.with_nearest_station(trusted_accidents(spark, d), enrich.meteo_stations(wide))


def unified_columns(spark: SparkSession, d: str) -> DataFrame:
    """An empty frame with the unified table's columns, known without running
    any of its joins."""
    wide = wide_readings(spark, d).limit(0)
    located = trusted_accidents(spark, d).limit(0).withColumn("meteo_estacio_proxima", F.lit(""))
    return enrich.with_persons(enrich.join_daily_readings(located, wide), trusted_persons(spark, d).limit(0), located.columns[:-1])


def unified(spark: SparkSession, d: str) -> DataFrame:
    return enrich.unify(trusted_accidents(spark, d), trusted_persons(spark, d), wide_readings_table(spark, d))
