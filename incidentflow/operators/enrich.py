"""Enrichment: timestamps, station coordinates, reading pivot and the
accident + person + daily-reading integration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.operators.nearest import nearest_station

# The person attributes carried into the unified table.
PERSON_COLUMNS = [
    "desc_tipus_vehicle_implicat",
    "descripcio_sexe",
    "edat",
    "descripcio_tipus_persona",
    "descripcio_lloc_atropellament_vianant",
    "descripcio_motiu_desplacament_vianant",
    "descripcio_motiu_desplacament_conductor",
    "descripcio_victimitzacio",
]

READING_KEYS = ["data_lectura", "codi_estacio"]
COORD_COLUMNS = ["latitud_wgs84", "longitud_wgs84"]
MAX_PIVOT_VALUES = 1000


def event_timestamp(year: str = "nk_any", month: str = "mes_any", day: str = "dia_mes", hour: str = "hora_dia", strict: bool = True):
    """Timestamp (no zone) of year, month, day and hour; a missing hour is 0.

    ``strict`` raises on impossible dates (31 February) like the SQL
    function; ``strict=False`` gives NULL instead, for quarantine.
    """
    args = [F.col(year).cast("int"), F.col(month).cast("int"), F.col(day).cast("int"), F.coalesce(F.col(hour), F.lit(0)).cast("int"), F.lit(0), F.lit(0)]
    fn = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    return fn(*args)


def with_event_timestamp(df: DataFrame, out: str = "data_accident", strict: bool = True) -> DataFrame:
    return df.withColumn(out, event_timestamp(strict=strict))


def normalise_person_calendar(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rename the persons' ``nk__any``/``mes__any`` to the accident spelling
    and add the person's event timestamp."""
    renamed = df.withColumnsRenamed({"nk__any": "nk_any", "mes__any": "mes_any"})
    return with_event_timestamp(renamed, strict=strict)


def station_coords(catalogue: DataFrame, code: str = "CODI_ESTACIO", lat: str = "LATITUD", lon: str = "LONGITUD") -> DataFrame:
    """Distinct (station, latitude, longitude) of a catalogue whose grain is
    (station, acronym); rows without a station code are skipped."""
    return (
        catalogue.where(F.col(code).isNotNull())
        .select(
            F.col(code).alias("codi_estacio"),
            F.col(lat).cast("double").alias("latitud_wgs84"),
            F.col(lon).cast("double").alias("longitud_wgs84"),
        )
        .distinct()
    )


def attach_coords(df: DataFrame, coords: DataFrame) -> DataFrame:
    """Left join on the station code; a station without coordinates keeps
    NULLs.  The planner decides the strategy from measured sizes."""
    return df.join(coords, "codi_estacio", "left")


def pivot_values(readings: DataFrame, column: str = "acronim", max_values: int = MAX_PIVOT_VALUES) -> list[str]:
    """Sorted distinct non-NULL acronyms (one small aggregate job)."""
    vals = readings.where(F.col(column).isNotNull()).select(column).distinct().limit(max_values + 1).collect()
    if len(vals) > max_values:
        raise ValueError(f"more than {max_values} distinct values in {column}; pass them explicitly")
    return sorted(r[0] for r in vals)


def pivot_readings(readings: DataFrame, values: list[str] | None = None, upper_case: bool = True) -> DataFrame:
    """Long readings -> one row per (date, station), one column per acronym,
    the column holding the maximum reading of that acronym.

    Written as one aggregate of conditional maxima: a single shuffle with
    map-side partial aggregation (the two-step pivot plan needs two).
    ``upper_case`` folds acronyms so ``TM`` and ``tm`` cannot collide.
    """
    acr = F.upper(F.col("acronim")) if upper_case else F.col("acronim")
    readings = readings.withColumn("acronim", acr)
    values = pivot_values(readings) if values is None else values
    aggs = [F.max(F.when(F.col("acronim") == v, F.col("valor"))).alias(v) for v in values]
    return readings.groupBy(*READING_KEYS).agg(*aggs)


def readings_wide(readings: DataFrame, coords: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Pivoted readings with station coordinates.  Pivoting before the join
    is the same result as grouping on the joined coordinates, with the join
    applied to the (much smaller) aggregate."""
    wide = pivot_readings(readings, values)
    value_cols = [c for c in wide.columns if c not in READING_KEYS]
    return attach_coords(wide, coords).select(*READING_KEYS, *COORD_COLUMNS, *value_cols)


def meteo_stations(wide: DataFrame) -> DataFrame:
    """Stations that have readings and coordinates."""
    return (
        wide.where(F.col("latitud_wgs84").isNotNull() & F.col("longitud_wgs84").isNotNull())
        .select("codi_estacio", *COORD_COLUMNS)
        .distinct()
    )


def with_nearest_station(accidents: DataFrame, stations: DataFrame, **kwargs) -> DataFrame:
    return nearest_station(accidents, stations, out="meteo_estacio_proxima", **kwargs)


def located_on_day(accidents: DataFrame, wide: DataFrame, distance_col: str | None = None) -> DataFrame:
    """The nearest station among those with a reading on the accident's day:
    where the nearest of all has none, the next nearest that does, proven by
    the index of that day's stations rather than searched for in rounds.

    A wide row is a reading, even if all its values are null.  Accidents on a
    day without any reading by a station with coordinates, without a timestamp
    or without coordinates are dropped (the match is inner); ties go to the
    smaller code.
    """
    day = "_" * (1 + max(len(c) for c in accidents.columns)) + "day"
    dated = accidents.withColumn(day, F.to_date("data_accident"))
    stations = wide.select(F.col("data_lectura").cast("date").alias("day"), "codi_estacio", *COORD_COLUMNS)
    found = nearest_station(dated, stations, out="meteo_estacio_proxima", within={day: "day"}, distance_col=distance_col)
    return found.drop(day)


def join_daily_readings(located: DataFrame, wide: DataFrame, how: str = "inner") -> DataFrame:
    """Join each located accident to its nearest station's readings of the
    accident's day.  The wide table has one row per station and day; AQE
    broadcasts it at run time when it is small, so the accident side is not
    shuffled."""
    value_cols = [c for c in wide.columns if c not in READING_KEYS + COORD_COLUMNS]
    m = wide.select(
        F.col("data_lectura").alias("__day"),
        F.col("codi_estacio").alias("__station"),
        *value_cols,
        F.col("latitud_wgs84").alias("meteo_latitud_wgs84"),
        F.col("longitud_wgs84").alias("meteo_longitud_wgs84"),
    )
    keyed = located.withColumn("__day", F.to_date("data_accident"))
    cond = (keyed["__day"] == m["__day"]) & (keyed["meteo_estacio_proxima"] == m["__station"])
    return keyed.join(m, cond, how).drop("__day", "__station")


def unify(accidents: DataFrame, persons: DataFrame, wide: DataFrame, how: str = "inner", fallback: str | None = None) -> DataFrame:
    """One row per (accident, person) whose nearest station has a reading on
    the accident's day.

    ``accidents`` are the cleaned accidents (with ``data_accident``),
    ``persons`` the cleaned persons, ``wide`` the pivoted readings with
    coordinates.  Order of work: nearest station (an equi-join with its cells),
    daily readings (broadcast-sized join), then the one large shuffle join with
    persons.  ``fallback="next_nearest"`` takes the nearest station that has a
    reading on the accident's day (see :func:`located_on_day`).
    """
    if fallback not in (None, "next_nearest"):
        raise ValueError(f"unknown fallback {fallback!r}")
    located = located_on_day(accidents, wide) if fallback else with_nearest_station(accidents, meteo_stations(wide))
    with_weather = join_daily_readings(located, wide, how)
    return with_persons(with_weather, persons, accidents.columns, how)


def with_persons(with_weather: DataFrame, persons: DataFrame, acc_cols: list[str], how: str = "inner") -> DataFrame:
    """The accidents with their readings joined to the persons, columns in the
    unified table's order."""
    person_cols = [c for c in PERSON_COLUMNS if c in persons.columns]
    p = persons.select(F.col("numero_expedient").alias("__pk"), *person_cols)
    joined = with_weather.join(p, with_weather["numero_expedient"] == p["__pk"], how).drop("__pk")
    weather_cols = [c for c in with_weather.columns if c not in acc_cols and c != "meteo_estacio_proxima"]
    meteo_coords = ["meteo_latitud_wgs84", "meteo_longitud_wgs84"]
    value_cols = [c for c in weather_cols if c not in meteo_coords]
    return joined.select(*acc_cols, *person_cols, "meteo_estacio_proxima", *value_cols, *meteo_coords)
