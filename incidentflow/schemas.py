"""Explicit schemas of the zone tables and one naming rule for every zone."""

from __future__ import annotations

import os
import re

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


ACCIDENTS = _struct(
    ("numero_expedient", S),
    ("codi_districte", S),
    ("nom_districte", S),
    ("codi_barri", S),
    ("nom_barri", S),
    ("codi_carrer", S),
    ("nom_carrer", S),
    ("num_postal", S),
    ("descripcio_dia_setmana", S),
    ("nk_any", I),
    ("mes_any", I),
    ("nom_mes", S),
    ("dia_mes", I),
    ("hora_dia", I),
    ("descripcio_causa_vianant", S),
    ("numero_morts", I),
    ("numero_lesionats_lleus", I),
    ("numero_lesionats_greus", I),
    ("numero_victimes", I),
    ("coordenada_utm_x_ed50", D),
    ("coordenada_utm_y_ed50", D),
    ("longitud_wgs84", D),
    ("latitud_wgs84", D),
)

# The persons file spells the calendar columns with a double underscore; the
# formatted zone renames them (see ``operators.enrich.normalise_person_calendar``).
PERSONS = _struct(
    ("numero_expedient", S),
    ("nk__any", I),
    ("mes__any", I),
    ("dia_mes", I),
    ("hora_dia", I),
    ("desc_tipus_vehicle_implicat", S),
    ("descripcio_sexe", S),
    ("edat", I),
    ("descripcio_tipus_persona", S),
    ("descripcio_lloc_atropellament_vianant", S),
    ("descripcio_motiu_desplacament_vianant", S),
    ("descripcio_motiu_desplacament_conductor", S),
    ("descripcio_victimitzacio", S),
)

READINGS = _struct(
    ("data_lectura", T.DateType()),
    ("codi_estacio", S),
    ("acronim", S),
    ("valor", D),
)

# Station catalogue: one row per (station, acronym).  Codes keep leading zeros,
# so they are text; the closing date holds the text NA in every row.
STATION_CATALOGUE = _struct(
    ("CODI_ESTACIO", S),
    ("NOM_ESTACIO", S),
    ("EMPLACAMENT", S),
    ("CODI_BARRI", S),
    ("NOM_BARRI", S),
    ("CODI_DISTRICTE", S),
    ("NOM_DISTRICTE", S),
    ("CODI_MUNICIPI", S),
    ("NOM_MUNICIPI", S),
    ("CODI_COMARCA", I),
    ("NOM_COMARCA", S),
    ("CODI_PROVINCIA", I),
    ("NOM_PROVINCIA", S),
    ("ALTITUD", I),
    ("LATITUD", D),
    ("LONGITUD", D),
    ("CODI_XARXA", I),
    ("NOM_XARXA", S),
    ("CODI_ESTAT", I),
    ("DATA_ALTA", T.DateType()),
    ("DATA_BAIXA", T.DateType()),
    ("ACRÒNIM", S),
)

RESOURCE_CATALOGUE = _struct(
    ("api_link", S),
    ("resource_id", S),
    ("name", S),
    ("format", S),
    ("url", S),
)

SCORED_ROWS = T.StructType(
    [
        T.StructField("split", S, True),
        T.StructField("row_key", T.LongType(), True),
        T.StructField("label", I, True),
        T.StructField("score", D, True),
    ]
)

# The names of the three yearly inputs and the zone tables.
ACCIDENTS_TABLE = "accidents"
PERSONS_TABLE = "persons"
READINGS_TABLE = "readings"
UNIFIED_TABLE = "unified"


def table_name_from_path(path: str) -> str:
    """One naming rule for every zone: file stem, lower case, leading year kept
    as a prefix word, anything outside ``[a-z0-9_]`` folded to ``_``.

    ``../in/2025_Accidents-City.csv`` -> ``t2025_accidents_city``; a glob
    (``../accidents/*.csv``) is named after its folder.
    """
    trimmed = path.rstrip("/")
    base = os.path.basename(trimmed)
    if any(ch in base for ch in "*?["):
        base = os.path.basename(os.path.dirname(trimmed))
    stem = os.path.splitext(base)[0].lower()
    stem = re.sub(r"[^a-z0-9_]+", "_", stem).strip("_")
    if stem[:1].isdigit():
        stem = "t" + stem
    return stem
