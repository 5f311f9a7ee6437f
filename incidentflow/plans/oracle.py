"""DuckDB SQL text for the correctness check: stand-ins and shared CTEs.

Every query of ``plans.catalog`` has its SQL twin here, built on the same
stand-in projections of the driver tables.
"""

from __future__ import annotations

# Acronyms the stand-in readings produce, in sorted order.
STANDIN_ACRONYMS = ["DVM10", "HRM", "PPT", "RS24H", "TM"]

STANDINS = {
    "s_accidents": """
SELECT o.o_orderkey AS numero_expedient,
       r.r_name AS nom_districte, n.n_name AS nom_barri,
       2024 AS nk_any, 1 AS mes_any,
       CAST(1 + o.o_orderkey % 30 AS INT) AS dia_mes,
       CAST(NULLIF(o.o_orderkey % 25, 24) AS INT) AS hora_dia,
       CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN 1 ELSE NULLIF(0, o.o_orderkey % 5 - 1) END AS INT) AS numero_morts,
       CAST(o.o_orderkey % 3 AS INT) AS numero_lesionats_lleus,
       CAST(CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS INT) AS numero_lesionats_greus,
       CAST(o.o_orderkey % 4 AS INT) AS numero_victimes,
       CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CAST(41.32 + (o.o_orderkey * 7919 % 1000) * 0.00015 AS DOUBLE) END AS latitud_wgs84,
       CAST(2.07 + (o.o_orderkey * 104729 % 1000) * 0.00015 AS DOUBLE) AS longitud_wgs84
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              JOIN nation n ON c.c_nationkey = n.n_nationkey
              JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "s_persons": """
SELECT l.l_orderkey AS numero_expedient, p.p_type AS desc_tipus_vehicle_implicat,
       CAST(NULLIF(l.l_quantity, 7.0) * 2.5 AS DOUBLE) AS edat,
       CASE WHEN l.l_returnflag = 'R' THEN 'Conductor' WHEN l.l_returnflag = 'A' THEN 'Vianant' END AS descripcio_tipus_persona,
       NULLIF(p.p_brand, 'Brand#11') AS descripcio_motiu_desplacament_conductor
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "s_persons_cal": """
SELECT l.l_orderkey AS numero_expedient, 2024 AS nk__any, 1 AS mes__any,
       CAST(1 + l.l_orderkey % 30 AS INT) AS dia_mes,
       CAST(NULLIF(l.l_orderkey % 25, 24) AS INT) AS hora_dia,
       l.l_linenumber AS ordre_persona, l.l_quantity AS edat
FROM lineitem l""",
    "s_meteo": """
SELECT CAST(ts AS DATE) AS data_lectura, CONCAT('S', CAST(user_id AS STRING)) AS codi_estacio,
       CASE event_type WHEN 'click' THEN 'TM' WHEN 'view' THEN 'HRM' WHEN 'purchase' THEN 'PPT' WHEN 'error' THEN 'DVM10' ELSE 'RS24H' END AS acronim,
       CASE WHEN event_id % 41 <> 0 THEN value - 20 END AS valor
FROM events""",
    "s_stations": """
SELECT CONCAT('S', CAST(s_suppkey AS STRING)) AS codi_estacio,
       CAST(41.32 + (s_suppkey * 7907 % 1000) * 0.00015 AS DOUBLE) AS latitud_wgs84,
       CAST(2.07 + (s_suppkey * 104711 % 1000) * 0.00015 AS DOUBLE) AS longitud_wgs84
FROM supplier""",
    "s_resources": """
SELECT url AS api_link,
       COALESCE(NULLIF(TRIM(regexp_extract(url, '[?&]page=([^&#]*)', 1)), ''), CAST(page_id AS VARCHAR)) AS resource_id,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS name,
       CASE page_id % 3 WHEN 0 THEN 'CSV' WHEN 1 THEN 'JSON' ELSE 'text/csv' END AS format,
       url
FROM pages""",
    "s_catalogue": """
SELECT r.CODI_ESTACIO, r.ACRONIM, s.latitud_wgs84 AS LATITUD, s.longitud_wgs84 AS LONGITUD
FROM (SELECT DISTINCT codi_estacio AS CODI_ESTACIO, acronim AS ACRONIM FROM s_meteo) r
JOIN s_stations s ON r.CODI_ESTACIO = s.codi_estacio""",
}

_ACC_RULE = "numero_victimes < numero_morts + numero_lesionats_lleus + numero_lesionats_greus"
_PER_RULES = [
    ("driver_under_min_age", "descripcio_tipus_persona = 'Conductor' AND edat < 14"),
    ("age_negative", "edat < 0"),
    ("age_over_max", "edat > 110"),
]
_MET_RULES = [
    ("temperature_range", "starts_with(acronim, 'T') AND (valor < -10 OR valor > 42)"),
    ("humidity_range", "starts_with(acronim, 'H') AND (valor < 0 OR valor > 100)"),
    ("precipitation_negative", "starts_with(acronim, 'PP') AND valor < 0"),
    ("wind_direction_range", "starts_with(acronim, 'D') AND (valor < 0 OR valor > 360)"),
]


def _or(rules):
    return " OR ".join(f"({r})" for _, r in rules)


def _pivot_cols():
    return ",\n       ".join(
        f"MAX(CASE WHEN upper(acronim) = '{a}' THEN valor END) AS \"{a}\"" for a in STANDIN_ACRONYMS
    )


_DIST = (
    "(a.latitud_wgs84 - s.latitud_wgs84) * (a.latitud_wgs84 - s.latitud_wgs84)"
    " + (a.longitud_wgs84 - s.longitud_wgs84) * (a.longitud_wgs84 - s.longitud_wgs84)"
)

TRUSTED = {
    "p_accidents": """
SELECT * REPLACE (COALESCE(numero_morts, 0) AS numero_morts,
                  COALESCE(numero_lesionats_lleus, 0) AS numero_lesionats_lleus,
                  COALESCE(numero_lesionats_greus, 0) AS numero_lesionats_greus,
                  COALESCE(numero_victimes, 0) AS numero_victimes)
FROM (SELECT DISTINCT * FROM s_accidents)""",
    "t_accidents": f"SELECT * FROM p_accidents WHERE NOT ({_ACC_RULE})",
    "t_accidents_ts": """
SELECT *, make_timestamp(CAST(nk_any AS INTEGER), CAST(mes_any AS INTEGER), CAST(dia_mes AS INTEGER),
                         CAST(COALESCE(hora_dia, 0) AS INTEGER), 0, 0) AS data_accident
FROM t_accidents""",
    "p_persons": """
SELECT * REPLACE (COALESCE(descripcio_motiu_desplacament_conductor, 'Desconegut') AS descripcio_motiu_desplacament_conductor)
FROM (SELECT DISTINCT * FROM s_persons)""",
    "t_persons": f"SELECT * FROM p_persons WHERE NOT ({_or(_PER_RULES)})",
    "p_meteo": "SELECT DISTINCT * FROM s_meteo",
    "t_meteo": f"SELECT * FROM p_meteo WHERE NOT ({_or(_MET_RULES)})",
    "t_meteo_wide": f"""
SELECT w.data_lectura, w.codi_estacio, c.latitud_wgs84, c.longitud_wgs84,
       {", ".join(f'w."{a}"' for a in STANDIN_ACRONYMS)}
FROM (SELECT data_lectura, codi_estacio,
       {_pivot_cols()}
      FROM t_meteo GROUP BY data_lectura, codi_estacio) w
LEFT JOIN s_stations c ON w.codi_estacio = c.codi_estacio""",
    "m_stations": """
SELECT DISTINCT codi_estacio, latitud_wgs84, longitud_wgs84 FROM t_meteo_wide
WHERE latitud_wgs84 IS NOT NULL AND longitud_wgs84 IS NOT NULL""",
    "nearest": f"""
SELECT numero_expedient, codi_estacio AS meteo_estacio_proxima, d AS dist_sq FROM (
  SELECT numero_expedient, codi_estacio, d,
         row_number() OVER (PARTITION BY numero_expedient ORDER BY d, codi_estacio) AS rn
  FROM (SELECT a.numero_expedient, s.codi_estacio, {_DIST} AS d
        FROM t_accidents_ts a JOIN m_stations s
          ON a.latitud_wgs84 IS NOT NULL AND a.longitud_wgs84 IS NOT NULL)
) WHERE rn = 1""",
    "located": """
SELECT a.*, n.meteo_estacio_proxima FROM t_accidents_ts a JOIN nearest n USING (numero_expedient)""",
    "with_weather": f"""
SELECT l.*, {", ".join(f'm."{a}"' for a in STANDIN_ACRONYMS)},
       m.latitud_wgs84 AS meteo_latitud_wgs84, m.longitud_wgs84 AS meteo_longitud_wgs84
FROM located l JOIN t_meteo_wide m
  ON m.data_lectura = CAST(l.data_accident AS DATE) AND m.codi_estacio = l.meteo_estacio_proxima""",
    "with_weather_fallback": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT a.*, m.codi_estacio AS meteo_estacio_proxima, {", ".join(f'm."{a}"' for a in STANDIN_ACRONYMS)},
         m.latitud_wgs84 AS meteo_latitud_wgs84, m.longitud_wgs84 AS meteo_longitud_wgs84,
         row_number() OVER (PARTITION BY a.numero_expedient ORDER BY {_DIST.replace("s.", "m.")}, m.codi_estacio) AS rn
  FROM t_accidents_ts a JOIN t_meteo_wide m
    ON m.data_lectura = CAST(a.data_accident AS DATE)
   AND a.latitud_wgs84 IS NOT NULL AND a.longitud_wgs84 IS NOT NULL AND m.latitud_wgs84 IS NOT NULL AND m.longitud_wgs84 IS NOT NULL)
WHERE rn = 1""",
    "unified": """
SELECT w.*, p.desc_tipus_vehicle_implicat, p.edat, p.descripcio_tipus_persona,
       p.descripcio_motiu_desplacament_conductor
FROM with_weather w JOIN t_persons p ON w.numero_expedient = p.numero_expedient""",
}


def with_ctes(body: str, *groups: dict[str, str]) -> str:
    ctes = {}
    for g in (STANDINS, TRUSTED) + groups:
        ctes.update(g)
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body


def rule_counts_sql(table: str, source: str, rules) -> str:
    parts = []
    for name, pred in rules:
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS rule_name, "
            f"CAST(COUNT(*) FILTER (WHERE ({pred})) AS BIGINT) AS n_violated, "
            f"CAST(COUNT(*) FILTER (WHERE ({pred}) IS NULL) AS BIGINT) AS n_unknown FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def quarantine_sql() -> str:
    body = "\nUNION ALL\n".join(
        [
            rule_counts_sql("accidents", "p_accidents", [("victims_below_casualties", _ACC_RULE)]),
            rule_counts_sql("persons", "p_persons", _PER_RULES),
            rule_counts_sql("readings", "p_meteo", _MET_RULES),
        ]
    )
    return with_ctes(body)


def quarantined_sql(source: str, rules) -> str:
    """The rows that a rule rejects or cannot judge, with the rules' names."""
    named = lambda test: "concat_ws(',', " + ", ".join(f"CASE WHEN {test.format(f'({p})')} THEN '{n}' END" for n, p in rules) + ")"
    return with_ctes(
        f"SELECT *, {named('{}')} AS violated_rules, {named('{} IS NULL')} AS unknown_rules FROM {source} WHERE ({_or(rules)}) IS NOT FALSE"
    )


# ------------------------------------------------------------------ profile
# (column, Spark type name) of the stand-in accidents, in order.
ACCIDENT_COLUMNS = [
    ("numero_expedient", "bigint"),
    ("nom_districte", "string"),
    ("nom_barri", "string"),
    ("nk_any", "int"),
    ("mes_any", "int"),
    ("dia_mes", "int"),
    ("hora_dia", "int"),
    ("numero_morts", "int"),
    ("numero_lesionats_lleus", "int"),
    ("numero_lesionats_greus", "int"),
    ("numero_victimes", "int"),
    ("latitud_wgs84", "double"),
    ("longitud_wgs84", "double"),
]
_NUMERIC = [c for c, t in ACCIDENT_COLUMNS if t in ("bigint", "int", "double")]


def _u(parts):
    return with_ctes("\nUNION ALL\n".join(parts))


def null_profile_sql(table="accidents", source="s_accidents"):
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
            f"CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*) * 100 "
            f"ELSE CAST(0 AS DOUBLE) END AS null_pct FROM {source}"
            for c, _ in ACCIDENT_COLUMNS
        ]
    )


def numeric_profile_sql(table="accidents", source="s_accidents"):
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_val, "
            f"CAST(MAX({c}) AS DOUBLE) AS max_val, ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS avg_val, "
            f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS std_val FROM {source} HAVING MIN({c}) IS NOT NULL"
            for c in _NUMERIC
        ]
    )


def distinct_profile_sql(table="accidents", source="s_accidents"):
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct FROM {source}"
            for c, _ in ACCIDENT_COLUMNS
        ]
    )


def distinct_with_null_sql(table="accidents", source="s_accidents"):
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"CAST(COUNT(DISTINCT {c}) + COALESCE(MAX(CAST({c} IS NULL AS BIGINT)), 0) AS BIGINT) AS n_distinct_with_null FROM {source}"
            for c, _ in ACCIDENT_COLUMNS
        ]
    )


def low_card_values_sql(table="accidents", source="s_accidents"):
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct, "
            f"CASE WHEN COUNT(DISTINCT {c}) <= 10 THEN (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) "
            f"FROM (SELECT DISTINCT {c} AS v FROM {source} WHERE {c} IS NOT NULL)) END AS distinct_values, "
            f"COALESCE(bool_or({c} IS NULL), false) AS has_null FROM {source} HAVING COUNT(DISTINCT {c}) < 50"
            for c, _ in ACCIDENT_COLUMNS
        ]
    )


def numeric_summary_sql(table="accidents", source="s_accidents"):
    q = ", ".join(
        f"ROUND(quantile_cont(CAST({{c}} AS DOUBLE), {p}), 9) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75)
    )
    return _u(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT({c}) AS \"count\", "
            f"ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS \"min\", " + q.format(c=c) + f", CAST(MAX({c}) AS DOUBLE) AS \"max\" "
            f"FROM {source} HAVING COUNT({c}) > 0"
            for c in _NUMERIC
        ]
    )


def _profile_rows(table, source, columns, more=None):
    parts = []
    for i, (c, t) in enumerate(columns):
        if t in ("bigint", "int", "double"):
            stats = (
                f"CAST(MIN({c}) AS DOUBLE) AS min_val, CAST(MAX({c}) AS DOUBLE) AS max_val, "
                f"ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS avg_val, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS std_val"
            )
        else:
            stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("min_val", "max_val", "avg_val", "std_val"))
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{t}' AS column_type, {i + 1} AS ordinal, "
            f"COUNT(*) AS row_count, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
            f"CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*) * 100 "
            f"ELSE CAST(0 AS DOUBLE) END AS null_pct, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct, "
            f"{stats}{more(c) if more else ''} FROM {source}"
        )
    return parts


def table_profile_sql(table="accidents", source="s_accidents"):
    return _u(_profile_rows(table, source, ACCIDENT_COLUMNS))


def full_profile_sql(tables):
    parts = []
    for table, (source, columns) in tables.items():
        listed = lambda c: (
            f", {len(columns)} AS n_columns, CASE WHEN COUNT(DISTINCT {c}) <= 10 THEN (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) "
            f"FROM (SELECT DISTINCT {c} AS v FROM {source} WHERE {c} IS NOT NULL)) END AS distinct_values"
        )
        parts += _profile_rows(table, source, columns, listed)
    return _u(parts)


def resource_catalogue_sql(target="/en/"):
    name = "COALESCE(NULLIF(name, ''), CONCAT(resource_id, '.csv'))"
    cleaned = f"regexp_replace(TRIM({name}), '[^\\p{{L}}\\p{{N}}_.\\-]+', '_', 'g')"
    return with_ctes(
        f"SELECT resource_id, CASE WHEN ends_with(lower({cleaned}), '.csv') THEN {cleaned} "
        f"ELSE CONCAT({cleaned}, '.csv') END AS file_name, TRIM(url) AS url FROM s_resources "
        f"WHERE contains(lower(concat_ws(' ', COALESCE(name, ''), COALESCE(url, ''))), '{target}') "
        f"AND contains(lower(COALESCE(format, '')), 'csv') AND length(TRIM(COALESCE(url, ''))) > 0"
    )


# ------------------------------------------------------- labels and splits
LABEL_SQL = "CAST((COALESCE(numero_morts, 0) > 0 OR COALESCE(numero_lesionats_greus, 0) > 0) AS INTEGER)"


def split_ctes(p: str, source: str, key: str = "numero_expedient", strata: str = "nom_barri", label: str = "accident_greu") -> dict[str, str]:
    return {
        f"{p}_raw": f"SELECT *, COALESCE(CAST({strata} AS VARCHAR), 'None') || '__' || CAST({label} AS VARCHAR) AS __raw FROM {source}",
        f"{p}_strata": f"SELECT * EXCLUDE (__raw), CASE WHEN COUNT(*) OVER (PARTITION BY __raw) < 3 "
        f"THEN 'rare__' || CAST({label} AS VARCHAR) ELSE __raw END AS stratum FROM {p}_raw",
        f"{p}_ranked": f"SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || CAST({key} AS VARCHAR)), {key}) AS __rn, "
        f"COUNT(*) OVER (PARTITION BY stratum) AS __n FROM {p}_strata",
        f"{p}_split": f"SELECT * EXCLUDE (__rn, __n, stratum), CASE WHEN __rn <= (70 * __n + 50) // 100 THEN 'train' "
        f"WHEN __rn <= (85 * __n + 50) // 100 THEN 'val' ELSE 'test' END AS split FROM {p}_ranked",
    }


def te_ctes(p: str, source: str) -> dict[str, str]:
    return {
        f"{p}_train": f"SELECT * FROM {source} WHERE split = 'train'",
        f"{p}_g": f"SELECT AVG(CAST(accident_greu AS DOUBLE)) AS g FROM {p}_train",
        f"{p}_d": f"SELECT nom_districte, (SUM(accident_greu) + 20 * (SELECT g FROM {p}_g)) / (COUNT(accident_greu) + 20) AS r_d "
        f"FROM {p}_train WHERE nom_districte IS NOT NULL GROUP BY nom_districte",
        f"{p}_b": f"SELECT b.nom_barri, (b.s + 20 * d.r_d) / (b.n + 20) AS r_b FROM (SELECT nom_barri, SUM(accident_greu) AS s, "
        f"COUNT(accident_greu) AS n, MIN(nom_districte) AS dist FROM {p}_train WHERE nom_barri IS NOT NULL GROUP BY nom_barri) b "
        f"LEFT JOIN {p}_d d ON b.dist = d.nom_districte",
        f"{p}_enc": f"SELECT x.*, COALESCE(b.r_b, d.r_d, (SELECT g FROM {p}_g)) AS ratio_greu_barri FROM {source} x "
        f"LEFT JOIN {p}_b b ON x.nom_barri = b.nom_barri LEFT JOIN {p}_d d ON x.nom_districte = d.nom_districte",
    }


def _case_map(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(mapping.items()))
    return f"CASE {col} {whens} ELSE {col} END"


def model_ctes(groupings: dict[str, dict[str, str]]) -> dict[str, str]:
    acr = ", ".join(f'"{a}"' for a in STANDIN_ACRONYMS)
    veh = _case_map("desc_tipus_vehicle_implicat", groupings["desc_tipus_vehicle_implicat"])
    mot = _case_map("descripcio_motiu_desplacament_conductor", groupings["descripcio_motiu_desplacament_conductor"])
    ctes = {
        "a_lab": f"SELECT *, {LABEL_SQL} AS accident_greu FROM s_accidents",
        **split_ctes("a", "a_lab"),
        **te_ctes("ate", "a_split"),
        "u_lab": f"SELECT *, {LABEL_SQL} AS accident_greu FROM unified",
        "u_grp": "SELECT numero_expedient, MIN(nom_barri) AS nom_barri, MAX(accident_greu) AS accident_greu FROM u_lab GROUP BY numero_expedient",
        **split_ctes("ug", "u_grp"),
        "u_split": "SELECT u.*, g.split FROM u_lab u JOIN ug_split g USING (numero_expedient)",
        "u_prep": f"SELECT numero_expedient, nom_districte, nom_barri, hora_dia, latitud_wgs84, longitud_wgs84, {acr}, "
        f"{veh} AS desc_tipus_vehicle_implicat, edat, descripcio_tipus_persona, {mot} AS descripcio_motiu_desplacament_conductor, "
        f"accident_greu, split, CAST(COALESCE(PPT, 0) > 0 AS INTEGER) AS hi_ha_pluja FROM u_split",
        **te_ctes("ute", "u_prep"),
        "u_te": "SELECT * EXCLUDE (nom_districte, nom_barri) FROM ute_enc",
        "o_counts": "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS n FROM u_te WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}"
            for c in ORDINAL_COLUMNS
        ),
        "o_map": "SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS INTEGER) AS code FROM o_counts",
        "u_enc": "SELECT x.* REPLACE ("
        + ", ".join(f"m{i}.code AS {c}" for i, c in enumerate(ORDINAL_COLUMNS))
        + ") FROM u_te x "
        + " ".join(
            f"LEFT JOIN o_map m{i} ON m{i}.column_name = '{c}' AND x.{c} = m{i}.value" for i, c in enumerate(ORDINAL_COLUMNS)
        ),
    }
    return ctes


ORDINAL_COLUMNS = ["desc_tipus_vehicle_implicat", "descripcio_tipus_persona", "descripcio_motiu_desplacament_conductor"]


# ------------------------------------------------------------------ metrics
SCORED = {
    "scored": "SELECT split, numero_expedient AS row_key, accident_greu AS label, "
    "(numero_expedient * 7919 % 1000) / CAST(1000 AS DOUBLE) AS score FROM a_split",
    "grid": "SELECT i, (5 + i) / CAST(100 AS DOUBLE) AS threshold FROM range(91) t(i)",
    "cm": "SELECT split, COUNT(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, COUNT(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp, "
    "COUNT(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM scored GROUP BY split",
    "sc": "SELECT split, score, CAST(SUM(label) AS BIGINT) AS pos, CAST(SUM(1 - label) AS BIGINT) AS neg FROM scored GROUP BY split, score",
    "sweep_raw": "SELECT s.split, g.threshold, CAST(COUNT(*) FILTER (WHERE s.score >= g.threshold AND s.label = 1) AS BIGINT) AS tp, "
    "CAST(COUNT(*) FILTER (WHERE s.score >= g.threshold AND s.label = 0) AS BIGINT) AS fp, CAST(SUM(s.label) AS BIGINT) AS P "
    "FROM scored s CROSS JOIN grid g GROUP BY s.split, g.threshold",
    "sweep": "SELECT split, threshold, tp, fp, "
    "ROUND(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END, 9) AS precision, "
    "ROUND(CAST(tp AS DOUBLE) / GREATEST(P, 1), 9) AS recall, "
    "ROUND(CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + (P - tp)) ELSE 0.0 END, 9) AS f1 FROM sweep_raw",
    "ranked": "SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY f1 DESC, recall DESC, precision DESC, threshold) AS INTEGER) AS rank FROM sweep",
    "auc": "SELECT split, ROUND(SUM(pos * (cum_neg - neg + neg * 0.5)) / (SUM(pos) * SUM(neg)), 9) AS roc_auc FROM ("
    "SELECT *, SUM(neg) OVER (PARTITION BY split ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM sc) GROUP BY split",
    "ap": "SELECT split, ROUND(CASE WHEN SUM(pos) > 0 THEN SUM(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) / SUM(pos) END, 9) AS average_precision FROM ("
    "SELECT *, SUM(pos) OVER w AS cum_pos, SUM(neg) OVER w AS cum_neg FROM sc "
    "WINDOW w AS (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) GROUP BY split",
}


def _sd(num, den):
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"


def report_sql():
    s0, s1, tot = "(tn + fp)", "(tp + fn)", "(tn + fp + tp + fn)"
    p0, r0, f0 = _sd("tn", "tn + fn"), _sd("tn", "tn + fp"), _sd("2 * tn", "2 * tn + fn + fp")
    p1, r1, f1 = _sd("tp", "tp + fp"), _sd("tp", "tp + fn"), _sd("2 * tp", "2 * tp + fp + fn")
    acc = _sd("tp + tn", tot)

    def w(a, b):
        return f"CASE WHEN {tot} > 0 THEN CAST(({a}) * {s0} + ({b}) * {s1} AS DOUBLE) / {tot} ELSE 0.0 END"

    rows = [
        ("'0'", p0, r0, f0, s0),
        ("'1'", p1, r1, f1, s1),
        ("'accuracy'", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", acc, tot),
        ("'macro avg'", f"(({p0}) + ({p1})) / 2", f"(({r0}) + ({r1})) / 2", f"(({f0}) + ({f1})) / 2", tot),
        ("'weighted avg'", w(p0, p1), w(r0, r1), w(f0, f1), tot),
    ]
    parts = [
        f"SELECT split, {n} AS class_name, ROUND({p}, 9) AS precision, ROUND({r}, 9) AS recall, ROUND({f}, 9) AS f1, "
        f"CAST({sup} AS BIGINT) AS support FROM cm"
        for n, p, r, f, sup in rows
    ]
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------- schema queries
_TYPE_NAMES = (
    "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
    "WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END"
)


def describe_sql(table: str, query: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name, "
        f"{_TYPE_NAMES} AS column_type FROM (DESCRIBE {query})"
    )


def policy_sql(policy: dict[str, list[str]], query: str) -> str:
    values = ", ".join(f"('{rule}', '{c}')" for rule, cols in policy.items() for c in cols)
    return (
        f"SELECT p.rule, p.column_name, d.column_name IS NOT NULL AS present FROM (VALUES {values}) p(rule, column_name) "
        f"LEFT JOIN (DESCRIBE {query}) d ON d.column_name = p.column_name"
    )
