"""Data-quality rules: fills, de-duplication and denial constraints.

A ``Rule`` is a name and a *violation* predicate.  ``apply_rules`` keeps the
rows whose combined verdict (OR of all violations) is exactly FALSE and
returns the others as a quarantine frame that says which rules fired.  Under
SQL three-valued logic a NULL verdict is *unknown*; by default (``on_unknown
='drop'``) such rows are rejected too, which is what a ``verdict == False``
filter does, and the quarantine names the rules that were unknown.

All rules are row-wise expressions: no aggregate, so they also run unchanged
on a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text columns filled with the "unknown" word when missing.
TEXT_FILL_COLUMNS = [
    "descripcio_causa_vianant",
    "descripcio_sexe",
    "descripcio_lloc_atropellament_vianant",
    "descripcio_motiu_desplacament_vianant",
    "descripcio_motiu_desplacament_conductor",
    "descripcio_victimitzacio",
    "num_postal",
]
UNKNOWN_TEXT = "Desconegut"

# Casualty counts filled with 0 when missing.
COUNT_COLUMNS = ["numero_morts", "numero_lesionats_lleus", "numero_lesionats_greus", "numero_victimes"]

# Reading ranges by acronym prefix (prefix, low, high); None = open.
READING_RANGES = [
    ("temperature_range", "T", -10.0, 42.0),
    ("humidity_range", "H", 0.0, 100.0),
    ("precipitation_negative", "PP", 0.0, None),
    ("wind_direction_range", "D", 0.0, 360.0),
]

# Person age limits.
DRIVER_MIN_AGE = 14
MIN_AGE = 0
MAX_AGE = 110


@dataclass(frozen=True)
class Rule:
    name: str
    violation: Column


class RuleResult(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


# --------------------------------------------------------------------- fills
def fill_text(df: DataFrame, columns: list[str] | None = None, value: str = UNKNOWN_TEXT) -> DataFrame:
    """Fill missing text in the listed columns that exist and are strings.

    Absent columns are skipped; non-string columns are left as they are (a
    numeric postal code is not turned into text behind the user's back).
    """
    columns = TEXT_FILL_COLUMNS if columns is None else columns
    types = dict(df.dtypes)
    present = {c: F.coalesce(F.col(c), F.lit(value)) for c in columns if types.get(c) == "string"}
    return df.withColumns(present) if present else df


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill missing counts with 0 in the listed numeric columns that exist."""
    columns = COUNT_COLUMNS if columns is None else columns
    types = dict(df.dtypes)
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float")
    present = {
        c: F.coalesce(F.col(c), F.lit(0).cast(types[c]))
        for c in columns
        if types.get(c, "").split("(")[0] in numeric or types.get(c, "").startswith("decimal")
    }
    return df.withColumns(present) if present else df


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication (hash aggregate on every column, partial
    aggregation map-side, so repeated rows shrink before the shuffle)."""
    return df.dropDuplicates()


# --------------------------------------------------------------------- rules
def any_violation(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [r.violation for r in rules])


def apply_rules(df: DataFrame, rules: list[Rule], on_unknown: str = "drop") -> RuleResult:
    """Split ``df`` into rows passing every rule and quarantined rows.

    ``rejected`` carries ``violated_rules`` (rules whose predicate is TRUE) and
    ``unknown_rules`` (rules whose predicate is NULL); with ``on_unknown=
    'keep'`` rows with only unknown verdicts stay valid.
    """
    if on_unknown not in ("drop", "keep"):
        raise ValueError("on_unknown must be 'drop' or 'keep'")
    if not rules:
        empty = F.array().cast("array<string>")
        return RuleResult(df, df.where(F.lit(False)).withColumns({"violated_rules": empty, "unknown_rules": empty}))
    verdict = any_violation(rules)
    keep = ~verdict if on_unknown == "drop" else ~F.coalesce(verdict, F.lit(False))
    valid = df.where(keep)
    reject = F.coalesce(verdict, F.lit(on_unknown == "drop"))
    violated = F.filter(F.array(*[F.when(r.violation, F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    unknown = F.filter(
        F.array(*[F.when(r.violation.isNull(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    rejected = df.where(reject).withColumns({"violated_rules": violated, "unknown_rules": unknown})
    return RuleResult(valid, rejected)


def rule_counts(df: DataFrame, rules: list[Rule], table_name: str) -> DataFrame:
    """One pass: per rule, rows where it is violated and rows where it is unknown."""
    aggs = []
    for r in rules:
        aggs.append(F.count_if(r.violation).alias(f"{r.name}__violated"))
        aggs.append(F.count_if(r.violation.isNull()).alias(f"{r.name}__unknown"))
    wide = df.agg(*aggs)
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule_name"),
                    F.col(f"{r.name}__violated").alias("n_violated"),
                    F.col(f"{r.name}__unknown").alias("n_unknown"),
                )
                for r in rules
            ]
        )
    )
    return wide.select(F.lit(table_name).alias("table_name"), rows)


# ------------------------------------------------------------ rule catalogue
def accident_rules() -> list[Rule]:
    casualties = F.col("numero_morts") + F.col("numero_lesionats_lleus") + F.col("numero_lesionats_greus")
    return [Rule("victims_below_casualties", F.col("numero_victimes") < casualties)]


def person_rules() -> list[Rule]:
    age = F.col("edat")
    return [
        Rule("driver_under_min_age", (F.col("descripcio_tipus_persona") == "Conductor") & (age < DRIVER_MIN_AGE)),
        Rule("age_negative", age < MIN_AGE),
        Rule("age_over_max", age > MAX_AGE),
    ]


def reading_rules(ranges: list[tuple[str, str, float | None, float | None]] | None = None) -> list[Rule]:
    ranges = READING_RANGES if ranges is None else ranges
    rules = []
    value = F.col("valor")
    for name, prefix, lo, hi in ranges:
        out = [c for c in ((value < lo) if lo is not None else None, (value > hi) if hi is not None else None) if c is not None]
        rules.append(Rule(name, F.col("acronim").startswith(prefix) & reduce(lambda a, b: a | b, out)))
    return rules


# ---------------------------------------------------------- table cleanings
def clean_accidents(df: DataFrame, on_unknown: str = "drop") -> RuleResult:
    """De-duplicate, fill text and counts, then the casualty-sum constraint."""
    filled = fill_zero(fill_text(dedup_rows(df)))
    return apply_rules(filled, accident_rules(), on_unknown)


def clean_persons(df: DataFrame, on_unknown: str = "drop") -> RuleResult:
    """De-duplicate, fill text, then the age constraints."""
    filled = fill_text(dedup_rows(df))
    return apply_rules(filled, person_rules(), on_unknown)


def clean_readings(df: DataFrame, on_unknown: str = "drop") -> RuleResult:
    """De-duplicate, then the per-family range constraints."""
    return apply_rules(dedup_rows(df), reading_rules(), on_unknown)


def quarantine_counts(tables: dict[str, tuple[DataFrame, list[Rule]]]) -> DataFrame:
    """Per table and rule, violated and unknown counts over the cleaned input
    (after de-duplication and fills, i.e. what the rules actually see)."""
    frames = [rule_counts(df, rules, name) for name, (df, rules) in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def prepared_for_rules(table: str, df: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """The frame each table's rules are evaluated on, and those rules."""
    if table == "accidents":
        return fill_zero(fill_text(dedup_rows(df))), accident_rules()
    if table == "persons":
        return fill_text(dedup_rows(df)), person_rules()
    if table == "readings":
        return dedup_rows(df), reading_rules()
    raise KeyError(table)
