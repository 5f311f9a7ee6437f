"""Row-level label, flag and decision expressions (no aggregate, stream-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def severity_label(deaths: str = "numero_morts", serious: str = "numero_lesionats_greus") -> Column:
    """1 if the accident had a death or a seriously injured person, else 0.

    A missing count counts as zero (a missing value is never > 0), so the
    label is never NULL.
    """
    d = F.coalesce(F.col(deaths), F.lit(0))
    s = F.coalesce(F.col(serious), F.lit(0))
    return ((d > 0) | (s > 0)).cast("int")


def flag_from_measure(measure: str = "PPT") -> Column:
    """1 if the measure is positive, missing counts as 0 (rain flag)."""
    return (F.coalesce(F.col(measure), F.lit(0.0)) > 0).cast("int")


def apply_threshold(score: str = "score", threshold: float = 0.5) -> Column:
    """Decision ``score >= threshold``; a score equal to the threshold is positive."""
    return (F.col(score) >= F.lit(float(threshold))).cast("int")
