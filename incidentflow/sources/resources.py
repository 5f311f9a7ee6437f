"""Selection of downloadable resources from an open-data catalogue table.

The catalogue is a DataFrame of API links and resource metadata (one row
per resource); the selection keeps the CSV resources of a target year with a
non-empty URL and derives a safe local file name.  The download itself is a
network tool outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters kept in a file name are letters, digits, "_", "-"
# and "."; every other run of characters becomes one "_".
UNSAFE_RUN = r"[^\p{L}\p{N}_.\-]+"


def resource_id_of(api_link: str | Column, param: str = "resource_id") -> Column:
    c = F.col(api_link) if isinstance(api_link, str) else api_link
    return F.nullif(F.trim(F.try_parse_url(c, F.lit("QUERY"), F.lit(param))), F.lit(""))


def safe_filename(name: Column, suffix: str = ".csv") -> Column:
    cleaned = F.regexp_replace(F.trim(name), UNSAFE_RUN, "_")
    return F.when(F.lower(cleaned).endswith(suffix), cleaned).otherwise(F.concat(cleaned, F.lit(suffix)))


def select_resources(catalogue: DataFrame, target: str, fmt: str = "csv") -> DataFrame:
    """Rows of the target (year) whose format is ``fmt`` and whose URL is not
    empty, with ``file_name``.  A missing name falls back to ``<id>.csv``."""
    text = F.lower(F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("url", F.lit(""))))
    wanted = text.contains(target.lower()) & F.lower(F.coalesce("format", F.lit(""))).contains(fmt.lower())
    has_url = F.length(F.trim(F.coalesce("url", F.lit("")))) > 0
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.concat(F.col("resource_id"), F.lit("." + fmt)))
    return catalogue.where(wanted & has_url).select(
        "resource_id", safe_filename(name, "." + fmt).alias("file_name"), F.trim("url").alias("url")
    )
