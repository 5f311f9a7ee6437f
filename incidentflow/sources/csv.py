"""CSV inputs read under explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentflow.schemas import STATION_CATALOGUE


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    delimiter: str = ",",
    null_value: str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Header CSV under a declared schema (no inference pass over the data);
    columns are found by their name in the header, in whatever order the file
    has them, and come in schema order.  A declared column that the header
    lacks is NULL, others are left out.  All files of a ``path`` must share a
    header (Spark checks each; give a list for files that differ).  Without a
    schema the types are inferred, which costs an extra scan and makes types
    depend on the data; kept for ad-hoc use only."""
    if isinstance(path, list):
        return reduce(DataFrame.unionByName, [read_csv(spark, p, schema, delimiter, null_value, mode) for p in path])
    reader = spark.read.option("header", True).option("delimiter", delimiter).option("mode", mode)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    declared = {f.name: f for f in schema.fields}
    in_file = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])
    df = reader.schema(in_file).option("enforceSchema", False).csv(path)
    return df.select(*[F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_station_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The station catalogue: the closing-date column holds the text NA."""
    return read_csv(spark, path, STATION_CATALOGUE, null_value="NA")


def with_source_table(df: DataFrame, out: str = "source_table") -> DataFrame:
    """Name of the table each row came from, derived from its file name, for
    reads of many files at once (same rule as ``table_name_from_path``)."""
    stem = F.regexp_replace(F.lower(F.col("_metadata.file_name")), r"\.[^.]*$", "")
    stem = F.regexp_replace(stem, r"[^a-z0-9_]+", "_")
    stem = F.when(stem.rlike("^[0-9]"), F.concat(F.lit("t"), stem)).otherwise(stem)
    return df.withColumn(out, stem)
