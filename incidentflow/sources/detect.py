"""Column types of a CSV from its data: one mergeable aggregate over a lattice.

Every value has the set of types that hold it; a column's types are those that
hold all its values, the intersection, and its type the narrowest of them.  The
sets are bits and their intersection ``bit_and``, so every task reduces its rows
to one number a column.  Declared schemas stay the default; this is for files
that have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentflow.sources.csv import read_csv

#: From the narrowest type to the widest.  A whole number is a double too, a
#: date a timestamp; everything is a string.
LATTICE = [T.BooleanType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()]

_INTEGER = r"^-?[0-9]+$"
_PADDED = r"^-?0[0-9]+$"
_DECIMAL = r"(?i)^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$|^-?(inf|infinity)$|^nan$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def _held(text: Column, keep_zeros: bool) -> Column:
    """The types that hold a text, as bits in the lattice's order; null for a
    null (which every type holds)."""
    whole = text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull()
    number = text.rlike(_DECIMAL)
    if keep_zeros:  # 007 is a code: a number would lose its zeros
        whole, number = whole & ~text.rlike(_PADDED), number & ~text.rlike(_PADDED)
    day = text.rlike(_DATE) & text.try_cast("date").isNotNull()
    moment = day | (text.rlike(_TIMESTAMP) & text.try_cast("timestamp_ntz").isNotNull())
    tests = [F.lower(text).isin("true", "false"), whole, number, day, moment]
    bits = F.lit(0)
    for k, test in enumerate(tests):
        bits = bits.bitwiseOR(F.when(test, 1 << k).otherwise(0))
    return F.when(text.isNotNull(), bits)


def detect_types(texts: DataFrame, keep_zeros: bool = True) -> T.StructType:
    """The narrowest schema that holds every value of ``texts`` (columns of
    strings); a column without values is a string."""
    names = texts.columns
    aggs = [F.bit_and(_held(F.col(f"`{c}`"), keep_zeros)).alias(f"c{i}") for i, c in enumerate(names)]
    row = texts.agg(*aggs).first() if names else None
    fields = []
    for i, c in enumerate(names):
        bits = row[f"c{i}"] or 0
        fields.append(T.StructField(c, next((t for k, t in enumerate(LATTICE) if bits >> k & 1), T.StringType())))
    return T.StructType(fields)


def read_detected(spark: SparkSession, path: str | list[str], delimiter: str = ",", null_value: str | None = None, keep_zeros: bool = True) -> DataFrame:
    """A header CSV under the schema detected from all its rows (a scan for the
    types, another for the rows)."""
    first = path[0] if isinstance(path, list) else path
    reader = spark.read.option("header", True).option("delimiter", delimiter)
    names = reader.csv(first).columns
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    schema = detect_types(read_csv(spark, path, as_text, delimiter, null_value), keep_zeros)
    return read_csv(spark, path, schema, delimiter, null_value)
