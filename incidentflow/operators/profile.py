"""Table profiling as tidy DataFrames: one row per (table, column).

Each statistic family is one aggregate over the table (not one query per
column and statistic); the wide aggregate row is turned into rows with
``inline``.  Exact distinct counts unpivot the table to (column, value) pairs and
de-duplicate them once, instead of one multi-distinct aggregate that would
copy every row once per column before any reduction.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentflow.operators.selection import values_at
from incidentflow.session import materialise

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
LOW_CARDINALITY = 50
LIST_VALUES_UP_TO = 10
ROUND = 9


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def describe_table(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, ordinal, column_name, column_type) from the schema."""
    spark = df.sparkSession
    rows = [(table_name, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, column_type string")


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """NULL count and percentage per column (0 % on an empty table)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__z{i}") for i, c in enumerate(cols)])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__z{i}").alias("null_count")) for i, c in enumerate(cols)]))
    out = wide.select("__n", rows)
    pct = F.when(F.col("__n") > 0, F.col("null_count").cast("double") / F.col("__n") * 100).otherwise(F.lit(0.0))
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "null_count", pct.alias("null_pct"))


def numeric_profile(df: DataFrame, table_name: str, digits: int = ROUND) -> DataFrame:
    """MIN / MAX / AVG / STDDEV_SAMP per numeric column, NULLs skipped; a
    column with only NULLs is omitted.  All four as double."""
    cols = numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"__mn{i}"), F.max(x).alias(f"__mx{i}"), F.avg(x).alias(f"__av{i}"), F.stddev_samp(x).alias(f"__sd{i}")]
    wide = df.agg(*aggs)
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"__mn{i}").alias("min_val"),
                    F.col(f"__mx{i}").alias("max_val"),
                    F.round(F.col(f"__av{i}"), digits).alias("avg_val"),
                    F.round(F.col(f"__sd{i}"), digits).alias("std_val"),
                )
                for i, c in enumerate(cols)
            ]
        )
    )
    return wide.select(F.lit(table_name).alias("table_name"), rows).where(F.col("min_val").isNotNull())


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Values of one bitmap of ``bitmap_construct_agg`` and its bytes.
_BITMAP_VALUES, _BITMAP_BYTES = 32_768, 4_096


def _comparable(df: DataFrame, c: str):
    """The column with one form for each value: -0.0 is 0.0, a map is text."""
    dtype, x = df.schema[c].dataType, F.col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(x == 0, F.lit(0.0).cast(dtype)).otherwise(x)
    return x if isinstance(dtype, T.AtomicType) else x.cast("string")


def _dense(df: DataFrame) -> list[str]:
    """Integer columns whose bitmaps take less room than a hash a value, by
    their range and rows (one aggregate)."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL)]
    if not ints:
        return []
    aggs = [x for i, c in enumerate(ints) for x in (F.count(c).alias(f"n{i}"), F.min(c).cast("long").alias(f"lo{i}"), F.max(c).cast("long").alias(f"hi{i}"))]
    row = df.agg(*aggs).first()
    small = lambda i: row[f"n{i}"] and (row[f"hi{i}"] - row[f"lo{i}"]) // _BITMAP_VALUES * _BITMAP_BYTES <= 16 * row[f"n{i}"]
    return [c for i, c in enumerate(ints) if small(i)]


def distinct_counts(df: DataFrame) -> DataFrame:
    """``column_name, n_distinct, has_null`` of every column, exact, without
    moving a value: a dense integer column becomes bitmaps, merged by
    ``bitmap_or``; of any other column 128-bit hashes are de-duplicated, before
    the shuffle and after it, by ranges of the hash.  The table is read once
    for the ranges of its integers, once for the bitmaps and once for the hashes.
    """
    dense = _dense(df)
    parts = []
    if dense:
        number = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("v")) for c in dense]))
        rows = df.select(number)
        bucket = F.when(F.col("v").isNotNull(), F.bitmap_bucket_number("v"))
        maps = rows.groupBy("column_name", bucket.alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("v", F.lit(0)))).alias("m"))
        counted = F.when(F.col("b").isNotNull(), F.bitmap_count("m")).otherwise(0)
        parts.append(maps.groupBy("column_name").agg(F.sum(counted).alias("n_distinct"), F.max(F.col("b").isNull()).alias("has_null")))
    others = [c for c in df.columns if c not in dense]
    if others:

        def hashed(c: str):
            x = _comparable(df, c)
            known = F.col(c).isNotNull()
            return F.struct(F.lit(c).alias("column_name"), F.when(known, F.xxhash64(F.lit(0), x)).alias("h1"), F.when(known, F.xxhash64(F.lit(1), x)).alias("h2"))

        seen = df.select(F.inline(F.array(*[hashed(c) for c in others]))).distinct()
        parts.append(seen.groupBy("column_name").agg(F.count("h1").alias("n_distinct"), F.max(F.col("h1").isNull()).alias("has_null")))
    return _of_every_column(df, _union(parts), {"n_distinct": 0, "has_null": False})


def _of_every_column(df: DataFrame, counts: DataFrame, zero: dict) -> DataFrame:
    """``counts`` with a row for each column of ``df``, also of an empty table."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return names.join(counts, "column_name", "left").fillna(zero)


def distinct_profile(df: DataFrame, table_name: str) -> DataFrame:
    """Exact COUNT(DISTINCT) per column, NULL not counted; 0 for every column
    of an empty table."""
    return distinct_counts(df).select(F.lit(table_name).alias("table_name"), "column_name", "n_distinct")


def distinct_with_null(df: DataFrame, table_name: str) -> DataFrame:
    """Distinct count where NULL counts as one more value."""
    both = F.col("n_distinct") + F.col("has_null").cast("long")
    return distinct_counts(df).select(F.lit(table_name).alias("table_name"), "column_name", both.alias("n_distinct_with_null"))


def _listed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, distinct_values``: the sorted values, as text, of columns
    known to have few."""
    numeric = set(numeric_columns(df))
    none = F.lit(None).cast("double")
    one = lambda c: F.struct(
        F.lit(c).alias("column_name"), (F.col(c).cast("double") if c in numeric else none).alias("num"), _comparable(df, c).cast("string").alias("text")
    )
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, distinct_values string")
    rows = df.select(F.inline(F.array(*[one(c) for c in columns]))).where("text IS NOT NULL").distinct()
    values = F.transform(F.array_sort(F.collect_list(F.struct("num", "text"))), lambda x: x["text"])
    return rows.groupBy("column_name").agg(F.array_join(values, ", ").alias("distinct_values"))


def low_card_values(df: DataFrame, table_name: str, limit: int = LOW_CARDINALITY, list_up_to: int = LIST_VALUES_UP_TO) -> DataFrame:
    """Columns with fewer than ``limit`` distinct values; for those with at
    most ``list_up_to``, the sorted values as text.  The counts (a row for each
    column) come first, so values are gathered only where they are few."""
    counts = materialise(distinct_counts(df), "distinct-counts")
    short = [r[0] for r in counts.where(F.col("n_distinct").between(1, list_up_to)).select("column_name").collect()]
    return (
        counts.where(F.col("n_distinct") < limit)
        .join(_listed(df, short), "column_name", "left")
        .select(F.lit(table_name).alias("table_name"), "column_name", "n_distinct", "distinct_values", "has_null")
    )


def numeric_summary(df: DataFrame, table_name: str, probs: tuple[float, ...] = (0.25, 0.5, 0.75), digits: int = ROUND) -> DataFrame:
    """count, mean, std, min, exact linear-interpolated quartiles, max per
    numeric column (a column with only NULLs is omitted).

    The numeric columns are written once; one aggregate gives the moments and
    :func:`values_at` the quantiles by counting, so no value is shuffled and
    the driver sees a few numbers a column."""
    cols = numeric_columns(df)
    spark = df.sparkSession
    own = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    own = materialise(own, "numeric-columns") if cols else own
    stats = [f(f"c{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("n", F.count), ("av", F.avg), ("sd", F.stddev_samp), ("mn", F.min), ("mx", F.max))]
    row = own.agg(*stats).first() if cols else None
    seen = [i for i in range(len(cols)) if row[f"n{i}"]]
    at = {i: [(row[f"n{i}"] - 1) * float(p) for p in probs] for i in seen}
    long = own.select(F.inline(F.array(*[F.struct(F.lit(str(i)).alias("column_name"), F.col(f"c{i}").alias("value")) for i in seen]))) if seen else None
    found = values_at(long.where("value IS NOT NULL"), {str(i): [int(r) for h in at[i] for r in (floor(h), ceil(h))] for i in seen}) if seen else {}
    names = [f"q{int(round(p * 100))}" for p in probs]
    rows = []
    for i in seen:
        value = found[str(i)]
        quantiles = [value[floor(h)] + (h - floor(h)) * (value[ceil(h)] - value[floor(h)]) for h in at[i]]
        rows.append((table_name, cols[i], row[f"n{i}"], row[f"av{i}"], row[f"sd{i}"], row[f"mn{i}"], *quantiles, row[f"mx{i}"]))
    schema = "table_name string, column_name string, count long, mean double, std double, min double, " + "".join(f"{q} double, " for q in names) + "max double"
    out = spark.createDataFrame(rows, schema)
    return out.withColumns({c: F.round(c, digits) for c in ("mean", "std", *names)})


def _one_pass_stats(df: DataFrame, table_name: str, digits: int = ROUND) -> DataFrame:
    """Rows, NULL count / share and numeric statistics of every column from
    a single aggregate, as one row per column."""
    cols = df.columns
    numeric = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"__z{i}"))
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"__mn{i}"), F.max(x).alias(f"__mx{i}"), F.avg(x).alias(f"__av{i}"), F.stddev_samp(x).alias(f"__sd{i}")]
    none = F.lit(None).cast("double")
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"__z{i}").alias("null_count"),
                    (F.col(f"__mn{i}") if c in numeric else none).alias("min_val"),
                    (F.col(f"__mx{i}") if c in numeric else none).alias("max_val"),
                    (F.round(F.col(f"__av{i}"), digits) if c in numeric else none).alias("avg_val"),
                    (F.round(F.col(f"__sd{i}"), digits) if c in numeric else none).alias("std_val"),
                )
                for i, c in enumerate(cols)
            ]
        )
    )
    pct = F.when(F.col("__n") > 0, F.col("null_count").cast("double") / F.col("__n") * 100).otherwise(F.lit(0.0))
    return df.agg(*aggs).select("__n", rows).select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        F.col("__n").alias("row_count"),
        "null_count",
        pct.alias("null_pct"),
        "min_val",
        "max_val",
        "avg_val",
        "std_val",
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per (table, column): type, rows, NULLs, distinct count and numeric
    statistics, one row each.  Two passes per table: one aggregate for
    rows, NULLs and numeric statistics, one for the distinct counts."""
    frames = []
    for name, df in tables.items():
        types = describe_table(df, name).select("table_name", "column_name", "column_type", "ordinal")
        stats = _one_pass_stats(df, name)
        dist = distinct_profile(df, name)
        frames.append(
            types.join(stats, ["table_name", "column_name"])
            .join(dist, ["table_name", "column_name"])
            .select(
                "table_name", "column_name", "column_type", "ordinal", "row_count", "null_count", "null_pct",
                "n_distinct", "min_val", "max_val", "avg_val", "std_val",
            )
        )
    return _union(frames)


def full_profile(tables: dict[str, DataFrame], list_up_to: int = LIST_VALUES_UP_TO) -> DataFrame:
    """:func:`table_profile` of every table with its number of columns and, for
    columns of at most ``list_up_to`` distinct values, the values."""
    frames = []
    for name, df in tables.items():
        profile = materialise(table_profile({name: df}), "profile")
        short = [r[0] for r in profile.where(F.col("n_distinct").between(1, list_up_to)).select("column_name").collect()]
        frames.append(profile.withColumn("n_columns", F.lit(len(df.columns))).join(_listed(df, short), "column_name", "left"))
    return _union(frames)
