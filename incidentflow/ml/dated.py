"""Dated statistics of the target encoder: any range of periods is encoded
without reading old rows again.

The encoder only needs, for each category, how many labels it has, their sum and
its smallest parent.  These merge, so they are kept per period and category in
small tables; a batch of new rows adds its own, and the encoder of a range of
periods is made from the sums over the range: the same as a fit on their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.ml.features import SMOOTHING, HierarchicalTargetEncoderModel, encoding_tables


def period_statistics(df: DataFrame, levels: list[str], label: str, time: str, period: str = "quarter") -> list[DataFrame]:
    """For the whole table and for each level: ``period`` (the date it begins),
    the category, its smallest ``parent``, ``s`` and ``n``.  Rows without a
    time belong to no period."""
    dated = df.where(F.col(time).isNotNull()).withColumn("_period", F.to_date(F.date_trunc(period, F.col(time))))
    sums = [F.sum(F.col(label).cast("long")).alias("s"), F.count(label).alias("n")]
    out = [dated.groupBy(F.col("_period").alias("period")).agg(*sums)]
    for i, column in enumerate(levels):
        parent = [F.min(levels[i - 1]).alias("parent")] if i else []
        out.append(dated.where(F.col(column).isNotNull()).groupBy(F.col("_period").alias("period"), F.col(column).alias("category")).agg(*parent, *sums))
    return out


def add_batch(df: DataFrame, path: str, batch: str, levels: list[str], label: str, time: str, period: str = "quarter") -> None:
    """Adds the statistics of a batch of rows.  A batch has a folder of its own
    in each table, so writing one again replaces it and counts nothing twice."""
    for i, stats in enumerate(period_statistics(df, levels, label, time, period)):
        stats.write.mode("overwrite").parquet(f"{path.rstrip('/')}/level={i}/batch={batch}")


def encoder_for(
    spark: SparkSession, path: str, levels: list[str], first: str | None = None, last: str | None = None, output: str = "ratio_greu_barri", smoothing: float = float(SMOOTHING)
) -> HierarchicalTargetEncoderModel:
    """The encoder of the periods that begin from ``first`` to ``last`` (dates,
    both included; None: open).  A range without rows gives null codes."""
    tables = []
    for i in range(len(levels) + 1):
        stats = spark.read.option("basePath", f"{path.rstrip('/')}/level={i}").parquet(f"{path.rstrip('/')}/level={i}")
        if first is not None:
            stats = stats.where(F.col("period") >= F.lit(first).cast("date"))
        if last is not None:
            stats = stats.where(F.col("period") <= F.lit(last).cast("date"))
        tables.append(stats)
    whole = tables[0].agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    rate = whole.s / whole.n if whole.n else None
    merged = []
    for i, (column, stats) in enumerate(zip(levels, tables[1:])):
        parent = [F.min("parent").alias("__parent")] if i else []
        merged.append(stats.groupBy(F.col("category").alias(column)).agg(F.sum("s").alias("__s"), F.sum("n").alias("__n"), *parent))
    model = HierarchicalTargetEncoderModel(encoding_tables(merged, levels, rate, smoothing), rate)
    model._set(levelCols=levels, outputCol=output)
    return model
