"""Running totals and row numbers over a sort order without one task for a
whole group.

The rows are dealt out by ranges of (group, order), so a large group lies in
many tasks, and written once with the number of their range.  The totals of
the ranges are a tiny table (a row for each range and group in it) whose prefix
sums give each range's offset; inside a range an ordinary window adds the
running part.  The number of ranges follows the session's shuffle partitions
and the data (AQE merges small ones), and no exchange is keyed by the group
alone.  Groups may be NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentflow.session import materialise


def _in_ranges(df: DataFrame, parts: list[str], order: list[Column]) -> DataFrame:
    """The input is written once, with every row's place in it: the bounds of
    the ranges are sampled from that table and its rows dealt out from it, so
    the input's own joins run once, and rows with equal order keys are told
    apart by their places, so that they too spread over ranges."""
    once = materialise(df.withColumn("__at", F.monotonically_increasing_id()), "ordered-input")
    dealt = once.repartitionByRange(*parts, *order, "__at").withColumn("__range", F.spark_partition_id())
    return materialise(dealt, "ranges")


def _with_offsets(ranged: DataFrame, offsets: DataFrame, parts: list[str]) -> DataFrame:
    keys = [*parts, "__range"]
    renamed = offsets.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [ranged[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys])
    return ranged.join(renamed, same).drop(*[f"__k_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    partition_cols: list[str],
    order_col: str,
    value_cols: list[str],
    descending: bool = False,
    prefix: str = "cum_",
    total_prefix: str | None = None,
) -> DataFrame:
    """Add ``<prefix><v>`` = sum of ``v`` over rows of the same partition whose
    key is <= the row's key (>= if ``descending``), the row itself included;
    with ``total_prefix`` also the partition's totals.  ``order_col`` must be
    unique inside a partition (aggregate first)."""
    parts = list(partition_cols)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = _in_ranges(df, parts, [order])
    totals = ranged.groupBy(*parts, "__range").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    group = Window.partitionBy(*parts)
    before = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts,
        "__range",
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in value_cols],
        *[F.sum(f"__t_{v}").over(group).alias(f"{total_prefix}{v}") for v in value_cols if total_prefix],
    )
    upto = Window.partitionBy(*parts, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = _with_offsets(ranged, offsets, parts).withColumns(
        {f"{prefix}{v}": F.col(f"__o_{v}") + F.sum(v).over(upto) for v in value_cols}
    )
    return out.drop("__range", "__at", *[f"__o_{v}" for v in value_cols])


def row_numbers(df: DataFrame, partition_cols: list[str], order: list[Column], out: str) -> DataFrame:
    """Add ``out`` = the row's number, from 1, within its partition in the
    given order; rows that tie are numbered in the order in which they were
    written, and lie in several ranges if there are many."""
    parts = list(partition_cols)
    ranged = _in_ranges(df, parts, order)
    sizes = ranged.groupBy(*parts, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*parts).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*parts, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy(*parts, "__range").orderBy(*order, "__at")
    return _with_offsets(ranged, offsets, parts).withColumn(out, F.col("__o") + F.row_number().over(inside)).drop("__range", "__at", "__o")
