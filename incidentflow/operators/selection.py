"""Exact order statistics by radix selection: no value is sorted or shuffled.

The value at a rank is found by counting.  A first aggregate counts every column
by sign and binary exponent (the leading bits of a floating-point number's order);
the bucket that holds the rank is then cut into 65,536 parts of equal width, the
part that holds it again, until a bucket holds one value: four more aggregates at
most, as a bucket's values share their exponent and have 52 bits besides.  A task
sends its non-empty buckets, the driver receives the one bucket of each rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 65_536


def _exponent(x: Column) -> Column:
    """A whole number that grows with ``x`` and takes few values: sign times
    the (shifted) binary exponent; NaN comes last, as Spark orders it."""
    size = F.when(F.abs(x) == float("inf"), 5_000).otherwise(F.floor(F.log2(F.abs(x))) + 1_100)
    return F.when(F.isnan(x), 10_000).when(x == 0, 0).otherwise(F.signum(x) * size).cast("long")


def _chosen(counts: DataFrame, groups: list[str], wanted: DataFrame) -> list:
    """The bucket of each wanted (group, rank): at most 65,537 rows a group."""
    upto = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.withColumn("upto", F.sum("n").over(upto))
    # a row for each rank asked for
    hit = cum.join(F.broadcast(wanted), groups).where((F.col("upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
    inside = F.col("rank") - (F.col("upto") - F.col("n"))
    return [tuple(r) for r in hit.select(*groups, "id", inside, "low", "high").collect()]


def values_at(long: DataFrame, ranks: dict[str, list[int]], most_rounds: int = 8) -> dict[str, dict[int, float]]:
    """The values at 0-based ``ranks`` of each column of ``long``
    (``column_name``, ``value``: a double, not null), nulls left out.

    ``long`` is read once a round: give it from a table.  Ranks outside a
    column's rows are an error.
    """
    spark = long.sparkSession
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    todo = [(c, r, r) for c, rs in ranks.items() for r in sorted(set(rs))]
    if not todo:
        return found
    size = F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    counts = long.groupBy("column_name", _exponent(F.col("value")).alias("bucket")).agg(*size)
    wanted = spark.createDataFrame(todo, "column_name string, id long, rank long")
    hits = _chosen(counts, ["column_name"], wanted)
    if len(hits) < len(todo):
        raise ValueError("a rank lies beyond the rows of its column")
    for _ in range(most_rounds):
        open_ = []
        for column, rank, inside, low, high in hits:
            if low == high or low != low:
                found[column][rank] = low
            else:
                open_.append((column, rank, inside, low, high))
        if not open_:
            return found
        spans = spark.createDataFrame(sorted({(c, lo, hi) for c, _, _, lo, hi in open_}), "column_name string, lo double, hi double")
        # a few spans a column; a row falls in one of its column's
        part = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS)
        near = long.join(F.broadcast(spans), "column_name").where("value >= lo AND value <= hi")
        counts = near.groupBy("column_name", "lo", "hi", part.alias("bucket")).agg(*size)
        wanted = spark.createDataFrame([(c, lo, hi, rank, inside) for c, rank, inside, lo, hi in open_], "column_name string, lo double, hi double, id long, rank long")
        hits = [(r[0], *r[3:]) for r in _chosen(counts, ["column_name", "lo", "hi"], wanted)]
    raise RuntimeError(f"ranks not settled in {most_rounds} rounds")
