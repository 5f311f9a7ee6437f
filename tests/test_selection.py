"""Radix selection and running totals: exact values, what moves, how often the input is read."""

import math
import random

import pytest
from pyspark.sql import functions as F

from incidentflow.operators.ordered import row_numbers, running_totals
from incidentflow.operators.profile import numeric_summary
from incidentflow.operators.selection import values_at


def _long(spark, columns):
    return spark.createDataFrame([(c, float(v)) for c, vs in columns.items() for v in vs], "column_name string, value double")


def test_every_rank_of_awkward_columns(spark):
    pick = random.Random(1)
    inf, nan = math.inf, math.nan
    columns = {
        "normal": [pick.gauss(0, 1) for _ in range(500)],
        "many": [pick.choice([0.0, -0.0, 1.0, 2.5]) for _ in range(300)],
        "powers": [s * 2.0**k for k in range(-60, 60, 3) for s in (1, -1)],
        "near": [1 + k * 2**-52 for k in range(200)] + [1 + 2**-30],
        "tiny": [5e-324 * k for k in range(1, 40)] + [0.0, -5e-324],
        "huge": [1.7e308, -1.7e308, inf, -inf, inf, 1e300, nan, nan, 3.0],
        "one": [7.25],
    }
    ranks = {c: sorted({0, len(v) - 1, *(pick.randrange(len(v)) for _ in range(9))}) for c, v in columns.items()}
    got = values_at(_long(spark, columns), ranks)
    for c, values in columns.items():
        order = sorted(values, key=lambda x: (math.isnan(x), x))
        for r in ranks[c]:
            assert got[c][r] == order[r] or math.isnan(got[c][r]) and math.isnan(order[r]), (c, r)
    with pytest.raises(ValueError):
        values_at(_long(spark, {"one": [1.0]}), {"one": [1]})


def test_summary_counts_without_moving_values(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), (F.col("id") / 3).alias("b"), F.lit(None).cast("int").alias("c"), F.lit("x").alias("d"))
    rows = {r.column_name: r for r in numeric_summary(df, "t").collect()}
    assert set(rows) == {"a", "b"} and rows["a"].q25 == 4999.75 and rows["a"].q50 == 9999.5
    assert rows["b"].q75 == round((14999 + 0.25) / 3, 9) and rows["b"]["count"] == 20_000
    assert numeric_summary(df.limit(0), "t").count() == 0 and numeric_summary(df.select("d"), "t").count() == 0


def test_tied_rows_spread_and_the_input_runs_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    base = spark.range(3000, numPartitions=6).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.when(F.col("id") < 1000, 5).otherwise(F.col("id") % 40).alias("k"))
    df = base.mapInArrow(count, base.schema)
    out = row_numbers(df, [], [F.col("k")], "n")
    assert sorted(r.n for r in out.collect()) == list(range(1, 3001))
    assert seen.value == 3000
    assert out.orderBy("n").select("k").collect() == base.orderBy("k").select("k").collect()
    counts = base.groupBy("g", "k").agg(F.count("*").alias("c"))
    cum = {(r.g, r.k): r.cum_c for r in running_totals(counts, ["g"], "k", ["c"]).collect()}
    rows = counts.collect()
    assert cum == {(r.g, r.k): sum(s.c for s in rows if s.g == r.g and s.k <= r.k) for r in rows}
