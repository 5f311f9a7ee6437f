"""Joins on a stored layout: a third of the rows on one key, no exchange for the rest."""

import re

import pytest
from pyspark.sql import functions as F

from incidentflow.sources.layout import join_layouts, write_layout


@pytest.fixture(scope="module")
def sides(spark):
    many = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    many = many.unionAll(spark.createDataFrame([(None, -1), (None, -2)], many.schema))
    few = spark.range(600).select((F.col("id") % 550).alias("k"), (F.col("id") * 10).alias("w"))
    few = few.unionAll(spark.range(400).select(F.lit(499).cast("long"), F.col("id"))).unionAll(spark.createDataFrame([(None, 5)], few.schema))
    return many, few


def test_join_equals_the_plain_join(spark, sides):
    many, few = sides
    left, right = write_layout(many, "k", 8), write_layout(few, "k", 8)
    assert set(left.heavy) == {7} and set(right.heavy) == {499}
    assert left.ordinary().count() + left.heavy_rows().count() == many.count()
    for salt_rows in (100, 10**6):
        out = join_layouts(left, right, salt_rows)
        assert out.columns == ["k", "v", "w"]
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, many.join(few, "k").collect()))
    left.drop(), right.drop()


def test_key_heavy_on_both_sides_and_empty_tables(spark, sides):
    many, _ = sides
    other = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    left, right = write_layout(many, "k", 8), write_layout(other, "k", 8)
    assert set(left.heavy) == set(right.heavy) == {7}
    out = join_layouts(left, right, 500)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, many.join(other, "k").collect()))
    none = write_layout(other.limit(0), "k", 8)
    assert not none.heavy and join_layouts(left, none).count() == 0
    with pytest.raises(ValueError):
        join_layouts(left, write_layout(other, "k", 4))


def test_no_exchange_for_ordinary_keys(spark, sides):
    many, few = sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = write_layout(many, "k", 8), write_layout(few, "k", 8)
        plain = left.ordinary().join(right.ordinary(), "k")
        plan = plain._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        whole = join_layouts(left, right, 100)._jdf.queryExecution().executedPlan().toString()
        # the heavy branches alone move rows, by key and salt
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", whole)
        assert keys and all("_salt" in k for k in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
