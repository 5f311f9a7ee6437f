"""Splits: blueprint counts, partition properties, bucketed ranking."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from incidentflow.functions.labels import severity_label
from incidentflow.operators import sampling
from incidentflow.plans import standins
from tests.conftest import SF001, SF01


def _split(spark, d):
    acc = standins.accidents(spark, d).withColumn("label", severity_label())
    return sampling.stratified_split(acc, "numero_expedient", ["nom_barri"], "label")


@pytest.mark.parametrize(
    "d,rows,pos",
    [(SF001, (1053, 222, 225), (56, 8, 13)), (SF01, (10502, 2251, 2247), (630, 136, 133))],
)
def test_stratified_split_counts(spark, d, rows, pos):
    got = {r.split: (r.n, r.p) for r in _split(spark, d).groupBy("split").agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()}
    assert tuple(got[s][0] for s in ("train", "val", "test")) == rows
    assert tuple(got[s][1] for s in ("train", "val", "test")) == pos


def test_every_row_in_exactly_one_part_and_stable(spark):
    a = _split(spark, SF001)
    assert a.count() == a.select("numero_expedient").distinct().count() == 1500
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        b = _split(spark, SF001)
        assert a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_bucketed_rank_equals_plain_window(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    got = sampling.rank_by_hash(df, "g", "k", sub_digits=2)
    adaptive = sampling.rank_by_hash(df, "g", "k", rows_per_bucket=20)
    assert adaptive.select("k", "__rank").exceptAll(got.select("k", "__rank")).count() == 0
    w = Window.partitionBy("g").orderBy(sampling.hash_order("k"), "k")
    want = df.withColumn("__rank", F.row_number().over(w))
    assert got.select("k", "__rank").exceptAll(want.select("k", "__rank")).count() == 0


def test_group_split_keeps_groups_whole(spark):
    rows = [(i // 3, i, i % 7 == 0, f"b{i % 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "grp long, rid long, flag boolean, barri string").withColumn("label", F.col("flag").cast("int"))
    out = sampling.group_split(df, "grp", ["barri"], "label")
    assert out.count() == 600
    assert out.groupBy("grp").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_folds_balanced(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    folds = sampling.stratified_folds(df, "k", "label", 3)
    sizes = {(r.label, r.fold): r.n for r in folds.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    assert sorted(sizes[(1, f)] for f in range(3)) == [10, 10, 10]
    assert sorted(sizes[(0, f)] for f in range(3)) == [90, 90, 90]


def test_hash_sample_is_repeatable(spark):
    acc = standins.accidents(spark, SF001)
    a = [r.numero_expedient for r in sampling.hash_sample(acc, "numero_expedient", 50).collect()]
    b = [r.numero_expedient for r in sampling.hash_sample(acc.repartition(7), "numero_expedient", 50).collect()]
    assert a == b and len(a) == 50


def test_null_label_and_group_key_rows_are_kept(spark):
    rows = [(None if i % 50 == 0 else i // 2, i, None if i % 7 == 0 else i % 2, f"b{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "grp long, rid long, label int, barri string")
    assert sampling.stratified_split(df, "rid", ["barri"], "label").count() == 300
    assert sampling.group_split(df, "grp", ["barri"], "label").count() == 300
    assert sampling.stratified_folds(df, "rid", "label").count() == 300
