"""Metrics against brute force and the blueprint's golden values."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from incidentflow.ml import metrics as ME
from incidentflow.operators.ordered import running_totals
from incidentflow.plans import standins
from tests.conftest import SF001, SF01


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _brute_ap(y, s):
    ap, P = 0.0, y.sum()
    for t in np.unique(s)[::-1]:
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        ap += ((y[s == t] == 1).sum() / P) * prec
    return ap


@pytest.mark.parametrize("d,auc,ap", [(SF001, 0.492438693, 0.051246409), (SF01, 0.488175051, 0.058516275)])
def test_auc_ap_golden(spark, d, auc, ap):
    scored = standins.scored_rows(spark, d).withColumn("all", F.lit("all"))
    assert ME.roc_auc(scored, ["all"]).first().roc_auc == pytest.approx(auc, abs=1e-9)
    assert ME.average_precision(scored, ["all"]).first().average_precision == pytest.approx(ap, abs=1e-9)


def test_auc_ap_vs_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    y = (rng.random(800) < 0.2).astype(int)
    s = np.round(rng.random(800) * 0.5 + y * 0.2, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double").withColumn("g", F.lit(1))
    assert ME.roc_auc(df, ["g"]).first().roc_auc == pytest.approx(_brute_auc(y, s), abs=1e-9)
    assert ME.average_precision(df, ["g"]).first().average_precision == pytest.approx(_brute_ap(y, s), abs=1e-9)


def test_step_ap_differs_from_interpolated_area(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.8)], "label int, score double").withColumn("g", F.lit(1))
    assert ME.average_precision(df, ["g"]).first().average_precision == pytest.approx(0.5)


def test_running_totals_equals_window(spark):
    df = spark.range(2000).select((F.col("id") % 4).alias("p"), (F.col("id") * 7 % 1999).cast("double").alias("k"), F.lit(1).alias("v"))
    df = df.groupBy("p", "k").agg(F.sum("v").alias("v"))
    got = running_totals(df, ["p"], "k", ["v"])
    want = df.withColumn("cum_v", F.sum("v").over(Window.partitionBy("p").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.select("p", "k", "cum_v").exceptAll(want.select("p", "k", "cum_v")).count() == 0
    got_d = running_totals(df, ["p"], "k", ["v"], descending=True)
    want_d = df.withColumn("cum_v", F.sum("v").over(Window.partitionBy("p").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)))
    assert got_d.select("p", "k", "cum_v").exceptAll(want_d.select("p", "k", "cum_v")).count() == 0


def test_sweep_matches_brute_force_and_recall_falls(spark):
    scored = standins.scored_rows(spark, SF001)
    sweep = ME.threshold_sweep(scored, ["split"]).where("split = 'val'").orderBy("threshold").collect()
    pdf = scored.where("split = 'val'").toPandas()
    y, s = pdf["label"].to_numpy(), pdf["score"].to_numpy()
    assert len(sweep) == 91
    for r in sweep:
        pred = s >= r.threshold
        tp = int((pred & (y == 1)).sum())
        assert r.tp == tp and r.fp == int((pred & (y == 0)).sum())
    recalls = [r.recall for r in sweep]
    assert all(a >= b for a, b in zip(recalls, recalls[1:]))


@pytest.mark.parametrize("tp,fp,fn,f1", [(74, 6, 17, 0.8655), (59, 8, 19, 0.8138), (55, 37, 36, 0.6011)])
def test_f1_goldens_from_confusion_counts(spark, tp, fp, fn, f1):
    rows = [(1, 0.9)] * tp + [(0, 0.9)] * fp + [(1, 0.1)] * fn + [(0, 0.1)] * 100
    df = spark.createDataFrame(rows, "label int, score double").withColumn("g", F.lit(1))
    rep = {r.class_name: r for r in ME.classification_report(df, ["g"], 0.5).collect()}
    assert round(rep["1"].f1, 4) == f1
    cm = {(r.label, r.pred): r.n for r in ME.confusion_matrix(df, ["g"], 0.5).collect()}
    assert cm == {(0, 0): 100, (0, 1): fp, (1, 0): fn, (1, 1): tp}


def test_best_threshold_prefers_f1_then_recall(spark):
    scored = standins.scored_rows(spark, SF001)
    sweep = ME.threshold_sweep(scored, ["split"])
    best = {r.split: r for r in ME.best_threshold(sweep, ["split"]).collect()}
    for split, b in best.items():
        top = sweep.where(F.col("split") == split).agg(F.max("f1")).first()[0]
        assert b.f1 == top


def test_metrics_stable_across_partitions_and_order(spark):
    scored = standins.scored_rows(spark, SF001)
    base = ME.roc_auc(scored, ["split"]).collect(), ME.average_precision(scored, ["split"]).collect()
    for n in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            shuffled = standins.scored_rows(spark, SF001).repartition(n, "row_key")
            got = ME.roc_auc(shuffled, ["split"]).collect(), ME.average_precision(shuffled, ["split"]).collect()
            assert sorted(got[0]) == sorted(base[0]) and sorted(got[1]) == sorted(base[1])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_running_totals_of_doubles(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("p"), F.col("id").cast("double").alias("k"), (F.col("id") * 0.25).alias("v"))
    want = df.withColumn("cum_v", F.sum("v").over(Window.partitionBy("p").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    got = running_totals(df, ["p"], "k", ["v"])
    assert got.select("p", "k", "cum_v").exceptAll(want.select("p", "k", "cum_v")).count() == 0


def test_running_totals_and_numbers_of_null_groups_and_one_large_group(spark):
    from incidentflow.operators.ordered import row_numbers

    df = spark.range(3000).select(F.when(F.col("id") % 10 > 7, F.lit("b")).when(F.col("id") % 10 > 5, F.lit(None)).otherwise("a").alias("p"), F.col("id").alias("k"), F.lit(2).alias("v"))
    w = Window.partitionBy("p").orderBy("k")
    want = df.select("*", F.sum("v").over(w).alias("cum_v"), F.sum("v").over(Window.partitionBy("p")).alias("all_v"), F.row_number().over(w).alias("n"))
    got = row_numbers(running_totals(df, ["p"], "k", ["v"], total_prefix="all_"), ["p"], [F.col("k")], "n")
    cols = ["p", "k", "cum_v", "all_v", "n"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_null_and_one_class_groups(spark):
    rows = [("x", 1, 0.9), ("x", 0, 0.1), (None, 1, 0.2), (None, 0, 0.3), ("neg", 0, 0.5), ("pos", 1, 0.5)]
    df = spark.createDataFrame(rows, "split string, label int, score double")
    auc = {r.split: r.roc_auc for r in ME.roc_auc(df, ["split"]).collect()}
    assert auc == {"x": 1.0, None: 0.0, "neg": None, "pos": None}
    assert len(ME.average_precision(df, ["split"]).collect()) == 4
    both = df.select(F.lit("m1").alias("model"), "*").unionAll(df.select(F.lit("m2").alias("model"), "split", "label", (1 - F.col("score")).alias("score")))
    out = {(r.model, r.split): r for r in ME.metric_summary(both, "split", "x", model="model").collect()}
    assert set(out) == {(m, s) for m in ("m1", "m2") for s in ("x", None, "neg", "pos")}
    assert out["m1", "x"].roc_auc == 1.0 and out["m2", "x"].roc_auc == 0.0
    chosen = ME.chosen_thresholds(both, "split", "x", "model")
    at = ME.at_chosen_threshold(both, chosen, "model")
    assert at.count() == both.count() and at.where("threshold IS NULL").count() == 0
