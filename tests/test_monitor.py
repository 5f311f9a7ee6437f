"""ROC AUC on time windows: batch, and a stream with late rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from incidentflow.ml import monitor

SCHEMA = "scored_at timestamp_ntz, label int, score double"


def _t(day, hour):
    return dt.datetime(2024, 1, day, hour)


def _auc(rows):
    p, n = [s for _, y, s in rows if y == 1], [s for _, y, s in rows if y == 0]
    return round(sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n)), 9) if p and n else None


def _day(day, flip):
    """Scores follow the labels; ``flip`` of ten rows are the wrong way round."""
    return [(_t(day, k % 24), (k % 2) ^ (k % 20 < 2 * flip), k % 2 * 0.5 + k % 7 / 20) for k in range(60)]


def test_batch_windows(spark):
    days = {1: _day(1, 0), 2: _day(2, 4), 3: [(_t(3, 1), 1, 0.5)]}
    df = spark.createDataFrame([r for d in days.values() for r in d] + [(None, 1, 0.1), (_t(1, 1), None, 0.1), (_t(1, 1), 1, None)], SCHEMA)
    got = {r.window_start.day: r for r in monitor.auc_windows(df, "scored_at").collect()}
    assert {d: r.roc_auc for d, r in got.items()} == {d: _auc(rows) for d, rows in days.items()}
    assert {d: r.alert for d, r in got.items()} == {1: False, 2: True, 3: False}
    assert monitor.auc_windows(df.limit(0), "scored_at").count() == 0


def test_stream_judges_closed_windows_and_drops_late_rows(spark, tmp_dir):
    source, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    steps = [
        _day(1, 0)[:30],
        _day(1, 0)[30:] + [(_t(2, 0), 1, 0.9)],  # still in time: the watermark is two hours behind
        _day(2, 4) + [(_t(3, 5), 0, 0.1)],  # closes day 1 and day 2
        [(_t(1, 5), 0, 0.99)] * 50 + [(_t(4, 12), 1, 0.2)],  # late rows of day 1 count nowhere; day 3 closes
        [(_t(5, 12), 1, 0.2)],
    ]
    for k, rows in enumerate(steps):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(source, f"step={k}"))
        stream = spark.readStream.schema(SCHEMA).parquet(os.path.join(source, "step=*")).withColumn("at", F.col("scored_at").cast("timestamp"))
        monitor.start_monitor(stream, "at", out, os.path.join(tmp_dir, "ckpt"), delay="2 hours").awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == len({r.window_start for r in got})  # every window once
    by_day = {r.window_start.day: r for r in got}
    assert by_day[1].roc_auc == _auc(_day(1, 0)) and not by_day[1].alert and by_day[1].pos + by_day[1].neg == 60
    assert by_day[2].roc_auc == _auc(_day(2, 4) + [(_t(2, 0), 1, 0.9)]) and by_day[2].alert
    assert by_day[3].roc_auc is None and not by_day[3].alert
    assert 5 not in by_day  # still open
