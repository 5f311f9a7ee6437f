"""ROC AUC on time windows of new data, with an alert below a floor.

The counts of positives and negatives per window and score are sums, so they
merge: in a stream they are the state of an event-time window under a watermark,
and a window's counts leave the state once, complete, when the watermark passes
its end.  The area of a window is then the batch operator's over these counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from incidentflow.ml.metrics import auc_of_counts
from incidentflow.session import releasing

FLOOR = 0.90


def window_counts(scored: DataFrame, time: str, window: str, label: str = "label", score: str = "score") -> DataFrame:
    """``window_start, score, pos, neg`` of every tumbling window; rows without
    a time, label or score count nowhere."""
    known = scored.where(F.col(time).isNotNull() & F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.groupBy(F.window(time, window).alias("w"), F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )
    return counts.select(F.col("w.start").alias("window_start"), "score", "pos", "neg")


def judged(counts: DataFrame, floor: float = FLOOR) -> DataFrame:
    """``window_start, pos, neg, roc_auc, alert`` of windows from their counts;
    without both classes the area is null and nothing is alerted."""
    out = auc_of_counts(counts, ["window_start"], totals=True)
    below: Column = F.coalesce(F.col("roc_auc") < floor, F.lit(False))
    return out.select("window_start", "pos", "neg", "roc_auc", below.alias("alert"))


def auc_windows(scored: DataFrame, time: str, window: str = "1 day", floor: float = FLOOR, label: str = "label", score: str = "score") -> DataFrame:
    """The batch form: every window of the scored rows, judged."""
    return judged(window_counts(scored, time, window, label, score), floor)


def start_monitor(
    scored: DataFrame,
    time: str,
    out_path: str,
    checkpoint_location: str,
    window: str = "1 day",
    delay: str = "2 hours",
    floor: float = FLOOR,
    label: str = "label",
    score: str = "score",
    available_now: bool = True,
) -> StreamingQuery:
    """Watches a stream of scored rows: a window is judged once the watermark
    (the latest time seen less ``delay``) has passed its end; rows that come
    later than that are dropped, as the watermark says.  A micro-batch writes
    its windows to a folder ``epoch=<n>`` of its own, so that a replayed one
    overwrites what it had written."""
    counts = window_counts(scored.withWatermark(time, delay), time, window, label, score)

    def write(batch: DataFrame, epoch: int) -> None:
        with releasing(batch.sparkSession):
            judged(batch, floor).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")

    writer = counts.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
