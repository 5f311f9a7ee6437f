"""The row-wise rules on a stream: readings arriving as files are checked as
they come, valid rows and quarantined rows written per micro-batch.

The rules, fills, labels and mappings contain no aggregate, so the same
Column expressions serve batch and streaming plans.  Full-row
de-duplication of a stream needs state; it is offered only within an
event-time watermark (``dropDuplicatesWithinWatermark``), which bounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from incidentflow.operators.quality import apply_rules, reading_rules
from incidentflow.schemas import READINGS


def readings_stream(spark: SparkSession, source: str, schema: T.StructType = READINGS, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source)


def checked_readings(stream: DataFrame, watermark: str | None = None, event_time: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) streaming frames.  With ``watermark`` (e.g.
    ``'2 days'``) repeated rows inside the watermark are dropped first."""
    if watermark:
        stream = (
            stream.withColumn(event_time, F.col("data_lectura").cast("timestamp"))
            .withWatermark(event_time, watermark)
            .dropDuplicatesWithinWatermark()
            .drop(event_time)
        )
    res = apply_rules(stream, reading_rules())
    return res.valid, res.rejected


def write_checked(batch: DataFrame, epoch_id: int, valid_path: str, rejected_path: str) -> None:
    """Both outputs of one micro-batch, from one reading of it."""
    batch = batch.persist()
    try:
        res = apply_rules(batch, reading_rules())
        res.valid.write.mode("overwrite").parquet(f"{valid_path.rstrip('/')}/epoch={epoch_id}")
        res.rejected.write.mode("overwrite").parquet(f"{rejected_path.rstrip('/')}/epoch={epoch_id}")
    finally:
        batch.unpersist()


def start_cleaning(
    spark: SparkSession,
    source: str,
    valid_path: str,
    rejected_path: str,
    checkpoint_location: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the cleaning stream; each micro-batch writes its valid rows to a
    folder ``epoch=<n>`` of its own under ``valid_path`` and its quarantined
    rows likewise under ``rejected_path``.  The checkpoint makes a restarted
    query resume where it stopped; a batch that is replayed after a failure
    overwrites its folders, so no row is written twice."""
    stream = readings_stream(spark, source)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        write_checked(batch, epoch_id, valid_path, rejected_path)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
