"""Database tables over JDBC, read in parallel partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Whole-table read.  With ``partition_column`` and bounds the read is
    split into ``num_partitions`` range queries run by separate tasks; without
    them the table comes through one task, so pass them for large tables."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if driver:
        reader = reader.option("driver", driver)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    driver: str | None = None,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Overwrite (default) a database table; ``num_partitions`` caps the
    number of concurrent connections."""
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if driver:
        writer = writer.option("driver", driver)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
