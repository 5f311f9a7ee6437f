"""Tables stored for their joins: ordinary keys in buckets, heavy keys apart.

A bucketed table needs no exchange for a join on its key, but a key with a large
share of the rows makes one bucket, and its task, as large.  So keys are counted
when a table is written: a key with more rows than an average bucket is heavy, its
rows go to a table of their own, and the rest is bucketed.  The ordinary rows of
two such tables join bucket by bucket; what a heavy key of either side touches is
joined apart, its rows dealt out by a salt.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.session import scratch_path

#: Rows of a heavy key that one task joins.
SALT_ROWS = 200_000


@dataclass
class Layout:
    """A stored table: catalog name of the bucketed part, path of the heavy
    keys' rows, and the heavy keys (fewer than buckets) with their rows."""

    spark: SparkSession
    key: str
    buckets: int
    name: str
    heavy_path: str
    heavy: dict

    def ordinary(self) -> DataFrame:
        return self.spark.table(self.name)

    def heavy_rows(self) -> DataFrame:
        return self.spark.read.parquet(self.heavy_path)

    def drop(self) -> None:
        """Forgets the catalog entry; the files go with their folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_layout(df: DataFrame, key: str, buckets: int, path: str | None = None, heavy_share: float = 1.0) -> Layout:
    """Stores ``df`` under ``path`` (a fresh folder under the checkpoint folder
    by default) for joins on ``key``; rows with a null key go with the ordinary
    ones (they join nothing, but stay in the table).

    Heavy is a key with more than ``heavy_share`` of the rows a bucket has on
    average, so there are at most ``buckets / heavy_share`` of them.  ``df`` is
    read three times: give it from a table, or it is computed as often.
    """
    spark = df.sparkSession
    path = (path or scratch_path(spark, "layout")).rstrip("/")
    counts = df.groupBy(key).count()
    total = df.count()
    heavy = {r[0]: r[1] for r in counts.where(F.col(key).isNotNull() & (F.col("count") > heavy_share * total / buckets) & (F.col("count") > 1)).collect()}
    name = f"layout_{uuid.uuid4().hex}"
    is_heavy = F.coalesce(F.col(key).isin(list(heavy)), F.lit(False)) if heavy else F.lit(False)
    ordinary = df.where(~is_heavy).repartition(buckets, key)  # one file a bucket
    ordinary.write.option("path", f"{path}/ordinary").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    df.where(is_heavy).write.mode("overwrite").parquet(f"{path}/heavy")
    return Layout(spark, key, buckets, name, f"{path}/heavy", heavy)


def _salted(many: DataFrame, few: DataFrame, key: str, shares: dict) -> DataFrame:
    """``many`` joined to ``few`` on a heavy key: rows of ``many`` are dealt out
    over as many salts as the key has shares, rows of ``few`` are there for each."""
    n = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col(key))
    spread = many.withColumn("_salt", F.pmod(F.xxhash64(*many.columns), n).cast("int"))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return spread.join(copies, [key, "_salt"]).drop("_salt")


def join_layouts(left: Layout, right: Layout, salt_rows: int = SALT_ROWS) -> DataFrame:
    """The inner join of two tables stored on the same key and buckets:
    ``key``, the other columns of ``left``, then those of ``right`` (whose names
    must differ).  No exchange for ordinary keys; a heavy key's rows move once,
    by key and salt, the other side's rows of that key once for each salt."""
    if left.key != right.key or left.buckets != right.buckets:
        raise ValueError("the layouts have another key or number of buckets")
    key = left.key
    out = left.ordinary().join(right.ordinary(), key)
    only = lambda df, keys: df.where(F.col(key).isin(list(keys)) if keys else F.lit(False))
    salts = lambda heavy: {k: 1 + n // salt_rows for k, n in heavy.items()}
    both = left.heavy.keys() & right.heavy.keys()
    # a key that is heavy on one side has its few rows among the other's ordinary ones
    l_only, r_only = {k: n for k, n in left.heavy.items() if k not in both}, {k: n for k, n in right.heavy.items() if k not in both}
    parts = []
    if l_only:
        parts.append(_salted(only(left.heavy_rows(), l_only), only(right.ordinary(), l_only), key, salts(l_only)))
    if r_only:
        parts.append(_salted(only(right.heavy_rows(), r_only), only(left.ordinary(), r_only), key, salts(r_only)))
    if both:
        larger = {k: max(left.heavy[k], right.heavy[k]) for k in both}
        parts.append(_salted(only(left.heavy_rows(), both), only(right.heavy_rows(), both), key, salts(larger)))
    for part in parts:
        out = out.unionByName(part)
    return out
