"""Driver contract: entry runs, every SQL twin has a query, names are unique."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_sql_keys_are_queries():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 55


def test_cluster_conf_sizes_partitions():
    from incidentflow.session import cluster_conf

    conf = cluster_conf(4000, shuffle_bytes=100 * 1024**4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (128 * 1024**2)
    assert int(cluster_conf(100)["spark.sql.shuffle.partitions"]) == 300
