"""Sources and sinks: CSV under schema, zones, JDBC, resource selection."""

import os

from pyspark.sql import functions as F

from incidentflow.operators import enrich
from incidentflow.schemas import READINGS, table_name_from_path
from incidentflow.sources import csv, jdbc, resources, zones

# The four stations of the station catalogue and their
# coordinates (code, latitude, longitude).
STATIONS = [("D5", 41.41864, 2.12379), ("X2", 41.38943, 2.18847), ("X4", 41.3839, 2.16775), ("X8", 41.37919, 2.1054)]
HEADER = (
    '"CODI_ESTACIO","NOM_ESTACIO","EMPLACAMENT","CODI_BARRI","NOM_BARRI","CODI_DISTRICTE","NOM_DISTRICTE",'
    '"CODI_MUNICIPI","NOM_MUNICIPI","CODI_COMARCA","NOM_COMARCA","CODI_PROVINCIA","NOM_PROVINCIA","ALTITUD",'
    '"LATITUD","LONGITUD","CODI_XARXA","NOM_XARXA","CODI_ESTAT","DATA_ALTA","DATA_BAIXA","ACRÒNIM"'
)


def _catalogue(path):
    lines = [HEADER]
    for code, lat, lon in STATIONS:
        for acr in ("TM", "HRM", "PPT"):
            lines.append(f'"{code}","n","e","01","b","05","d","080193","Barcelona",13,"c",8,"p",10,{lat},{lon},1,"XEMA",2,1995-11-03,NA,"{acr}"')
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_catalogue_csv_schema_and_coords(spark, tmp_dir):
    path = os.path.join(tmp_dir, "2020_station_catalogue.csv")
    _catalogue(path)
    cat = csv.read_station_catalogue(spark, path)
    assert cat.count() == 12
    first = cat.first()
    assert first.CODI_BARRI == "01" and first.DATA_BAIXA is None and str(first.DATA_ALTA) == "1995-11-03"
    coords = {r.codi_estacio: (r.latitud_wgs84, r.longitud_wgs84) for r in enrich.station_coords(cat).collect()}
    assert coords == {c: (a, b) for c, a, b in STATIONS}
    named = csv.with_source_table(cat).select("source_table").distinct().collect()
    assert [r.source_table for r in named] == [table_name_from_path(path)] == ["t2020_station_catalogue"]


def test_zone_write_list_copy_and_typed_save(spark, tmp_dir):
    root = os.path.join(tmp_dir, "zone")
    df = spark.createDataFrame([("2024-01-02", "X", "TM", "12.5"), ("bad", "Y", "HRM", "x")], "data_lectura string, codi_estacio string, acronim string, valor string")
    zones.save_typed(df, READINGS, zones.zone_table_path(root, "readings"))
    zones.copy_table(spark, zones.zone_table_path(root, "readings"), zones.zone_table_path(root, "copy"))
    assert zones.list_tables(spark, root) == ["copy", "readings"]
    back = zones.read_zone_table(spark, root, "copy")
    assert dict(back.dtypes) == {"data_lectura": "date", "codi_estacio": "string", "acronim": "string", "valor": "double"}
    rows = sorted(back.collect(), key=lambda r: r.codi_estacio)
    assert rows[0].valor == 12.5 and rows[1].valor is None and rows[1].data_lectura is None
    assert zones.preview(back, 1, order_by=["codi_estacio"]).first().codi_estacio == "X"


def test_jdbc_round_trip_embedded_derby(spark, tmp_dir):
    url = f"jdbc:derby:{tmp_dir}/derby_db;create=true"
    df = spark.range(100).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).cast("int").alias("v"))
    jdbc.write_jdbc(df, url, "T_READINGS", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = jdbc.read_jdbc(
        spark, url, "T_READINGS", driver="org.apache.derby.jdbc.EmbeddedDriver",
        partition_column="ID", lower_bound=0, upper_bound=100, num_partitions=4,
    )
    assert back.rdd.getNumPartitions() == 4
    assert back.agg(F.sum("V")).first()[0] == 9900


def test_resource_selection(spark):
    cat = spark.createDataFrame(
        [
            ("https://x/api?resource_id=abc&limit=5", "abc", "Accidents 2025 Òmnibus", "CSV", "https://x/a.csv"),
            ("https://x/api?resource_id=def", "def", "", "text/csv", "https://x/2025/b"),
            ("https://x/api?resource_id=ghi", "ghi", "Persones 2025.csv", "CSV", " "),
            ("https://x/api?resource_id=jkl", "jkl", "Meteo 2024", "CSV", "https://x/c.csv"),
        ],
        "api_link string, resource_id string, name string, format string, url string",
    )
    ids = cat.select(resources.resource_id_of("api_link").alias("rid")).collect()
    assert [r.rid for r in ids] == ["abc", "def", "ghi", "jkl"]
    out = {r.resource_id: r.file_name for r in resources.select_resources(cat, "2025").collect()}
    assert out == {"abc": "Accidents_2025_Òmnibus.csv", "def": "def.csv"}


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    from pyspark.sql import types as T

    for name, lines in (("one.csv", ["b,a,other", "x,1,z"]), ("two.csv", ["a,b", "2,y"])):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    paths = [os.path.join(tmp_dir, n) for n in ("one.csv", "two.csv")]
    assert sorted(map(tuple, csv.read_csv(spark, paths, schema).collect())) == [(1, "x", None), (2, "y", None)]


def test_unparsable_values_are_named(spark):
    df = spark.createDataFrame([("2024-01-02", "X", "TM", "12.5"), ("bad", "Y", "HRM", "x"), (None, "Z", "TM", None)], "data_lectura string, codi_estacio string, acronim string, valor string")
    out = zones.unparsable(df, READINGS).collect()
    assert [(r.codi_estacio, r.unparsable_columns) for r in out] == [("Y", ["data_lectura", "valor"])]


def test_sorted_storage_has_ranges_that_do_not_overlap(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sorted")
    zones.write_table(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(6), path, sort_within=["k"])
    files = spark.read.parquet(path).groupBy("_metadata.file_name").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(files, files[1:]))


def test_written_tables_can_be_released(spark):
    from incidentflow import session

    df = session.materialise(spark.range(3).toDF("a"), "release_me")
    path = session._WRITTEN[-1]
    assert df.count() == 3 and "release_me" in path
    keep, session._WRITTEN[:] = session._WRITTEN[:-1], [path]
    assert session.release(spark) == 1
    session._WRITTEN[:] = keep
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    assert not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
