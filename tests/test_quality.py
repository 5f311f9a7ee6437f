"""Cleaning rules: three-valued verdicts row by row, quarantine, fills."""

from pyspark.sql import functions as F

from incidentflow.operators import quality as Q
from incidentflow.plans import standins
from tests.conftest import SF01


def _persons(spark, rows):
    return spark.createDataFrame(rows, "numero_expedient string, descripcio_tipus_persona string, edat int, descripcio_sexe string")


def test_person_rules_three_valued(spark):
    rows = [
        ("a", "Conductor", None, None),  # NULL age: always unknown -> dropped
        ("b", None, 30, "Home"),  # NULL type, age 30: every rule false -> kept
        ("c", None, 10, "Dona"),  # NULL type, age 10: driver rule unknown -> dropped
        ("d", "Conductor", 12, None),  # driver under 14 -> rejected
        ("e", "Vianant", 12, None),  # pedestrian of 12 -> kept
        ("f", "Vianant", 111, None),  # over 110 -> rejected
    ]
    res = Q.clean_persons(_persons(spark, rows))
    assert sorted(r.numero_expedient for r in res.valid.collect()) == ["b", "e"]
    rej = {r.numero_expedient: (r.violated_rules, r.unknown_rules) for r in res.rejected.collect()}
    assert rej["d"][0] == ["driver_under_min_age"]
    assert rej["f"][0] == ["age_over_max"]
    assert rej["a"][0] == [] and set(rej["a"][1]) == {"driver_under_min_age", "age_negative", "age_over_max"}
    assert rej["c"] == ([], ["driver_under_min_age"])
    # fills apply to the kept rows: missing sex becomes the unknown word
    kept = {r.numero_expedient: r.descripcio_sexe for r in res.valid.collect()}
    assert kept["e"] == "Desconegut"


def test_on_unknown_keep(spark):
    rows = [("a", "Conductor", None, None), ("c", None, 10, None)]
    res = Q.clean_persons(_persons(spark, rows), on_unknown="keep")
    assert res.valid.count() == 2 and res.rejected.count() == 0


def test_reading_rules_by_prefix(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01", "X", "TM", None),  # temperature without value: unknown -> dropped
            ("2024-01-01", "X", "DVM10", None),  # wind direction without value -> dropped
            ("2024-01-01", "X", "RS24h", None),  # no rule for the family -> kept
            ("2024-01-01", "X", None, 1.0),  # NULL acronym, value inside every range -> kept
            ("2024-01-01", "X", None, 50.0),  # NULL acronym, value outside T range -> unknown, dropped
            ("2024-01-01", "X", "TX", 45.0),  # hot -> rejected
            ("2024-01-01", "X", "HRM", 101.0),  # humidity over 100 -> rejected
            ("2024-01-01", "X", "PPT", -1.0),  # negative rain -> rejected
            ("2024-01-01", "X", "PPT", 3.0),  # rain -> kept
        ],
        "data_lectura string, codi_estacio string, acronim string, valor double",
    )
    res = Q.clean_readings(df)
    kept = sorted((r.acronim or "-", r.valor) for r in res.valid.collect())
    assert kept == [("-", 1.0), ("PPT", 3.0), ("RS24h", None)]
    assert res.valid.count() + res.rejected.count() == df.dropDuplicates().count()


def test_valid_plus_rejected_is_dedup_input(spark):
    raw = standins.persons(spark, SF01)
    res = Q.clean_persons(raw)
    assert res.valid.count() + res.rejected.count() == raw.dropDuplicates().count() == 59_994


def test_sum_rule_counts(spark):
    res = Q.clean_accidents(standins.accidents(spark, SF01))
    assert res.valid.count() == 15_000 - 4_017


def test_fill_text_skips_absent_and_non_string(spark):
    df = spark.createDataFrame([(None, None)], "num_postal int, descripcio_sexe string")
    out = Q.fill_text(df).first()
    assert out.num_postal is None and out.descripcio_sexe == "Desconegut"
    z = Q.fill_zero(spark.createDataFrame([(None,)], "numero_morts int")).first()
    assert z.numero_morts == 0


def test_rules_run_on_a_stream(spark, tmp_dir):
    from incidentflow.streaming.rowwise import start_cleaning

    src = f"{tmp_dir}/in"
    rows = [("2024-01-01", "X", "TM", 50.0), ("2024-01-01", "X", "TM", 20.0), ("2024-01-02", "Y", "HRM", 40.0)]
    spark.createDataFrame(rows, "data_lectura string, codi_estacio string, acronim string, valor double").select(
        F.to_date("data_lectura").alias("data_lectura"), "codi_estacio", "acronim", "valor"
    ).write.parquet(src)
    q = start_cleaning(spark, src, f"{tmp_dir}/valid", f"{tmp_dir}/rejected", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/valid").count() == 2
    assert spark.read.parquet(f"{tmp_dir}/rejected").count() == 1


def test_stream_dedup_within_watermark(spark, tmp_dir):
    from incidentflow.streaming.rowwise import checked_readings, readings_stream

    src = f"{tmp_dir}/in2"
    rows = [("2024-01-01", "X", "TM", 20.0), ("2024-01-01", "X", "TM", 20.0), ("2024-01-01", "X", "TM", 99.0)]
    spark.createDataFrame(rows, "data_lectura string, codi_estacio string, acronim string, valor double").select(
        F.to_date("data_lectura").alias("data_lectura"), "codi_estacio", "acronim", "valor"
    ).write.parquet(src)
    valid, rejected = checked_readings(readings_stream(spark, src), watermark="2 days")
    q = (
        valid.writeStream.format("parquet").option("path", f"{tmp_dir}/v2").option("checkpointLocation", f"{tmp_dir}/c2")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/v2").count() == 1


def test_rule_counts_before_dedup_match_blueprint(spark):
    """The blueprint's draft applied the rules without de-duplication."""
    persons = Q.apply_rules(Q.fill_text(standins.persons(spark, SF01)), Q.person_rules()).valid
    readings = standins.readings(spark, SF01)
    assert persons.count() == 47_681
    assert Q.apply_rules(readings, Q.reading_rules()).valid.count() == 6_768
    assert readings.where(F.col("valor").isNotNull()).count() == 9_756


def test_a_replayed_batch_writes_no_row_twice(spark, tmp_dir):
    from incidentflow.streaming.rowwise import write_checked

    rows = [("2024-01-01", "X", "TM", 50.0), ("2024-01-02", "Y", "HRM", 40.0)]
    batch = spark.createDataFrame(rows, "data_lectura string, codi_estacio string, acronim string, valor double")
    for epoch in (0, 1, 1):
        write_checked(batch, epoch, f"{tmp_dir}/valid", f"{tmp_dir}/rejected")
    assert spark.read.parquet(f"{tmp_dir}/valid").count() == 2 and spark.read.parquet(f"{tmp_dir}/rejected").count() == 2
