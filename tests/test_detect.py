"""Types of a CSV from its data, against DuckDB's."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from incidentflow.sources.detect import detect_types, read_detected

COLUMNS = {
    "flag": ["true", "FALSE", "True", ""],
    "whole": ["1", "-5", "7", "9000000000"],
    "mixed": ["1", "2.5", "3e4", ".5"],
    "day": ["2024-01-31", "2024-02-29", "", "1999-12-01"],
    "moment": ["2024-01-31 10:00:00", "2024-02-29 23:59:59.5", "", "1999-12-01 00:00:00"],
    "day_or_moment": ["2024-01-31", "2024-02-29 23:59:59", "", "1999-12-01"],
    "plus": ["+7", "1", "", "2"],
    "no_day": ["2024-01-31", "2024-02-30", "", "1999-12-01"],
    "words": ["a", "1", "2.0", "true"],
    "whole_or_day": ["1", "2024-01-31", "", "2"],
    "flag_or_whole": ["true", "1", "", "0"],
    "nothing": ["", "", "", ""],
}
DUCK = {"BOOLEAN": "boolean", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("detect"))
    with open(os.path.join(out, "t.csv"), "w") as f:
        f.write(",".join(COLUMNS) + "\n")
        for row in zip(*COLUMNS.values()):
            f.write(",".join(row) + "\n")
    return out


def test_types_are_duckdbs(spark, folder):
    path = os.path.join(folder, "t.csv")
    duck = {r[0]: DUCK[r[1]] for r in duckdb.sql(f"DESCRIBE SELECT * FROM read_csv('{path}', header = true, sample_size = -1)").fetchall()}
    df = read_detected(spark, path)
    own = dict(df.dtypes)
    # here a date is a timestamp too; there such a mix stays text
    assert (own.pop("day_or_moment"), duck.pop("day_or_moment")) == ("timestamp_ntz", "string")
    assert own == duck
    assert df.where("day = DATE'2024-02-29'").select("whole", "flag").first() == (-5, False)
    assert df.select(F.sum("mixed")).first()[0] == 30004.0


def test_codes_keep_their_zeros(spark):
    df = spark.createDataFrame([("007", "1"), ("8", "0")], "code string, n string")
    assert [f.dataType.simpleString() for f in detect_types(df)] == ["string", "bigint"]
    assert [f.dataType.simpleString() for f in detect_types(df, keep_zeros=False)] == ["bigint", "bigint"]


def test_odd_values_and_no_rows(spark):
    df = spark.createDataFrame([("99999999999999999999", "1d", "nan", " 1")], "big string, suffix string, nan string, blank string")
    assert [f.dataType.simpleString() for f in detect_types(df)] == ["double", "string", "double", "string"]
    assert [f.dataType.simpleString() for f in detect_types(df.limit(0))] == ["string"] * 4
