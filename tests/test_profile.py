"""Profiles: one-pass statistics against pandas/numpy."""

import numpy as np
import pytest

from incidentflow.operators import profile
from incidentflow.plans import standins
from tests.conftest import SF001


def test_null_profile_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = profile.null_profile(df, "t").collect()
    assert {r.column_name: (r.null_count, r.null_pct) for r in rows} == {"a": (0, 0.0), "b": (0, 0.0)}


def test_numeric_summary_matches_numpy(spark):
    acc = standins.accidents(spark, SF001)
    pdf = acc.toPandas()
    summ = {r.column_name: r for r in profile.numeric_summary(acc, "accidents").collect()}
    for col in ("hora_dia", "latitud_wgs84", "numero_expedient"):
        v = pdf[col].dropna().astype(float).to_numpy()
        r = summ[col]
        assert r["count"] == len(v)
        assert r.q25 == pytest.approx(np.percentile(v, 25), abs=1e-8)
        assert r.q50 == pytest.approx(np.percentile(v, 50), abs=1e-8)
        assert r.q75 == pytest.approx(np.percentile(v, 75), abs=1e-8)
        assert r.std == pytest.approx(v.std(ddof=1), abs=1e-8)


def test_numeric_profile_skips_all_null_and_non_numeric(spark):
    df = spark.createDataFrame([(None, "x", 1.0), (None, "y", 3.0)], "a int, b string, c double")
    rows = {r.column_name: r for r in profile.numeric_profile(df, "t").collect()}
    assert set(rows) == {"c"} and rows["c"].avg_val == 2.0 and rows["c"].min_val == 1.0


def test_low_card_values_lists_sorted_values(spark):
    df = spark.createDataFrame([(3,), (1,), (2,), (None,), (10,)], "a int")
    r = profile.low_card_values(df, "t").first()
    assert (r.n_distinct, r.distinct_values, r.has_null) == (4, "1, 2, 3, 10", True)


def test_distinct_with_null_and_table_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None)], "x int, y string")
    d = {r.column_name: r.n_distinct_with_null for r in profile.distinct_with_null(df, "t").collect()}
    assert d == {"x": 2, "y": 2}
    tp = {r.column_name: r for r in profile.table_profile({"t": df}).collect()}
    assert tp["x"].row_count == 3 and tp["x"].null_count == 1 and tp["y"].avg_val is None


def test_empty_tables_keep_their_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    for out in (profile.null_profile(df, "t"), profile.distinct_profile(df, "t"), profile.distinct_with_null(df, "t"), profile.low_card_values(df, "t"), profile.table_profile({"t": df})):
        assert sorted(r.column_name for r in out.collect()) == ["a", "b"]
    assert [r.n_distinct for r in profile.distinct_profile(df, "t").collect()] == [0, 0]
