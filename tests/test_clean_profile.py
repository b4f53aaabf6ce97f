"""Cleaning and profiling on a small credit file."""

from collections import Counter

import numpy as np
import pytest

from millrace.operators import clean, features, profile
from millrace.sources import read_csv

CREDIT = """b,30.83,0,u,g,w,v,1.25,t,t,1,f,g,00202,0,+
a,58.67,4.46,u,g,q,h,3.04,t,t,6,f,g,00043,560,+
a,?,0.5,u,g,q,h,1.5,t,f,0,f,g,00280,824,+
b,27.83,1.54,u,g,w,v,3.75,t,t,5,t,g,00100,3,-
?,20.17,5.625,u,g,w,v,1.71,t,f,0,f,s,?,0,-
b,32.08,4,?,g,m,v,2.5,t,f,0,t,g,00360,0,*
b,95.00,1.04,u,g,r,h,6.5,t,f,0,t,g,00164,31285,-
a,22.92,11.585,u,g,cc,v,0.04,t,f,0,f,g,00080,1349,+
"""
NAMES = [
    "gender", "age", "debt", "married", "customer", "education", "ethnicity", "years",
    "default", "employed", "score", "license", "citizen", "zip", "income", "status",
]


@pytest.fixture(scope="module")
def credit(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("credit") / "credit.csv"
    path.write_text(CREDIT)
    return clean.rename_all(read_csv(spark, str(path), infer=True), NAMES)


def test_inference_sees_sentinels_as_text(credit, spark, tmp_path):
    types = dict(credit.dtypes)
    assert types["age"] == "string" and types["debt"] == "double" and types["score"] == "int"
    path = tmp_path / "again.csv"
    path.write_text(CREDIT)
    typed = read_csv(spark, str(path), infer=True, null_value="?")
    assert dict(typed.dtypes)["_c1"] == "double"


def test_rename_needs_every_name(credit):
    with pytest.raises(ValueError):
        clean.rename_all(credit, NAMES[:-1])


def test_cleaning_chain(credit):
    hits = {r["column_name"]: r["hits"] for r in profile.value_counts_equal(credit, "?").collect()}
    assert {k: v for k, v in hits.items() if v} == {"gender": 1, "age": 1, "married": 1, "zip": 1}
    cleaned = clean.null_sentinels(credit, "?")
    nulls = {r["column_name"]: r["nulls"] for r in profile.null_counts(cleaned).collect()}
    assert nulls == hits
    assert profile.incomplete_fraction(cleaned).first()[0] == 3 / 8
    whole = clean.drop_incomplete(cleaned)
    typed = clean.cast_columns(whole, {"age": "double", "zip": "int"}, strict=True)
    assert [r["zip"] for r in typed.orderBy("age").collect()] == [80, 100, 202, 43, 164]
    mapped = clean.map_values(typed, "status", {"+": 1, "-": 0})
    assert sorted(r["status"] for r in mapped.collect()) == [0, 0, 1, 1, 1]
    unknown = clean.map_values(cleaned, "status", {"+": 1, "-": 0}).filter("status is null")
    assert unknown.count() == 1
    rows = clean.null_rows_all(cleaned).select("column_name", "row.income").collect()
    assert sorted((r[0], r[1]) for r in rows) == [("age", 824), ("gender", 0), ("married", 0), ("zip", 0)]
    assert clean.null_rows(cleaned, "age").count() == 1


def test_bad_text_is_null_or_an_error(spark):
    df = spark.createDataFrame([("7",), ("x",)], "t string")
    assert [r["t"] for r in clean.cast_columns(df, {"t": "int"}).collect()] == [7, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.cast_columns(df, {"t": "int"}, strict=True).collect()


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None)], "x double, y string")
    assert {r[0]: r[1] for r in profile.null_counts(df).collect()} == {"x": 2, "y": 1}
    assert clean.drop_incomplete(df).count() == 1
    assert clean.null_rows(df, "x").count() == 2
    kept = clean.drop_outliers(df, "x")
    assert kept.count() == 3
    assert clean.drop_outliers(df, "x", keep_null=False).count() == 1


def test_outliers_on_fences_stay(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 9.0, 17.5, 17.6, 4.9, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    q1, q3 = np.percentile(values, [25, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    report = profile.iqr_report(df, "x").first()
    assert (report["q1"], report["q3"]) == pytest.approx((q1, q3))
    assert (report["lower"], report["upper"]) == pytest.approx((low, high))
    assert report["outlier_fraction"] == np.mean([(v < low) or (v > high) for v in values])
    exact = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 1, 2, 2, 3.5, -1.5, 9]], "x double")
    box = profile.box_stats(exact, "x").first()
    assert box["n_outliers"] == 1 and box["whisker_high"] == 3.5 and box["whisker_low"] == -1.5


def test_approx_agrees_on_small_data(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)], "g string, x double")
    assert profile.iqr_fences(df, "x", approx=True).first()["q1"] == 25.0
    assert profile.group_stats(df, "g", "x", approx=True).first()["median"] == 50.0
    assert profile.box_stats(df, "x", "g", approx=True).first()["median"] == 50.0


def test_pair_bins_in_blocks_of_any_size(spark, monkeypatch):
    """Counts equal brute force, with all hues at hand and with a block given out for each hue."""
    rows = [("ab"[i % 2], float(i % 17), float(i % 5), 3.0) for i in range(500)] + [("a", None, 1.0, 3.0), (None, 2.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "h string, x double, y double, z double")
    dense = profile.pair_bins(df, ["x", "y", "z"], "h", 4)
    most = {"x": 16, "y": 4, "z": 3}
    low = {"x": 0, "y": 0, "z": 3}
    expected = Counter()
    for h, *values in rows:
        if None in values:
            continue
        at = {c: 0 if low[c] == most[c] else min(3, int((v - low[c]) / ((most[c] - low[c]) / 4))) for c, v in zip("xyz", values)}
        expected.update((h, a, b, at[a], at[b]) for i, a in enumerate("xyz") for b in "xyz"[i:])
    told = lambda out: {(r["h"], r["x_col"], r["y_col"], r["x_bin"], r["y_bin"]): r["n"] for r in out.collect()}
    assert told(dense) == dict(expected)
    monkeypatch.setattr(profile, "CELLS_HELD", 1)
    assert told(profile.pair_bins(df, ["x", "y", "z"], "h", 4)) == dict(expected)
    assert dense.filter("x_col = 'x' and y_col = 'x'").agg({"n": "sum"}).first()[0] == 501
    assert {r["x_bin"] for r in dense.filter("x_col = 'z'").collect()} == {0}


def test_union_by_name_keeps_copies(spark):
    white = spark.createDataFrame([("1", "6"), ("1", "6")], "acid string, quality string")
    red = spark.createDataFrame([("8", "2", "x")], "quality string, acid string, extra string")
    both = clean.union_all(clean.with_literal(white, "is_red", 0.0), clean.with_literal(red, "is_red", 1.0))
    labelled = clean.with_threshold_label(both, "quality", 7)
    assert labelled.columns == ["acid", "is_red", "extra", "label"]
    rows = sorted((r["acid"], r["is_red"], r["extra"], r["label"]) for r in labelled.fillna("-").collect())
    assert rows == [("1", 0.0, "-", False), ("1", 0.0, "-", False), ("2", 1.0, "x", True)]


def test_dummies(spark):
    df = spark.createDataFrame([(1, "x", "p"), (2, "y", None), (3, "x", "q")], "n long, a string, b string")
    out = features.dummies(df)
    assert out.columns == ["n", "a_x", "a_y", "b_p", "b_q"]
    assert [tuple(r) for r in out.orderBy("n").collect()] == [(1, 1, 0, 1, 0), (2, 0, 1, 0, 0), (3, 1, 0, 0, 1)]
    with pytest.raises(ValueError, match="more than 2"):
        features.category_levels(df, ["a", "b"], max_levels=2)


def test_reports(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "n int, a string")
    assert tuple(clean.shape(df).first()) == (3, 2)
    assert [r["type"] for r in clean.schema_report(df).collect()] == ["int", "string"]
    assert [tuple(r) for r in profile.value_counts(df, "a").collect()] == [("x", 2)]
    assert {r["a"] for r in profile.distinct_values(df, "a").collect()} == {"x", None}
    assert clean.columns_of(df, "numeric") == ["n"]
    assert clean.preview(df, 1, ["n"]).first()["n"] == 1
    x, y = clean.features_and_label(df, "a")
    assert (x.columns, y.columns) == (["n"], ["a"])


def test_names_with_dots(spark):
    rows = spark.createDataFrame([("x", 1.0, 2.0), ("x", 3.0, 1.0), ("y", 5.0, 0.0)], "`a.b` string, `c.d` double, e double")
    assert [tuple(r) for r in profile.value_counts(rows, "a.b").collect()] == [("x", 2), ("y", 1)]
    assert [tuple(r) for r in profile.count_by(rows, "a.b").collect()] == [("x", 2), ("y", 1)]
    assert sorted(tuple(r) for r in profile.group_stats(rows, "a.b", "c.d").collect()) == [("x", 2, 2, 3, 1), ("y", 5, 5, 5, 5)]
    boxes = profile.box_stats(rows, "c.d", by="a.b")
    assert sorted(r["a.b"] for r in boxes.collect()) == ["x", "y"]
    assert profile.pair_bins(rows, ["c.d", "e"], "a.b").columns[0] == "a.b"
