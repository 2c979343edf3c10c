import math
import random
import statistics

import pytest
from pyspark.ml.feature import Imputer

from barograph.operators.aggregate import errors_by_range
from barograph.operators.derive import clean_numbers
from barograph.operators.features import split_empty_columns, with_imputed
from barograph.operators.profile import null_report, profile, summary_stats, typed_null_profile
from barograph.operators.quality import (
    apply_median_fill, fit_median_fill, quality_filter, quality_report, standard_rules,
    tag_rejections,
)
from barograph.operators.quantile import exact_medians

SCHEMA = "id int, temperature double, dew_point double, sea_level_pressure double"
ROWS = [
    (0, None, None, None), (1, -90.1, None, None), (2, 60.1, None, None),
    (3, -90.0, None, None), (4, 60.0, 60.0, None), (5, 10.0, 10.1, None),
    (6, 10.0, None, 949.9), (7, 10.0, None, 950.0), (8, 10.0, None, 1050.0),
    (9, 10.0, 5.0, 1050.1),
]


def test_rules_at_their_limits(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(r["id"] for r in quality_filter(df).collect()) == [3, 4, 7, 8]
    tags = {r["id"]: r["rejected_by"] for r in tag_rejections(df).collect()}
    assert tags[0] == "target_present" and tags[1] == tags[2] == "target_plausible"
    assert tags[5] == "dew_point_consistent" and tags[6] == tags[9] == "pressure_plausible"


def test_report_adds_up(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    report = quality_report(df).collect()
    assert [r["rule"] for r in report] == list(standard_rules())
    assert sum(r["rows_rejected"] for r in report) == report[0]["rows_in"] - report[0]["rows_kept"]
    assert report[0]["retention_pct"] == 40.0
    empty = quality_report(df.limit(0)).first()
    assert empty["rows_in"] == 0 and empty["retention_pct"] is None


def test_profile_counts_nan_only_in_floats(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "a"), (2, None, None), (3, 4.0, "c")], "k int, x double, s string")
    missing = {r["column"]: r["null_count"] for r in typed_null_profile(df).collect()}
    assert missing == {"k": 0, "x": 2, "s": 1}
    assert [r["column"] for r in null_report(df).collect()] == ["x", "s"]
    stats = {r["column"]: r for r in summary_stats(df).collect()}
    assert (stats["x"]["count"], stats["x"]["nan_count"], stats["x"]["mean"]) == (1, 1, 4.0)
    table = {r["column"]: r for r in profile(df).collect()}
    assert table["s"]["dtype"] == "string" and table["s"]["mean"] is None
    assert table["k"]["max"] == 3.0 and table["x"]["nan_count"] == 1


def test_nan_becomes_null(spark):
    df = clean_numbers(spark.createDataFrame([(1, float("nan"))], "k int, x double"), ["k", "x", "z"])
    assert df.first().asDict() == {"k": 1.0, "x": None}


def test_range_limits(spark):
    labels = [-0.1, 0.0, 9.9, 10.0, 19.9, 20.0, 29.9, 30.0]
    df = spark.createDataFrame([(x, x) for x in labels], "label double, prediction double")
    found = [(r["range_id"], r["temp_range"], r["count"]) for r in errors_by_range(df).collect()]
    assert found == [(0, "Below 0°C", 1), (1, "0-10°C", 2), (2, "10-20°C", 2),
                     (3, "20-30°C", 2), (4, "Above 30°C", 1)]


def lower_median(values):
    return statistics.median_low(values)


@pytest.mark.parametrize("limit", [200_000, 20, 1])
@pytest.mark.parametrize("kind", ["spread", "hot", "edges", "few", "single", "odd"])
def test_exact_medians(spark, kind, limit):
    rng = random.Random(7)
    values = {
        "spread": [rng.gauss(0, 1e6) for _ in range(5000)],
        "hot": [0.0] * 2400 + [rng.random() - 0.5 for _ in range(5000)],
        "edges": [-1.0] * 2500 + [rng.random() for _ in range(2)] + [2.0] * 2500,
        "few": [float(rng.randrange(7)) for _ in range(5000)],
        "single": [3.5] * 100,
        "odd": [rng.random() for _ in range(4999)],
    }[kind]
    rng.shuffle(values)
    rows = [(x, None if i % 3 == 0 else x, float("nan")) for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    found = exact_medians(df, ["a", "b", "c"], histogram_limit=limit)
    assert found == {
        "a": lower_median(values),
        "b": lower_median([x for i, x in enumerate(values) if i % 3]), "c": None}


def test_fill_is_fitted_once_and_applied_anywhere(spark):
    train = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "x double, y double")
    medians = fit_median_fill(train, ["x", "y"], relative_error=None)
    assert medians == {"x": 2.0, "y": 0.0}
    assert fit_median_fill(train, ["x", "y"], relative_error=0.0) == medians
    test = spark.createDataFrame([(None, 5.0)], "x double, y double")
    assert apply_median_fill(test, medians).first() == (2.0, 5.0)


def test_imputed_columns_equal_the_imputer(spark):
    df = spark.createDataFrame([(float(i) if i % 3 else None,) for i in range(101)], "x double")
    fitted = Imputer(strategy="median", relativeError=1e-9, inputCols=["x"], outputCols=["x_imputed"]).fit(df)
    ours = with_imputed(df, exact_medians(df, ["x"]))
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(
        map(tuple, fitted.transform(df).collect()), key=str)


def test_empty_columns_are_reported(spark):
    df = spark.createDataFrame([(1.0, None, math.nan)], "x double, y double, z double")
    assert split_empty_columns(df, ["x", "y", "z"]) == (["x"], ["y", "z"])
