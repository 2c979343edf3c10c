import bisect
import hashlib
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from barograph.operators.features import feature_plan
from barograph.operators.learn import boosted, grid_search
from barograph.operators.presets import Preset
from barograph.operators.sketches import (
    merge_sketches, profile_sketches, rank_error, read_profile, sketch_ranks, sketch_statistics, update_profile,
)
from barograph.operators.split import rolling_folds, with_period
from barograph.plans.modeling import run_training
from barograph.sources import tables
from barograph.sources.tables import exact_sample, read_result, read_table, write_sample


@pytest.fixture(scope="module")
def readings(spark):
    return spark.range(0, 60_000, 1, 6).select(
        "id", (F.col("id") % 3).cast("int").alias("year"), (F.col("id") % 5).cast("int").alias("month"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 10 == 1, float("nan")).otherwise(
            1e6 + (F.col("id") * 7919 % 60_013) / 10).alias("value"),
        (F.col("id") % 40).cast("string").alias("kind"), F.lit(None).cast("double").alias("nothing"))


def test_medians_of_any_choice_are_within_the_stated_rank_error(readings):
    items = 512
    table = profile_sketches(readings, ["value"], items=items)
    assert table.count() == 15
    for chosen in ("true", "year = 1", "month < 2", "year = 2 AND month = 3"):
        merged = merge_sketches(table.where(chosen), items=items)
        row = sketch_statistics(merged).first()
        rows = readings.where(chosen).toPandas()
        values = sorted(rows.value.dropna())
        assert (row["rows"], row["null_count"] + row["nan_count"]) == (len(rows), int(rows.value.isna().sum()))
        assert row["mean"] == pytest.approx(np.mean(values), rel=1e-12) and row["stddev"] == pytest.approx(np.std(values, ddof=1), rel=1e-9)
        assert (row["min"], row["max"]) == (values[0], values[-1])
        for name, share in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)):
            rank = bisect.bisect_right(values, row[name]) / len(values)
            assert abs(rank - share) <= rank_error(items) + 1 / len(values)
        found = sketch_ranks(merged, F.lit(values[len(values) // 3])).first()["rank"]
        assert abs(found - 1 / 3) <= rank_error(items) + 1 / len(values)
        assert abs(row["distinct_values"] / len(set(map(str, values))) - 1) < 0.1


def test_columns_without_numbers_and_without_values(readings):
    merged = sketch_statistics(merge_sketches(profile_sketches(readings, ["kind", "nothing"])))
    kind, nothing = merged.orderBy("column_id").collect()
    assert (kind["rows"], kind["distinct_values"], kind["mean"], kind["median"]) == (60_000, 40, None, None)
    assert (nothing["null_count"], nothing["stddev"], nothing["median"], nothing["distinct_values"]) == (60_000, None, None, 0)


def test_merging_merged_rows_changes_nothing(readings):
    table = profile_sketches(readings, ["value"])
    once = sketch_statistics(merge_sketches(table)).drop("q25", "q75").first()
    twice = sketch_statistics(merge_sketches(merge_sketches(table, "year"))).drop("q25", "q75").first()
    assert once["rows"] == twice["rows"] and once["stddev"] == pytest.approx(twice["stddev"], rel=1e-9)


def test_a_single_value_and_no_rows(spark, readings):
    one = sketch_statistics(merge_sketches(profile_sketches(readings.where("id = 3"), ["value"]))).first()
    assert one["median"] == one["min"] == one["max"] and one["stddev"] is None
    assert merge_sketches(profile_sketches(readings.where("false"), ["value"])).count() == 0


def test_update_replaces_only_its_periods(readings, tmp_path):
    path = str(tmp_path / "profile")
    update_profile(readings.where("id < 30000 OR month > 0"), path, ["value"])
    update_profile(readings.where("month = 0"), path, ["value"])
    assert merge_sketches(read_profile(readings.sparkSession, path)).first()["rows"] == 60_000


def wanted(rows, keys, size):
    return sorted(rows, key=lambda r: hashlib.md5("|".join(["sample", *map(str, keys(r))]).encode()).hexdigest())[:size]


@pytest.mark.parametrize("size", [0, 1, 17, 4_999, 19_999, 20_000, 30_000])
def test_samples_have_exactly_their_size(spark, size, monkeypatch):
    monkeypatch.setattr(tables, "SORTED_ROWS", 3)
    df = spark.range(0, 20_000, 1, 5)
    found = sorted(r.id for r in exact_sample(df, size, ["id"]).collect())
    assert found == sorted(wanted(range(20_000), lambda i: [i], size))
    assert found == sorted(r.id for r in exact_sample(df.repartition(3), size, ["id"]).collect())


def test_rows_with_equal_keys_are_told_apart_by_place(spark, monkeypatch):
    monkeypatch.setattr(tables, "SORTED_ROWS", 50)
    rng = random.Random(4)
    rows = [(0 if rng.random() < 0.4 else k, k) for k in range(6_000)]
    df = spark.createDataFrame(rows, "key int, n int").repartition(4)
    first = wanted([r[0] for r in rows], lambda v: [v], len(rows))
    start = first.index(0)
    hot = first.count(0)
    for size in (start, start + 1, start + hot // 2, start + hot, start + hot + 3):
        found = exact_sample(df, size, ["key"]).collect()
        assert len(found) == size == len({r.n for r in found})
        assert sorted(r.key for r in found) == sorted(first[:size])


def test_a_few_equal_keys_at_the_end_of_the_sample(spark):
    rows = [(k // 3, k) for k in range(3_000)]
    df = spark.createDataFrame(rows, "key int, n int").repartition(4)
    first = wanted([r[0] for r in rows], lambda v: [v], len(rows))
    for size in (100, 101, 102):
        assert sorted(r.key for r in exact_sample(df, size, ["key"]).collect()) == sorted(first[:size])


def test_written_sample(spark, tmp_path):
    write_sample(spark.range(50_000), str(tmp_path / "s"), 12_345, keys=["id"])
    assert read_table(spark, str(tmp_path / "s")).count() == 12_345


def test_rolling_folds_train_on_earlier_periods_only():
    assert rolling_folds([5, None, 3, 9, 5, 4], 2) == [([3, 4], [5]), ([3, 4, 5], [9])]
    with pytest.raises(ValueError):
        rolling_folds([1, 2], 2)


def test_periods_of_the_calendar(spark):
    times = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-07 12:00:00", "2024-01-08 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp"))
    week = [r.period for r in with_period(df, "t", "week").collect()]
    assert [w - week[1] if w is not None else None for w in week] == [-1, 0, 0, 1, None]
    assert [r.period for r in with_period(df, "t", "month").collect()][:3] == [2023 * 12 + 11, 2024 * 12, 2024 * 12]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    rows = [(k, k // 100, float(a), float(b), float(2 * a - b + rng.normal() * 0.3 + (k // 100) * 0.05))
            for k, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    return spark.createDataFrame(rows, "k int, period int, a double, b double, label double").repartition(3).cache()


def test_rolling_search_equals_separate_fits(series):
    plan = feature_plan(["a", "b"], impute=())
    preset = Preset("gbt", {"maxIter": [2, 4], "maxDepth": [2]}, folds=3)
    search = grid_search(series, plan, preset, "period", rolling=True)
    for point, score in zip(search.grid, search.scores):
        errors = []
        for held in (3, 4, 5):
            model = Pipeline(stages=[*plan.stages, boosted(**point)]).fit(series.where(F.col("period") < held))
            errors.append(RegressionEvaluator(labelCol="label").evaluate(model.transform(series.where(F.col("period") == held))))
        assert score == pytest.approx(sum(errors) / 3, rel=1e-9)
    with pytest.raises(ValueError):
        grid_search(series, plan, preset, None, rolling=True)


def test_training_job_with_rolling_folds(spark, series, tmp_path):
    rows = series.select("a", "b", F.col("label").alias("target"), "k",
                         F.timestamp_seconds(F.lit(1_704_067_200) + F.col("period") * 7 * 86_400).alias("timestamp"))
    rows.write.parquet(str(tmp_path / "train"))
    run_training(spark, str(tmp_path / "train"), str(tmp_path / "run"), Preset("linear", {"regParam": [0.0, 1.0]}, folds=2),
                 ["a", "b"], target="target", fold_keys=("k",), rolling=("timestamp", "week"), prediction_rows=100)
    scores = {r["regParam"]: r["cv_rmse"] for r in read_result(spark, str(tmp_path / "run/cv_results")).collect()}
    assert 0 < scores[0.0] < scores[1.0] and read_table(spark, str(tmp_path / "run/sample_predictions")).count() == 100
