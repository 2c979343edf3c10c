import pytest
from pyspark.sql import functions as F

from barograph.operators import presets
from barograph.operators.compare import best_model, compare_models, pairwise_deltas, top_features
from barograph.operators.derive import CANDIDATES_FOREST, CATEGORIES
from barograph.operators.presets import Preset
from barograph.operators.split import hash_split
from barograph.plans.cleaning import (
    clean_observations, run_cleaning, run_split, run_value_quality_cleaning, run_value_quality_etl,
    split_path, write_unpartitioned_split,
)
from barograph.plans.modeling import (
    run_baseline, run_comparison, run_encoded_training, run_evaluation, run_training,
)
from barograph.sources.models import load_model
from barograph.sources.tables import read_result, read_table
from workload.cleaning import packed

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Raw files, cleaned and split once for all jobs."""
    folder = str(tmp_path_factory.mktemp("jobs"))
    raw = packed(spark, SMOKE).drop("event_id").repartition(3)
    raw.write.csv(f"{folder}/raw", header=True, emptyValue="", nullValue="")
    report = run_cleaning(spark, f"{folder}/raw", f"{folder}/clean")
    counts = run_split(spark, f"{folder}/clean", f"{folder}/split")
    return folder, report, counts


@pytest.fixture
def small_presets(monkeypatch):
    monkeypatch.setitem(presets.PRESETS, "rf-small", Preset(
        "rf", {"numTrees": [3], "maxDepth": [3, 5], "minInstancesPerNode": [1]}, folds=2))
    monkeypatch.setitem(presets.PRESETS, "gbt-small", Preset(
        "gbt", {"maxIter": [3], "maxDepth": [2], "stepSize": [0.1]}, folds=2))


def test_cleaning_report_equals_the_written_table(spark, base):
    folder, report, _ = base
    assert (report.rows_in, report.rows_kept) == (1000, 736)
    assert report.rows_removed == sum(report.rejected.values()) == 264
    assert report.retention_pct == pytest.approx(73.6)
    table = read_table(spark, f"{folder}/clean")
    assert table.count() == 736
    expected = clean_observations(packed(spark, SMOKE))
    columns = sorted(expected.columns)
    assert table.select(columns).exceptAll(expected.select(columns)).count() == 0


def test_cleaning_takes_a_sample(spark, base, tmp_path):
    report = run_cleaning(spark, f"{base[0]}/raw", str(tmp_path / "c"), fraction=0.5)
    assert 350 < report.rows_in < 650


def test_split_is_complete_and_stable(spark, base):
    folder, report, counts = base
    parts = {p: read_table(spark, split_path(f"{folder}/split", p)) for p in ("train", "test")}
    assert {p: df.count() for p, df in parts.items()} == counts
    assert sum(counts.values()) == report.rows_kept
    assert {"year", "month"} <= set(parts["train"].columns)


def test_unpartitioned_split(spark, base, tmp_path):
    folder, _, counts = base
    clean = read_table(spark, f"{folder}/clean")
    paths = [str(tmp_path / p) for p in ("train", "test")]
    write_unpartitioned_split(clean, *paths, keys=["STATION", "timestamp"])
    assert [read_table(spark, p).count() for p in paths] == [counts["train"], counts["test"]]


def test_training_evaluation_and_comparison(spark, base, small_presets):
    folder, _, counts = base
    train, test = (split_path(f"{folder}/split", p) for p in ("train", "test"))
    row = run_training(spark, train, f"{folder}/rf", "rf-small", partitions=4)
    assert row["train_rows"] == counts["train"]
    run_training(spark, train, f"{folder}/gbt", "gbt-small")
    baseline = run_baseline(spark, train, test, f"{folder}/lr", fraction=1.0)
    assert baseline["train_rows"] < baseline["train_rows_read"] == counts["train"]
    imputed = run_baseline(spark, train, test, f"{folder}/lr15", fraction=1.0, imputed=True)
    assert imputed["train_rows"] > baseline["train_rows"]

    assert read_result(spark, f"{folder}/rf/cv_results").count() == 2
    importances = read_result(spark, f"{folder}/rf/feature_importances").collect()
    assert sum(r["importance"] for r in importances) == pytest.approx(1.0)
    assert [r["importance"] for r in importances] == sorted((r["importance"] for r in importances), reverse=True)

    found = run_evaluation(spark, f"{folder}/rf/model", test, f"{folder}/rf-eval")
    metrics = found["metrics"].first()
    assert metrics["test_rows"] == counts["test"]
    assert sum(r["count"] for r in found["by_range"].collect()) == counts["test"]
    assert found["best_and_worst"].count() == 20
    assert read_table(spark, f"{folder}/rf-eval/test_predictions").columns == ["label", "prediction"]
    direct = load_model(f"{folder}/rf/model").transform(
        read_table(spark, test).withColumn("label", F.col("temperature")))
    assert direct.agg(F.avg("prediction")).first()[0] == pytest.approx(
        read_table(spark, f"{folder}/rf-eval/error_analysis").agg(F.avg("prediction")).first()[0])

    tables = run_comparison(
        spark, {"Linear": f"{folder}/lr", "RF": f"{folder}/rf", "GBT": f"{folder}/gbt",
                "Absent": f"{folder}/none"}, {"RF": f"{folder}/rf-eval"})
    compared = {r["model"]: r for r in tables["comparison"].collect()}
    assert set(compared) == {"Linear", "RF", "GBT"}
    assert compared["RF"]["test_rmse"] == pytest.approx(metrics["test_rmse"])
    assert compared["Linear"]["test_rmse"] == pytest.approx(baseline["test_rmse"])
    assert compared["GBT"]["test_rmse"] is None
    best = best_model(tables["comparison"], "Linear").first()
    assert best["test_rmse"] == min(compared["RF"]["test_rmse"], compared["Linear"]["test_rmse"])
    assert {r["model"] for r in tables["top_features"].collect()} == {"RF", "GBT"}


def test_value_quality_generation(spark, tmp_path, small_presets):
    folder = str(tmp_path)
    rows = [
        (f"S{i % 5}", f"2024-0{1 + i % 3}-{1 + i % 28:02d}T{i % 24:02d}:00:00",
         "M" if i % 11 == 0 else f"{i % 30}.5,1", f"{i % 20}.0,1", "" if i % 4 == 0 else "1013.2,1",
         f"{i}", "FM-15" if i % 3 else "FM-12")
        for i in range(600)
    ]
    spark.createDataFrame(
        rows, "STATION string, DATE string, TMP string, DEW string, SLP string, ELEVATION string, REPORT_TYPE string"
    ).write.csv(f"{folder}/raw", header=True)
    run_value_quality_etl(spark, f"{folder}/raw", f"{folder}/table")
    table = read_table(spark, f"{folder}/table")
    assert {"label", "DEW_num", "SLP_num", "RH_num", "ts", "year", "month"} <= set(table.columns)
    assert "VIS_num" not in table.columns
    medians = run_value_quality_cleaning(spark, f"{folder}/table", f"{folder}/clean", files=4)
    assert medians["SLP_num"] == 1013.2
    cleaned = read_table(spark, f"{folder}/clean")
    assert cleaned.where("SLP_num is null").count() == 0
    assert cleaned.count() == sum(r[2] != "M" for r in rows)
    again = run_value_quality_cleaning(
        spark, f"{folder}/table", f"{folder}/clean2", month_by_month=True, medians=medians)
    assert again == medians and read_table(spark, f"{folder}/clean2").count() == cleaned.count()

    row = run_encoded_training(
        spark, f"{folder}/clean", f"{folder}/rf", "rf-small", CANDIDATES_FOREST, CATEGORIES)
    assert row["rmse"] > 0 and row["baseline_rmse"] > 0
    features = [r["column"] for r in read_result(spark, f"{folder}/rf/feature_list").orderBy("index").collect()]
    assert "REPORT_TYPE_oh" in features and "RH_num_imp" not in features
    run_encoded_training(spark, f"{folder}/clean", f"{folder}/lr", None, CANDIDATES_FOREST, scale=True)
    assert read_result(spark, f"{folder}/lr/metrics").first()["strategy"] == "linear"


def test_comparison_tables(spark):
    training = spark.createDataFrame(
        [("base", 10, 6.0), ("rf", 10, 4.0), ("gbt", 10, 5.0)], "model string, train_rows long, train_rmse double")
    tests = spark.createDataFrame(
        [("base", 6.5), ("rf", 4.5)], "model string, test_rmse double")
    table = compare_models(training, tests)
    best = best_model(table, "base").first()
    assert (best["model"], best["baseline_rmse"]) == ("rf", 6.5)
    assert best["improvement_pct"] == pytest.approx(100 * 2.0 / 6.5)
    delta = pairwise_deltas(table, [("gbt", "rf")], "train_rmse").first()
    assert (delta["difference"], delta["change_pct"]) == (1.0, 20.0)


def test_top_features_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("m", name, 0.5) for name in "gfedcba"] + [("n", "z", 1.0)], "model string, feature string, importance double")
    found = [r["feature"] for r in top_features(df).where("model = 'm'").orderBy("rank").collect()]
    assert found == list("abcde")


def test_hash_split_keeps_copies_together(spark):
    df = spark.createDataFrame([("A", 1)] * 50, "s string, t int")
    assert hash_split(df, ["s", "t"]).select("split").distinct().count() == 1
