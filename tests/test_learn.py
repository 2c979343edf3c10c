import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from barograph.operators.aggregate import cv_summary, mean_baseline, regression_metrics, top_k
from barograph.operators.features import SharedPrepPipeline, feature_plan
from barograph.operators.learn import (
    baseline_linear, boosted, coefficient_table, cv_table, forest, grid_search, importance_table,
    linear, rows_table, training_row,
)
from barograph.operators.presets import PRESETS, Preset
from barograph.operators.split import with_fold
from barograph.sources.models import load_model, save_model

SMALL_RF = Preset("rf", {"numTrees": [3, 6], "maxDepth": [3], "minInstancesPerNode": [1]}, folds=2)
SMALL_GBT = Preset("gbt", {"maxIter": [2, 4], "maxDepth": [2], "stepSize": [0.1]}, train_ratio=0.8)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = 3 * x[:, 0] - x[:, 1] ** 2 + rng.normal(size=1500) * 0.1
    rows = [
        (i, float(a), None if i % 9 == 0 else float(b), float(c), "pqr"[i % 3], float(t))
        for i, ((a, b, c), t) in enumerate(zip(x, y))
    ]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, kind string, label double")
    return with_fold(df, ["k"], 2).repartition(4).cache()


def test_metrics_equal_the_evaluator(data):
    scored = data.withColumn("prediction", F.col("a") * 2.5 + 0.1)
    found = regression_metrics(scored).first()
    for name in ("rmse", "r2", "mae", "mse"):
        expected = RegressionEvaluator(labelCol="label", metricName=name).evaluate(scored)
        assert found[name] == pytest.approx(expected, rel=1e-12)
    assert found["rows"] == 1500


def test_mean_baseline_equals_the_direct_computation(data):
    row = mean_baseline(data, F.col("fold") == 0).first()
    pdf = data.select("label", "fold").toPandas()
    mean = pdf.label[pdf.fold == 0].mean()
    assert row["train_mean"] == pytest.approx(mean)
    assert row["baseline_rmse"] == pytest.approx(np.sqrt(((pdf.label[pdf.fold == 1] - mean) ** 2).mean()))


def test_baseline_linear_is_ridge_regression(data):
    plan = feature_plan(["a", "c"], impute=(), handle_invalid="error")
    model = Pipeline(stages=[*plan.stages, baseline_linear()]).fit(data)
    table = {r["term"]: r["coefficient"] for r in coefficient_table(data, model.stages[-1], plan.inputs).collect()}
    pdf = data.toPandas()
    x, y = pdf[["a", "c"]].to_numpy(), pdf["label"].to_numpy()
    cov = np.cov(x.T, ddof=0)
    cross = ((x - x.mean(0)) * (y - y.mean())[:, None]).mean(0)
    expected = np.linalg.solve(cov + np.diag(np.diag(cov)) * 0.1 / y.std(), cross)
    assert [table["a"], table["c"]] == pytest.approx(list(expected), rel=1e-8)
    assert table["intercept"] == pytest.approx(y.mean() - expected @ x.mean(0), rel=1e-6, abs=1e-9)


def test_stages_without_columns_are_left_out():
    assert len(feature_plan(["a"], impute=()).stages) == 1
    assert len(feature_plan(["a"]).stages) == 2
    plan = feature_plan(["a", "b"], ["kind"], impute=["b"], scale=True, suffix="_imp")
    assert plan.inputs == ["a", "b_imp", "kind_oh"] and len(plan.stages) == 5
    with pytest.raises(ValueError):
        feature_plan([])


def test_invalid_rows_by_mode(data):
    def count(mode):
        stages = feature_plan(["a", "b"], impute=(), handle_invalid=mode).stages
        return Pipeline(stages=stages).fit(data).transform(data).select(
            F.sum(vector_to_array("features")[0]), F.count("*")).first()[1]

    assert count("skip") == data.where("b is not null").count()
    assert count("keep") == 1500
    with pytest.raises(Exception):
        count("error")


def test_shared_preparation_gives_the_same_scores(data, monkeypatch):
    plan = feature_plan(["a", "b", "c"])
    rf = forest(numTrees=3)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [2, 4]).build()
    scores, fits = [], []
    original = Imputer._fit
    monkeypatch.setattr(Imputer, "_fit", lambda self, df: fits.append(1) or original(self, df))
    for kind in (Pipeline, SharedPrepPipeline):
        tuner = CrossValidator(
            estimator=kind(stages=[*plan.stages, rf]), estimatorParamMaps=grid, foldCol="fold",
            evaluator=RegressionEvaluator(labelCol="label"), numFolds=2, parallelism=2, seed=1)
        fits.append(0)
        scores.append(tuner.fit(data).avgMetrics)
    assert scores[0] == pytest.approx(scores[1], rel=1e-12)
    second = len(fits) - 1 - fits[::-1].index(0)
    assert (sum(fits[:second]), sum(fits[second:])) == (5, 3)


def test_cached_node_ids_do_not_change_a_forest(data):
    rows = Pipeline(stages=feature_plan(["a", "b", "c"]).stages).fit(data).transform(data)
    one = forest(numTrees=4, maxDepth=5).fit(rows)
    other = forest(numTrees=4, maxDepth=5, cacheNodeIds=True).fit(rows)
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]


def test_forest_search(spark, data, tmp_path):
    plan = feature_plan(["a", "b", "c"])
    search = grid_search(data, plan, SMALL_RF, "fold")
    table = cv_table(data, search)
    assert table.columns == ["numTrees", "maxDepth", "minInstancesPerNode", "cv_rmse"]
    assert table.count() == 2
    summary = cv_summary(table).first()
    assert summary["best_cv_rmse"] == min(search.scores) == search.best_score
    assert summary["worst_cv_rmse"] == max(search.scores)
    scored = search.model.transform(data)
    metrics = regression_metrics(scored).first()
    assert metrics["rmse"] < mean_baseline(data, F.col("fold") == 0).first()["baseline_rmse"]
    importances = importance_table(data, search.best, plan.inputs)
    assert importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert top_k(importances, "importance", "feature_index", 1).first()["feature"] == "a_imputed"
    row = training_row(search, "small", "rf", metrics["rows"], metrics)
    found = rows_table(spark, [row]).first()
    assert found["num_trees"] in (3, 6) and found["training_seconds"] > 0
    save_model(search.model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m")).transform(data)
    assert regression_metrics(again).first()["rmse"] == pytest.approx(metrics["rmse"])
    repeat = grid_search(data, feature_plan(["a", "b", "c"]), SMALL_RF, "fold")
    assert repeat.scores == pytest.approx(search.scores, rel=1e-12)


def test_boosted_single_split_search(data):
    search = grid_search(data, feature_plan(["a", "b", "c"]), SMALL_GBT)
    assert len(search.scores) == 2
    metrics = regression_metrics(search.model.transform(data)).first()
    row = training_row(search, "small", "gbt", metrics["rows"], metrics)
    assert row["max_iter"] in (2, 4) and row["num_trees"] == row["max_iter"]
    assert row["step_size"] == 0.1


def test_importances_name_encoded_slots(data):
    plan = feature_plan(["a"], ["kind"])
    rows = Pipeline(stages=plan.stages).fit(data).transform(data)
    model = boosted(maxIter=2, maxDepth=2).fit(rows)
    table = importance_table(model.transform(rows), model, plan.inputs).collect()
    assert len(table) == 5 and table[0]["feature"] == "a_imputed"
    assert all(r["feature"].startswith("kind_oh") for r in table[1:])


def test_unseen_category_has_its_own_slot(data):
    plan = feature_plan(["a"], ["kind"])
    model = Pipeline(stages=[*plan.stages, linear()]).fit(data.where("kind <> 'r'"))
    assert model.transform(data).where("prediction is null").count() == 0


def test_presets_cover_the_published_grids():
    sizes = {name: (int(np.prod([len(v) for v in p.grid.values()])), p.folds, p.parallelism)
             for name, p in PRESETS.items()}
    assert sizes == {
        "rf-test": (4, 2, 4), "rf-full": (18, 3, 4), "rf-simplified": (4, 2, 1),
        "rf-final": (8, 3, 2), "rf-optimized": (8, 3, 2), "rf7-cv-full": (8, 3, 4),
        "rf7-cv-fast": (4, 3, 4), "rf7-single": (1, 3, 4), "gbt-test": (4, 2, 4),
        "gbt-full": (27, 3, 4), "gbt-simplified": (4, 2, 1), "gbt7-cv-full": (8, 3, 4),
        "gbt7-cv-fast": (4, 3, 4), "gbt7-tvs-fast": (4, 3, 4)}


def test_single_split_by_column_is_reproducible(data):
    rows = with_fold(data.drop("fold"), ["k"], SMALL_GBT.fold_count)
    plan = feature_plan(["a", "b", "c"])
    scores = [grid_search(df, plan, SMALL_GBT, "fold", parallelism=2).scores for df in (rows, rows.repartition(3))]
    assert scores[0] == pytest.approx(scores[1], rel=0.05)
    train, held = rows.where("fold < 80"), rows.where("fold >= 80")
    model = Pipeline(stages=[*plan.stages, boosted(maxIter=2, maxDepth=2, stepSize=0.1)]).fit(train)
    assert scores[0][0] == pytest.approx(RegressionEvaluator(labelCol="label").evaluate(model.transform(held)), rel=0.02)


def test_prepared_rows_are_released_after_the_grid(spark, data):
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    grid_search(data, feature_plan(["a", "b", "c"]), SMALL_RF, "fold")
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before
