import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from barograph.operators.features import feature_plan
from barograph.operators.learn import boosted, cv_table, forest, grid_search
from barograph.operators.nested import groups, prefix_scores
from barograph.operators.presets import Preset
from barograph.operators.split import with_fold


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 3))
    y = 2 * x[:, 0] - x[:, 1] ** 2 + rng.normal(size=900) * 0.2
    rows = [(k, float(a), None if k % 11 == 0 else float(b), float(c), float(t)) for k, ((a, b, c), t) in enumerate(zip(x, y))]
    return with_fold(spark.createDataFrame(rows, "k int, a double, b double, c double, label double"), ["k"], 2).repartition(3).cache()


def rmse(model, rows):
    return RegressionEvaluator(labelCol="label").evaluate(model.transform(rows))


def test_groups_hold_points_that_differ_in_size():
    grid = [{"numTrees": n, "maxDepth": d} for d in (2, 3) for n in (5, 1, 9)]
    assert groups(grid, "numTrees") == [{5: 0, 1: 1, 9: 2}, {5: 3, 1: 4, 9: 5}]


def test_prefixes_of_boosted_trees_are_the_shorter_runs(data):
    rows = Pipeline(stages=feature_plan(["a", "b", "c"]).stages).fit(data).transform(data)
    for rate in (1.0, 0.7):
        fit = lambda n: boosted(maxIter=n, maxDepth=3, subsamplingRate=rate).fit(rows)  # noqa: E731,B023
        assert prefix_scores(fit(6), rows, [1, 3, 6]) == pytest.approx([rmse(fit(n), rows) for n in (1, 3, 6)], rel=1e-9)


def test_prefixes_of_an_unsampled_forest_are_separate_fits(data):
    rows = Pipeline(stages=feature_plan(["a", "b", "c"]).stages).fit(data).transform(data)
    fit = lambda n: forest(numTrees=n, maxDepth=4, bootstrap=False, featureSubsetStrategy="all").fit(rows)
    assert prefix_scores(fit(4), rows, [1, 2, 4]) == pytest.approx([rmse(fit(n), rows) for n in (1, 2, 4)], rel=1e-9)


def test_whole_sampled_forest_has_its_own_score(data):
    rows = Pipeline(stages=feature_plan(["a", "b", "c"]).stages).fit(data).transform(data)
    model = forest(numTrees=5, maxDepth=4).fit(rows)
    first, whole = prefix_scores(model, rows, [2, 5])
    assert whole == pytest.approx(rmse(model, rows), rel=1e-9) and first != whole


def test_search_over_sizes_equals_separate_fits(data, monkeypatch):
    plan = feature_plan(["a", "b", "c"])
    preset = Preset("gbt", {"maxIter": [2, 5], "maxDepth": [2, 3], "stepSize": [0.1]}, folds=2)
    fits = []
    original = type(boosted())._fit
    monkeypatch.setattr(type(boosted()), "_fit", lambda self, df: fits.append(self.getMaxIter()) or original(self, df))
    search = grid_search(data, plan, preset, "fold")
    assert sorted(fits[:-1]) == [5] * 4 and len(fits) == 5  # two folds, two depths, and the best on all rows
    for row in cv_table(data, search).collect():
        scores = []
        for k in (0, 1):
            train, held = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
            model = Pipeline(stages=[*plan.stages, boosted(
                maxIter=row["maxIter"], maxDepth=row["maxDepth"], stepSize=row["stepSize"])]).fit(train)
            scores.append(rmse(model, held))
        assert row["cv_rmse"] == pytest.approx(sum(scores) / 2, rel=1e-9)
    assert search.best.getMaxIter() in (2, 5) and search.best_score == min(search.scores)
    assert data.storageLevel.useMemory and not [x for x in fits if x not in (2, 5)]


def test_single_split_over_sizes(data):
    split = with_fold(data.drop("fold"), ["k"], 100)
    plan = feature_plan(["a", "c"], impute=())
    preset = Preset("rf", {"numTrees": [1, 3], "maxDepth": [3], "minInstancesPerNode": [1]}, train_ratio=0.8,
                    fixed={"bootstrap": False, "featureSubsetStrategy": "all"})
    search = grid_search(split, plan, preset, "fold")
    train, held = split.where("fold < 80"), split.where("fold >= 80")
    one = Pipeline(stages=[*plan.stages, forest(numTrees=1, maxDepth=3, bootstrap=False, featureSubsetStrategy="all")]).fit(train)
    assert search.scores == pytest.approx([rmse(one, held)] * 2, rel=1e-9)


@pytest.mark.parametrize("share_trees", [False, True])
def test_forests_that_differ_in_depth_are_the_deepest_cut_off(data, monkeypatch, share_trees):
    plan = feature_plan(["a", "b", "c"])
    preset = Preset("rf", {"numTrees": [3, 6], "maxDepth": [2, 4, 7], "minInstancesPerNode": [1]}, folds=2)
    fits = []
    original = type(forest())._fit
    monkeypatch.setattr(type(forest()), "_fit", lambda self, df: fits.append((self.getNumTrees(), self.getMaxDepth())) or original(self, df))
    search = grid_search(data, plan, preset, "fold", share_trees=share_trees)
    assert sorted(fits[:-1]) == ([(6, 7)] * 2 if share_trees else [(3, 7)] * 2 + [(6, 7)] * 2)
    for point, score in zip(search.grid, search.scores):
        if share_trees and point["numTrees"] == 3:
            continue  # the first trees of the larger forest, another draw
        scores = []
        for k in (0, 1):
            train, held = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
            scores.append(rmse(Pipeline(stages=[*plan.stages, forest(numTrees=point["numTrees"], maxDepth=point["maxDepth"])]).fit(train), held))
        assert score == pytest.approx(sum(scores) / 2, rel=1e-9)
