import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from barograph.operators import cells as cells_of
from barograph.operators import learn
from barograph.operators.features import feature_plan
from barograph.operators.learn import boosted, forest, grid_search
from barograph.operators.presets import Preset
from barograph.operators.split import with_fold

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, 4000), rng.integers(-3, 4, 4000)
    label = 3 * a - b ** 2 + rng.normal(size=4000) * 4
    rows = [(k, None if k % 9 == 0 else float(x), float(y), float(t)) for k, (x, y, t) in enumerate(zip(a, b, label))]
    return with_fold(spark.createDataFrame(rows, "k int, a double, b double, label double"), ["k"], 2).repartition(5).cache()


def rmse(model, rows):
    return RegressionEvaluator(labelCol="label").evaluate(model.transform(rows))


def separate(data, estimator):
    plan = feature_plan(FEATURES)
    return np.mean([rmse(Pipeline(stages=[*plan.stages, estimator]).fit(data.where(F.col("fold") != k)), data.where(F.col("fold") == k))
                    for k in (0, 1)])


def fitted_rows(monkeypatch):
    """Counts of the rows that estimators of trees were given."""
    seen = []
    for kind in (type(boosted()), type(forest())):
        def fit(self, df, original=kind._fit):
            seen.append(df.count())
            return original(self, df)
        monkeypatch.setattr(kind, "_fit", fit)
    return seen


@pytest.mark.parametrize("family, grid, fixed", [
    ("gbt", {"maxIter": [2, 4], "maxDepth": [2, 3]}, {}),
    ("rf", {"numTrees": [1, 3], "maxDepth": [2, 4]}, {"bootstrap": False, "featureSubsetStrategy": "all"})])
def test_search_on_cells_equals_separate_fits_on_rows(data, monkeypatch, family, grid, fixed):
    wanted = [separate(data, learn.FAMILIES[family](**fixed, **{name: v for name, v in zip(grid, point)}))
              for point in [(x, y) for x in grid[list(grid)[0]] for y in grid["maxDepth"]]]
    seen = fitted_rows(monkeypatch)
    search = grid_search(data, feature_plan(FEATURES), Preset(family, grid, folds=2, fixed=fixed), "fold")
    found = {tuple(point.values()): score for point, score in zip(search.grid, search.scores)}
    assert [found[x, y] for x in grid[list(grid)[0]] for y in grid["maxDepth"]] == pytest.approx(wanted, rel=1e-9)
    assert seen and max(seen) <= 2 * 13 * 7  # no fit was given more rows than there are cells
    whole = Pipeline(stages=[*feature_plan(FEATURES).stages, learn.FAMILIES[family](**fixed, **search.grid[search.scores.index(search.best_score)])]).fit(data)
    assert rmse(search.model, data) == pytest.approx(rmse(whole, data), rel=1e-9)


def test_bootstrap_is_of_rows(spark, data):
    rows = data.withColumn("cell", (F.col("k") % 10).cast("bigint"))
    draws = {r["cell"]: r for r in cells_of.bootstrap_draws(rows, 10, 40, 1.0, 3).collect()}
    weights = np.array([draws[c]["weights"] for c in range(10)])
    means = np.array([draws[c]["means"] for c in range(10)])
    real = {r["cell"]: r for r in rows.groupBy("cell").agg(F.avg("label").alias("m"), F.stddev_pop("label").alias("s")).collect()}
    assert weights == pytest.approx(np.round(weights)) and abs(weights.mean() - 400) < 5
    assert 0.7 < weights.std() / 20 < 1.3  # a sum of 400 Poisson draws of rate 1
    for cell in range(10):
        assert abs(means[cell].mean() - real[cell]["m"]) < 4 * real[cell]["s"] / 20 / np.sqrt(40)
        assert 0.6 < means[cell].std() / (real[cell]["s"] / 20) < 1.5
    half = np.array([r["weights"] for r in cells_of.bootstrap_draws(rows, 10, 40, 0.5, 3).collect()])
    assert abs(half.mean() - 200) < 4


def test_sampled_forests_on_cells(data, monkeypatch, tmp_path):
    wanted = {n: separate(data, forest(numTrees=n, maxDepth=4)) for n in (4, 12)}
    seen = fitted_rows(monkeypatch)
    search = grid_search(data, feature_plan(FEATURES), Preset("rf", {"numTrees": [4, 12], "maxDepth": [4]}, folds=2), "fold")
    assert max(seen) <= 2 * 13 * 7 and len(seen) >= 2 * 16 + 4  # every point has trees of its own
    for point, score in zip(search.grid, search.scores):
        assert score == pytest.approx(wanted[point["numTrees"]], rel=0.1)
    best = search.best
    assert best.getNumTrees == search.grid[search.scores.index(search.best_score)]["numTrees"] and best.getMaxDepth() == 4
    assert abs(sum(best.featureImportances.toArray()) - 1) < 1e-9
    assert len({tree.toDebugString for tree in best.trees}) > 1
    search.model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert rmse(loaded, data) == pytest.approx(rmse(search.model, data), rel=1e-12)
    row = data.where("a IS NOT NULL").limit(1)
    features = search.model.transform(row).first()
    assert features["prediction"] == pytest.approx(np.mean([t.predict(features["features"]) for t in best.trees]))


def test_many_cells_bounds_on_rows_and_samples_are_fitted_on_rows(data):
    assert cells_of.has_few_cells(data, FEATURES) and not cells_of.has_few_cells(data, ["label"])
    assert not cells_of.has_few_cells(data, FEATURES, most=50)
    assert cells_of.weighs_rows(boosted(), [{}]) and cells_of.weighs_rows(forest(), [{}])
    assert not cells_of.weighs_rows(boosted(subsamplingRate=0.8), [{}])
    assert not cells_of.weighs_rows(forest(minInstancesPerNode=2), [{}])


def test_cells_of_missing_labels_have_none(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, None), (None, 3.0), (None, 5.0)], "a double, label double")
    found = {r["a"]: (r["label"], r["weight"]) for r in cells_of.feature_cells(rows, ["a"]).collect()}
    assert found == {1.0: (None, 2.0), None: (4.0, 2.0)}


def test_single_split_of_boosted_trees_on_cells(data, monkeypatch):
    split = with_fold(data.drop("fold"), ["k"], 100).cache()
    train, held = split.where("fold < 80"), split.where("fold >= 80")
    wanted = [rmse(Pipeline(stages=[*feature_plan(FEATURES).stages, boosted(maxIter=5, maxDepth=d)]).fit(train), held) for d in (2, 3)]
    seen = fitted_rows(monkeypatch)
    preset = Preset("gbt", {"maxIter": [5], "maxDepth": [2, 3]}, train_ratio=0.8)
    search = grid_search(split, feature_plan(FEATURES), preset, "fold")
    assert search.scores == pytest.approx(wanted, rel=1e-9) and len(seen) == 3 and max(seen) <= 2 * 13 * 7


@pytest.mark.parametrize("estimator", [lambda: boosted(maxIter=2, stepSize=0.1, maxDepth=1, maxBins=64),
                                       lambda: forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=1, maxBins=64)])
def test_stumps_of_prices_are_fitted_on_one_row_a_quantity(spark, monkeypatch, estimator):
    from workload import models
    rows = spark.range(6000).selectExpr("double(id % 50 + 1) AS l_quantity", "double(0) AS nothing",
                                        "(id % 50) * (1 + id % 7) / 3.0 AS label").repartition(3).cache()
    plan = feature_plan(["l_quantity", "nothing"], impute=(), handle_invalid="error")
    whole = Pipeline(stages=[*plan.stages, estimator()]).fit(rows)
    seen = fitted_rows(monkeypatch)
    _, model = models._fit_prices(rows, estimator())
    assert seen == [50]
    first, second = (m.transform(rows).groupBy("l_quantity").agg(F.max("prediction").alias("p")).orderBy("l_quantity").collect()
                     for m in (whole, model))
    assert [r["p"] for r in first] == pytest.approx([r["p"] for r in second], rel=1e-9)


def counted(data):
    """The rows of ``data`` and a count of how many of them were read, all passes together."""
    read = data.sparkSession.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return data.mapInArrow(passed, data.schema), read


def test_search_on_cells_reads_the_rows_twice_and_keeps_none(data):
    split = with_fold(data.drop("fold"), ["k"], 100)
    preset = Preset("gbt", {"maxIter": [5], "maxDepth": [2, 3]}, train_ratio=0.8)
    wanted = grid_search(split, feature_plan(FEATURES), preset, "fold").scores
    rows, read = counted(split)
    search = grid_search(rows, feature_plan(FEATURES), preset, "fold", keep=True)
    assert read.value == 2 * 4000  # whether there are few cells, and the cells; medians, fits and scores need no row
    assert search.scores == pytest.approx(wanted, rel=1e-12)


def test_rows_of_many_cells_are_kept_for_the_fits_and_released(data, monkeypatch):
    split = with_fold(data.drop("fold"), ["k"], 100)
    preset = Preset("gbt", {"maxIter": [2], "maxDepth": [2, 3]}, train_ratio=0.8)
    wanted = grid_search(split, feature_plan(FEATURES), preset, "fold").scores
    monkeypatch.setattr(learn, "has_few_cells", lambda *_: False)
    rows, read = counted(split)
    search = grid_search(rows, feature_plan(FEATURES), preset, "fold", keep=True)
    assert read.value == 4000 and search.scores == pytest.approx(wanted, rel=1e-9)
    assert not rows.hint("rebalance").storageLevel.useMemory


def test_medians_of_cells_are_exact(spark):
    nan = float("nan")
    few = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, None), (3.0, nan), (None, nan), (nan, None)], "a double, b double")
    cells = cells_of.feature_cells(few.withColumn("label", F.lit(1.0)), FEATURES)
    assert cells_of.cell_medians(cells, FEATURES) == {"a": 1.0, "b": None}


def test_gaps_are_filled_with_the_exact_median(spark):
    # One row more of 0 than of 1, in one partition: Spark's sketch gives 1.
    rows = spark.range(0, 200001, 1, 1).selectExpr(
        "double(id % 2) AS a", "double(id % 3) AS b", "double(id % 5) AS label", "int(id % 4) AS fold")
    assert rows.approxQuantile("a", [0.5], 1e-3) == [1.0]
    preset = Preset("gbt", {"maxIter": [1], "maxDepth": [1]}, folds=4)
    search = grid_search(rows, feature_plan(FEATURES), preset, "fold")
    assert search.model.stages[0].surrogateDF.first().asDict() == {"a": 0.0, "b": 1.0}
