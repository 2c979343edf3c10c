import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from barograph.operators.features import feature_plan
from barograph.operators.learn import grid_search, linear
from barograph.operators.moments import (
    Moments, fit_line, linear_moments, moment_table, near_values, penalty_scores,
)
from barograph.operators.presets import Preset
from barograph.operators.split import with_fold

NAMES = ["a", "b", "far"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 3)) * [1.0, 3.0, 10.0] + [0.0, 5.0, 1_013.0]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + 0.03 * (x[:, 2] - 1_013) + rng.normal(size=1200)
    rows = [(k, float(a), None if k % 7 == 0 else float("nan") if k % 13 == 0 else float(b), float(c),
             None if k == 5 else float(t)) for k, ((a, b, c), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "k int, a double, b double, far double, label double")
    return with_fold(df, ["k"], 3).repartition(4).cache()


def test_parts_add_up_to_numpy(data):
    found = linear_moments(data, NAMES, by="fold", impute=("b",))
    pdf = data.where("label IS NOT NULL").toPandas()
    for parts in ([0], [0, 2], [0, 1, 2]):
        rows = pdf[pdf.fold.isin(parts)]
        medians = found.medians(parts)
        present = sorted(rows.b.dropna())
        assert medians == {"b": present[(len(present) - 1) // 2]}
        filled = rows[[*NAMES, "label"]].fillna(medians).to_numpy()
        total = found.total(parts, medians)
        assert total.rows == len(rows) and np.allclose(total.mean, filled.mean(0), rtol=1e-12)
        assert np.allclose(total.scatter, np.cov(filled.T, bias=True) * len(rows), rtol=1e-7, atol=1e-7)


def test_lines_equal_sparks_regression(data):
    rows = data.where("label IS NOT NULL AND b IS NOT NULL AND NOT isnan(b)")
    total = linear_moments(rows, NAMES).total([None])
    stages = feature_plan(NAMES, impute=(), handle_invalid="error").stages
    for penalty in (0.0, 0.1, 2.0):
        line = fit_line(total, penalty)
        model = Pipeline(stages=[*stages, linear(reg_param=penalty)]).fit(rows)
        scored = model.transform(rows)
        assert np.allclose(line.coefficients, model.stages[-1].coefficients.toArray(), rtol=1e-5)
        assert np.sqrt(line.squared_error(total)) == pytest.approx(RegressionEvaluator(labelCol="label").evaluate(scored), rel=1e-7)
        gap = scored.select(F.max(F.abs(F.col("prediction") - line.prediction(NAMES)))).first()[0]
        assert gap < 1e-4


def test_columns_far_from_zero_keep_their_digits(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 2)) * [1.0, 0.01] + [0.0, 101_325.0]
    y = x[:, 0] + 30 * (x[:, 1] - 101_325) + rng.normal(size=500) * 0.01
    rows = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, far double, label double")
    line = fit_line(linear_moments(rows, ["a", "far"]).total([None]))
    centred = x - x.mean(0)
    assert np.allclose(line.coefficients, np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0], rtol=1e-7)


def test_constant_and_dependent_columns(spark):
    rows = spark.createDataFrame([(float(k), 3.0, 2.0 * k, 5.0 * k + 1) for k in range(50)], "a double, c double, d double, label double")
    line = fit_line(linear_moments(rows, ["a", "c", "d"]).total([None]))
    scored = rows.select(F.max(F.abs(F.col("label") - line.prediction(["a", "c", "d"]))))
    assert line.coefficients[1] == 0 and scored.first()[0] < 1e-8


def test_groups_without_rows_and_columns_without_values(data):
    found = linear_moments(data, NAMES, by="fold")
    assert set(found.parts) == {0, 1, 2}
    assert found.total([0, 7]).rows == found.parts[0].rows
    with pytest.raises(ValueError):
        found.total([7])
    empty = linear_moments(data.withColumn("b", F.lit(None).cast("double")), NAMES, by="fold", impute=("b",))
    assert empty.medians([0, 1]) == {"b": None}
    with pytest.raises(ValueError):
        empty.total([0], empty.medians([0]))


def test_merging_is_that_of_the_whole():
    rng = np.random.default_rng(1)
    of = lambda x: Moments(len(x), x.mean(0), np.cov(x.T, bias=True) * len(x))
    x = rng.normal(size=(40, 3)) + 1e6
    merged = of(x[:7]) + of(x[7:]) + Moments(0, np.zeros(3), np.zeros((3, 3)))
    assert np.allclose(merged.scatter, of(x).scatter, rtol=1e-9) and merged.rows == 40


def test_search_reads_its_rows_once(spark, data, tmp_path):
    path = str(tmp_path / "rows")
    data.write.parquet(path)
    rows = spark.read.parquet(path)
    plan = moment_table(rows, NAMES, by="fold", impute=("b",), shifts=near_values(rows, NAMES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_search_equals_separate_fits(data):
    preset = Preset("linear", {"regParam": [0.0, 0.3]}, folds=3)
    rows = data.where("label IS NOT NULL AND b IS NOT NULL AND NOT isnan(b)")
    plan = feature_plan(NAMES, impute=(), handle_invalid="error")
    search = grid_search(rows, plan, preset, "fold")
    for point, score in zip(search.grid, search.scores):
        errors = []
        for k in range(3):
            model = Pipeline(stages=[*plan.stages, linear(reg_param=point["regParam"])]).fit(rows.where(F.col("fold") != k))
            errors.append(RegressionEvaluator(labelCol="label").evaluate(model.transform(rows.where(F.col("fold") == k))))
        assert score == pytest.approx(sum(errors) / 3, rel=1e-7)
    assert search.best.getRegParam() == search.grid[search.scores.index(min(search.scores))]["regParam"]


def test_rolling_choice_of_parts(data):
    found = linear_moments(data, NAMES, by="fold", impute=("b",))
    scores = penalty_scores(found, [0.0, 1.0], [([0], [1]), ([0, 1], [2])])
    assert len(scores) == 2 and all(s > 0 for s in scores)
