"""Estimators, grid search and the tables that describe fitted models."""

from __future__ import annotations

import time
from contextlib import nullcontext
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.operators.cells import cell_search, has_few_cells, weighs_rows
from barograph.operators.features import FeaturePlan, SharedPrepPipeline
from barograph.operators.moments import linear_moments, penalty_scores
from barograph.operators.nested import SIZE, idle_share, nested_scores, shares_depth
from barograph.operators.presets import Preset
from barograph.operators.split import BUCKETS, rolling_folds
from barograph.session import persisted

SEED = 42


def linear(max_iter: int | None = None, reg_param: float | None = None) -> LinearRegression:
    """Linear regression; Spark's defaults where nothing is given."""
    estimator = LinearRegression(featuresCol="features", labelCol="label")
    if max_iter is not None:
        estimator.setMaxIter(max_iter)
    if reg_param is not None:
        estimator.setRegParam(reg_param)
    return estimator


def baseline_linear() -> LinearRegression:
    """The baseline: 10 iterations, regularisation 0.1."""
    return linear(max_iter=10, reg_param=0.1)


def forest(**params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol="label", seed=SEED, **params)


def boosted(**params) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", seed=SEED, **params)


def ridge(**params) -> LinearRegression:
    """Linear regression for a grid over its own parameters."""
    return LinearRegression(featuresCol="features", labelCol="label", **params)


FAMILIES = {"rf": forest, "gbt": boosted, "linear": ridge}
MODEL_NAMES = {"rf": "RandomForest", "gbt": "GradientBoostedTrees", "linear": "LinearRegression"}


@dataclass(frozen=True)
class Search:
    """A finished grid search."""

    model: PipelineModel
    grid: list[dict[str, object]]
    scores: list[float]
    seconds: float
    inputs: list[str]

    @property
    def best_score(self) -> float:
        return min(self.scores)

    @property
    def best(self):
        """The fitted regression stage."""
        return self.model.stages[-1]


def grid_search(
    df: DataFrame, plan: FeaturePlan, preset: Preset,
    fold_column: str | None = None, parallelism: int | None = None, rolling: bool = False,
    share_trees: bool = False, keep: bool = False,
) -> Search:
    """Fit every grid point, refit the best on all rows of ``df``.

    With ``rolling``, ``fold_column`` holds the numbers of periods in time. Each
    of the last ``folds`` periods is predicted from those before it only, so no
    score rests on rows later than the ones it is for.

    ``fold_column`` holds reproducible fold numbers, or for a single split a
    number below 100 of which the lower ``train_ratio`` trains; without it Spark
    draws the folds. Grid points that differ in the number of trees only share
    one fit for each fold, see ``nested``, where the first trees are those of a
    separate fit: boosted trees, and forests without sampling. With
    ``share_trees`` sampled forests do so, too; their first trees are a forest
    of that size, but another draw. Forests that differ in depth only share the
    deepest fit, cut off, where this is the shallower fit itself. Unless ``parallelism`` is given, as many of
    these fits run at once as leave no core idle. Trees over few different
    choices of features are fitted on these instead of the rows, see ``cells``;
    the draws of a sampled forest are other ones there, too. Penalties of a linear model are
    scored from sufficient statistics of the folds, see ``moments``. The caller
    persists ``df``, or leaves that to ``keep``: rows are then spread over the
    cores and held only where fits go over rows, not where cells do.
    """
    estimator = FAMILIES[preset.family](**preset.fixed)
    builder = ParamGridBuilder()
    for name, values in preset.grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    param_maps = builder.build()
    common = dict(
        estimator=SharedPrepPipeline(stages=[*plan.stages, estimator]),
        estimatorParamMaps=param_maps,
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse"),
        parallelism=parallelism or preset.parallelism, seed=SEED)
    grid = [{param.name: value for param, value in point.items()} for point in param_maps]
    size = SIZE.get(preset.family) if share_trees or _same_prefix(preset) else None
    if rolling and (not fold_column or preset.train_ratio is not None):
        raise ValueError("rolling folds need a column of periods and a preset with folds")
    periods = _rolling(df, fold_column, preset.folds) if rolling else None
    if fold_column and preset.family == "linear" and set(preset.grid) == {"regParam"} and not preset.fixed and plan.numeric:
        started = time.monotonic()
        scores = _penalty_search(df, plan, preset, fold_column, periods)
        model = common["estimator"].fit(df, param_maps[scores.index(min(scores))])
        return Search(model, grid, scores, time.monotonic() - started, plan.inputs)
    if fold_column and plan.numeric and weighs_rows(estimator, param_maps) and has_few_cells(df, list(plan.numeric)):
        started = time.monotonic()
        part, folds = _parts(preset, fold_column, periods)
        at_once = parallelism or max(preset.parallelism, df.sparkSession.sparkContext.defaultParallelism)
        model, scores = cell_search(df, plan, estimator, param_maps, part, folds, size, at_once)
        return Search(model, grid, scores, time.monotonic() - started, plan.inputs)
    with persisted(df.hint("rebalance")) if keep else nullcontext(df) as df:
        cut = "maxDepth" in preset.grid and plan.numeric and shares_depth(estimator, param_maps, len(plan.inputs))
        if fold_column and (rolling or cut or size and len(preset.grid.get(size, ())) > 1):
            started = time.monotonic()
            at_once = parallelism or max(preset.parallelism, idle_share(df))
            scores = nested_scores(
                _folds(df, preset, fold_column, periods), plan.stages, estimator, param_maps, size, at_once, bool(cut))
            model = common["estimator"].fit(df, param_maps[scores.index(min(scores))])
            return Search(model, grid, scores, time.monotonic() - started, plan.inputs)
        if preset.train_ratio is not None and fold_column:
            started = time.monotonic()
            model, scores = _single_split(df, common, preset.train_ratio, fold_column)
            return Search(model, grid, scores, time.monotonic() - started, plan.inputs)
        if preset.train_ratio is not None:
            tuner = TrainValidationSplit(trainRatio=preset.train_ratio, **common)
        else:
            tuner = CrossValidator(numFolds=preset.folds, **common)
            if fold_column:
                tuner.setFoldCol(fold_column)
        started = time.monotonic()
        fitted = tuner.fit(df)
        seconds = time.monotonic() - started
        scores = fitted.avgMetrics if preset.train_ratio is None else fitted.validationMetrics
        return Search(fitted.bestModel, grid, [float(s) for s in scores], seconds, plan.inputs)


def _same_prefix(preset: Preset) -> bool:
    """Whether the first trees of an ensemble are the smaller ensemble itself."""
    unsampled = (preset.fixed.get("bootstrap") is False and preset.fixed.get("featureSubsetStrategy") == "all"
                 and preset.fixed.get("subsamplingRate", 1.0) == 1.0)
    return preset.family == "gbt" or preset.family == "rf" and unsampled


def _rolling(df: DataFrame, column: str, folds: int) -> list[tuple[list, list]]:
    """Periods of the rolling folds; a table has few periods, whatever its rows."""
    return rolling_folds([row[0] for row in df.select(column).distinct().collect()], folds)


def _penalty_search(df: DataFrame, plan: FeaturePlan, preset: Preset, column: str, periods: list | None) -> list[float]:
    """Mean RMSE over the folds, or on the rows above the split, of every penalty."""
    part, folds = _parts(preset, column, periods)
    found = linear_moments(df.withColumn("_part", part), list(plan.numeric), by="_part", impute=plan.imputed)
    return penalty_scores(found, preset.grid["regParam"], folds)


def _parts(preset: Preset, column: str, periods: list | None):
    """The part of a row, and for every fold the parts that train and those held out."""
    if periods is not None:
        return F.col(column), periods
    if preset.train_ratio is not None:
        return F.when(F.col(column) < round(preset.train_ratio * BUCKETS), 0).otherwise(1), [([0], [1])]
    return F.col(column), [([p for p in range(preset.folds) if p != k], [k]) for k in range(preset.folds)]


def _folds(df: DataFrame, preset: Preset, column: str, periods: list | None) -> list[tuple[DataFrame, DataFrame]]:
    """Training and held-out rows of every fold, or of the single split."""
    if periods is not None:
        return [(df.where(F.col(column) < held), df.where(F.col(column) == held)) for _, (held,) in periods]
    if preset.train_ratio is not None:
        is_train = F.col(column) < round(preset.train_ratio * BUCKETS)
        return [(df.where(is_train), df.where(~is_train))]
    return [(df.where(F.col(column) != k), df.where(F.col(column) == k)) for k in range(preset.folds)]


def _single_split(df: DataFrame, common: dict, ratio: float, column: str):
    """Best model, refitted on all rows, and the scores on the rows above the ratio."""
    estimator, points = common["estimator"], common["estimatorParamMaps"]
    is_train = F.col(column) < round(ratio * BUCKETS)
    train, held = df.where(is_train), df.where(~is_train)
    fits = estimator.fitMultiple(train, points)
    scores = [0.0] * len(points)

    def measure(_) -> None:
        index, model = next(fits)
        scores[index] = float(common["evaluator"].evaluate(model.transform(held)))

    with ThreadPool(min(common["parallelism"], len(points))) as pool:
        pool.map(inheritable_thread_target(df.sparkSession)(measure), range(len(points)))
    return estimator.fit(df, points[scores.index(min(scores))]), scores


def _ddl(value: object) -> str:
    if isinstance(value, int):
        return "int"
    return "double" if isinstance(value, float) else "string"


def cv_table(df: DataFrame, search: Search, score: str = "cv_rmse") -> DataFrame:
    """One row per grid point with its score."""
    names = list(search.grid[0])
    schema = ", ".join([f"{n} {_ddl(search.grid[0][n])}" for n in names] + [f"{score} double"])
    rows = [(*[point[n] for n in names], value) for point, value in zip(search.grid, search.scores)]
    return df.sparkSession.createDataFrame(rows, schema)


def importance_table(df: DataFrame, model, inputs: list[str]) -> DataFrame:
    """Importance per assembled slot: feature_index, feature, importance.

    A one-hot encoded input takes several slots; these share the input's name.
    """
    vector = model.featureImportances
    names = slot_names(df, model.getFeaturesCol(), inputs, vector.size)
    rows = [(i, name, float(value)) for i, (name, value) in enumerate(zip(names, vector.toArray()))]
    return df.sparkSession.createDataFrame(
        rows, "feature_index int, feature string, importance double")


def slot_names(df: DataFrame, features: str, inputs: list[str], size: int) -> list[str]:
    """Name of every vector slot, from the assembler's metadata on ``df``."""
    if len(inputs) == size:
        return list(inputs)
    groups = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: a.get("name", "") for attrs in groups.values() for a in attrs}
    return [found.get(i) or f"slot_{i}" for i in range(size)]


def coefficient_table(df: DataFrame, model, inputs: list[str]) -> DataFrame:
    """Coefficients by feature and the intercept of a linear model."""
    rows = list(zip(inputs, map(float, model.coefficients.toArray())))
    rows.append(("intercept", float(model.intercept)))
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def training_row(
    search: Search, preset_name: str, family: str, train_rows: int, metrics, fraction: float = 1.0,
) -> dict:
    """Metrics row of a training run: best parameters, training errors, CV score.

    ``train_rows`` are the rows used, ``fraction`` their share of the table.
    """
    best = search.best
    row = {"model": MODEL_NAMES[family], "mode": preset_name, "train_rows": int(train_rows), "fraction": float(fraction)}
    if family == "rf":
        row.update(num_trees=int(best.getNumTrees), max_depth=int(best.getMaxDepth()),
                   min_instances=int(best.getMinInstancesPerNode()))
    elif family == "linear":
        row.update(reg_param=float(best.getRegParam()))
    else:
        row.update(max_iter=int(best.getMaxIter()), max_depth=int(best.getMaxDepth()),
                   step_size=float(best.getStepSize()), num_trees=int(best.getNumTrees))
    row.update(train_rmse=metrics["rmse"], train_r2=metrics["r2"], train_mae=metrics["mae"],
               best_cv_rmse=search.best_score, training_seconds=search.seconds)
    return row


def rows_table(spark, rows: list[dict]) -> DataFrame:
    """A small table from equal-keyed rows, typed by their values."""
    names = list(rows[0])
    types = {str: "string", int: "bigint", float: "double", bool: "boolean"}
    schema = ", ".join(f"`{n}` {types[type(rows[0][n])]}" for n in names)
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)
