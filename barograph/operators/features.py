"""Feature-pipeline stages."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.derived import nan_to_null


@dataclass(frozen=True)
class FeaturePlan:
    """Stages of a feature pipeline and the assembled column names in order.

    ``numeric`` names the source columns where the inputs are these, imputed as
    far as ``imputed`` says, and nothing else.
    """

    stages: list
    inputs: list[str]
    numeric: tuple[str, ...] = ()
    imputed: tuple[str, ...] = ()


def feature_plan(
    numeric, categorical=(), impute=None, handle_invalid: str = "keep", suffix: str = "_imputed",
    scale: bool = False, relative_error: float = 1e-3,
) -> FeaturePlan:
    """Median imputer, category encoders, assembler and scaler, as far as needed.

    ``impute`` lists the numeric columns to impute: all by default, none for ().
    A stage without columns is left out.
    """
    numeric, categorical = list(numeric), list(categorical)
    imputed = set(numeric if impute is None else impute)
    inputs = [f"{name}{suffix}" if name in imputed else name for name in numeric]
    stages = []
    if imputed:
        columns = [name for name in numeric if name in imputed]
        stages.append(Imputer(
            strategy="median", relativeError=relative_error,
            inputCols=columns, outputCols=[f"{name}{suffix}" for name in columns]))
    if categorical:
        indexed = [f"{name}_idx" for name in categorical]
        encoded = [f"{name}_oh" for name in categorical]
        stages.append(StringIndexer(
            inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
        inputs += encoded
    if not inputs:
        raise ValueError("no feature columns left to assemble")
    assembled = "features_raw" if scale else "features"
    stages.append(VectorAssembler(
        inputCols=inputs, outputCol=assembled, handleInvalid=handle_invalid))
    if scale:
        stages.append(StandardScaler(
            inputCol=assembled, outputCol="features", withMean=False, withStd=True))
    plain = not categorical and not scale
    return FeaturePlan(stages, inputs, tuple(numeric) if plain else (), tuple(n for n in numeric if n in imputed) if plain else ())


def with_imputed(df: DataFrame, medians: dict[str, float], suffix: str = "_imputed") -> DataFrame:
    """Add a filled copy of each column, NULL and NaN replaced by its median."""
    return df.withColumns({
        f"{name}{suffix}": F.coalesce(nan_to_null(F.col(name)), F.lit(median))
        for name, median in medians.items()
    })


def split_empty_columns(df: DataFrame, columns) -> tuple[list[str], list[str]]:
    """Columns with and without values; an imputer cannot fit the latter.

    One pass over ``df`` (an action).
    """
    columns = list(columns)
    row = df.agg(*[
        F.count(nan_to_null(F.col(name))).alias(f"c{i}")
        for i, name in enumerate(columns)
    ]).first()
    filled = [name for i, name in enumerate(columns) if row[i] > 0]
    return filled, [name for name in columns if name not in filled]


class SharedPrepPipeline(Pipeline):
    """Pipeline that fits its feature stages once for a whole parameter grid.

    A tuner asks an estimator to fit all grid points on the same rows. Only the
    last stage has grid parameters here, so the imputer and encoders see the
    rows once per fold instead of once per fold and grid point.
    """

    def fitMultiple(self, dataset, paramMaps):  # noqa: N802 (Spark's name)
        *prep, estimator = self.getStages()
        if not isinstance(estimator, Estimator) or not _only_for(estimator, paramMaps):
            return super().fitMultiple(dataset, paramMaps)
        prepared = Pipeline(stages=prep).fit(dataset)
        rows = prepared.transform(dataset).persist(StorageLevel.MEMORY_AND_DISK)

        def fit_one(index: int) -> PipelineModel:
            fitted = estimator.fit(rows, paramMaps[index])
            return PipelineModel([*prepared.stages, fitted])

        return _Fits(fit_one, len(paramMaps), rows.unpersist)


class _Fits:
    """Iterator over the fits of a grid, for several threads; releases the rows after the last."""

    def __init__(self, fit_one, count: int, release) -> None:
        self.fit_one, self.count, self.release = fit_one, count, release
        self.started = self.done = 0
        self.lock = threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            index, self.started = self.started, self.started + 1
        if index >= self.count:
            raise StopIteration
        fitted = self.fit_one(index)
        with self.lock:
            self.done += 1
            if self.done == self.count:
                self.release()
        return index, fitted


def _only_for(estimator, param_maps) -> bool:
    return all(param.parent == estimator.uid for grid in param_maps for param in grid)


def feature_list(df: DataFrame, inputs: list[str]) -> DataFrame:
    """Assembler input order as a table (index, column)."""
    return df.sparkSession.createDataFrame(
        list(enumerate(inputs)), "index int, column string")
