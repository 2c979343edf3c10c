"""Model comparison over metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COMPARISON_COLUMNS = {
    "train_rows": "bigint", "train_rmse": "double", "train_r2": "double",
    "train_mae": "double", "best_cv_rmse": "double",
}
TEST_COLUMNS = {
    "test_rmse": "double", "test_r2": "double", "test_mae": "double", "test_rows": "bigint",
}


def union_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """Metric tables of several models as one, ``model`` taken from the key."""
    named = [table.withColumn("model", F.lit(name)) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def _shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    present = set(df.columns)
    return df.select("model", *[
        (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
        for name, kind in columns.items()
    ])


def compare_models(training: DataFrame, test: DataFrame) -> DataFrame:
    """Training, cross-validation and test measures, one row per model.

    Measures a training table already has for the test rows (the linear
    baseline) are kept when there is no separate evaluation.
    """
    left = _shaped(training, COMPARISON_COLUMNS | TEST_COLUMNS)
    right = _shaped(test, TEST_COLUMNS).withColumnsRenamed(
        {name: f"evaluated_{name}" for name in TEST_COLUMNS})
    joined = left.join(right, "model", "left")
    return joined.select(
        "model", *COMPARISON_COLUMNS,
        *[F.coalesce(f"evaluated_{name}", name).alias(name) for name in TEST_COLUMNS])


def best_model(comparison: DataFrame, baseline: str) -> DataFrame:
    """Model with the lowest test RMSE and its gain over the baseline in percent."""
    found = comparison.agg(
        F.min_by(F.struct("model", "test_rmse", "test_r2", "test_mae"),
                 F.when(F.col("test_rmse").isNotNull(),
                        F.struct("test_rmse", "model"))).alias("best"),
        F.max(F.when(F.col("model") == baseline, F.col("test_rmse"))).alias("baseline_rmse"))
    gain = F.col("baseline_rmse") - F.col("best.test_rmse")
    return found.select(
        "best.*", "baseline_rmse",
        F.try_divide(gain * 100.0, F.col("baseline_rmse")).alias("improvement_pct"))


def pairwise_deltas(comparison: DataFrame, pairs: list[tuple[str, str]], measure: str) -> DataFrame:
    """Difference and relative change of a measure for named pairs of models."""
    spark = comparison.sparkSession
    wanted = spark.createDataFrame(pairs, "model_a string, model_b string")
    values = comparison.select("model", measure)
    first = values.withColumnsRenamed({"model": "model_a", measure: "value_a"})
    second = values.withColumnsRenamed({"model": "model_b", measure: "value_b"})
    delta = F.col("value_a") - F.col("value_b")
    return wanted.join(first, "model_a").join(second, "model_b").select(
        "model_a", "model_b", "value_a", "value_b",
        F.abs(delta).alias("difference"),
        F.try_divide(delta * 100.0, F.col("value_a")).alias("change_pct"))


def top_features(importances: DataFrame, k: int = 5) -> DataFrame:
    """The k most important features of each model, ties by name.

    An importance table has one row per feature and model, so the window
    partitions are small.
    """
    order = Window.partitionBy("model").orderBy(F.col("importance").desc(), F.col("feature"))
    return importances.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
