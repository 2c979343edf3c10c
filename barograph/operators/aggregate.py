"""Counts and regression measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.operators.derive import with_errors, with_label_range
from barograph.operators.quality import percent


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, ordered by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def partition_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct partition keys in order."""
    return df.select(*keys).distinct().orderBy(*keys)


def retention_report(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before, kept and removed, with percentages, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_kept"))
    return counted.select(
        "rows_before", "rows_kept",
        (F.col("rows_before") - F.col("rows_kept")).alias("rows_removed"),
        percent(F.col("rows_kept"), F.col("rows_before")).alias("retention_pct"))


def split_ratio_report(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of the whole per split part; the counts of a few parts only
    are summed for the whole."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(
        F.sum("rows").alias("total_rows"),
        F.collect_list(F.struct(split, "rows")).alias("parts"))
    return whole.select("total_rows", F.inline("parts")).select(
        split, "rows", "total_rows", percent(F.col("rows"), F.col("total_rows")).alias("share_pct"))


def measures(label: Column, prediction: Column) -> dict[str, Column]:
    """Aggregates for RMSE, R2, MAE and MSE, equal to ``RegressionEvaluator``."""
    error = label - prediction
    mse = F.avg(error * error)
    return {
        "rmse": F.sqrt(mse),
        "r2": F.lit(1.0) - F.try_divide(mse, F.var_pop(label)),
        "mae": F.avg(F.abs(error)),
        "mse": mse,
    }


def regression_metrics(
    df: DataFrame, *keys: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, R2, MAE, MSE and row count in one aggregate, per key if keys are given."""
    found = measures(F.col(label), F.col(prediction))
    aggregates = [expr.alias(name) for name, expr in found.items()]
    return df.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias("rows"))


def errors_by_range(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Count, mean absolute and mean squared error per label range."""
    errors = with_label_range(with_errors(df, label, prediction), label)
    return (
        errors.groupBy("range_id", "temp_range")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("abs_error").alias("mean_abs_error"),
            F.avg("squared_error").alias("mean_squared_error"))
        .orderBy("range_id")
    )


def mean_baseline(df: DataFrame, is_train: Column, label: str = "label") -> DataFrame:
    """Mean label of the training rows and its RMSE as a prediction of the others.

    One aggregate: the mean squared error of a constant is the test variance
    plus the squared distance of the constant to the test mean.
    """
    in_train = F.when(is_train, F.col(label))
    in_test = F.when(~is_train, F.col(label))
    parts = df.agg(
        F.avg(in_train).alias("train_mean"), F.avg(in_test).alias("test_mean"),
        F.var_pop(in_test).alias("test_variance"),
        F.count(in_train).alias("train_rows"), F.count(in_test).alias("test_rows"))
    distance = F.col("train_mean") - F.col("test_mean")
    return parts.select(
        "train_mean", "train_rows", "test_rows",
        F.sqrt(F.col("test_variance") + distance * distance).alias("baseline_rmse"))


def cv_summary(cv_table: DataFrame, score: str = "cv_rmse") -> DataFrame:
    """Best, worst and mean score of a cross-validation table."""
    return cv_table.agg(
        F.min(score).alias("best_cv_rmse"), F.max(score).alias("worst_cv_rmse"),
        F.avg(score).alias("mean_cv_rmse"))


def best_and_worst(df: DataFrame, *keys: str, k: int = 10) -> DataFrame:
    """The k rows with the smallest and the k with the largest absolute error.

    Ties go by the keys, then by prediction and label.
    """
    columns = [*keys, "label", "prediction", "abs_error"]
    errors = with_errors(df).select(*columns)

    def ranked(kind: str, order: Column) -> DataFrame:
        return errors.orderBy(order, *keys, "prediction", "label").limit(k).select(F.lit(kind).alias("kind"), *columns)

    return ranked("best", F.col("abs_error").asc()).unionByName(
        ranked("worst", F.col("abs_error").desc()))


def top_k(df: DataFrame, value: str, key: str, k: int | None = None) -> DataFrame:
    """The k rows with the largest value, or all in that order; ties by key."""
    ordered = df.orderBy(F.col(value).desc(), F.col(key))
    return ordered if k is None else ordered.limit(k)


def preview(df: DataFrame, columns: list[str], n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First n rows of some columns, in a stable order when ``order_by`` is given."""
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.select(*columns).limit(n)
