"""Training, evaluation and comparison jobs."""

from __future__ import annotations

import time

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.aggregate import (
    best_and_worst, errors_by_range, mean_baseline, regression_metrics, top_k,
)
from barograph.operators.compare import compare_models, top_features, union_metrics
from barograph.operators.derive import (
    FEATURES_14, FEATURES_15_COMPLETE, FEATURES_15_NULLABLE, available, clean_numbers,
    select_features, with_day_of_year, with_errors,
)
from barograph.operators.features import feature_list, feature_plan, split_empty_columns
from barograph.operators.learn import (
    baseline_linear, coefficient_table, cv_table, grid_search, importance_table, linear,
    rows_table, training_row,
)
from barograph.operators.presets import PRESETS
from barograph.operators.profile import summary_stats
from barograph.operators.quality import complete_cases
from barograph.operators.split import hash_split, sample_rows, split_parts, with_fold, with_period
from barograph.session import materialize, persisted, spread
from barograph.sources.models import load_model, save_model
from barograph.sources.tables import (
    read_result, read_table, write_result, write_sample, write_table,
)


#: Key columns by which sample rows are chosen, as far as a table has them.
ROW_KEYS = ("STATION", "timestamp")


def _write_predictions(scored: DataFrame, path: str, rows: int, keys, kind: str = "parquet") -> None:
    """Sample of ``rows`` scored rows, chosen by their keys, or else by label and prediction."""
    chosen = available(scored, keys) or ["label", "prediction"]
    write_sample(scored, path, rows, keys=chosen, kind=kind)


def run_baseline(
    spark: SparkSession, train_path: str, test_path: str, output_path: str,
    fraction: float = 1.0, imputed: bool = False, target: str = "temperature",
    prediction_rows: int = 1_000, keys=ROW_KEYS,
) -> dict:
    """Linear baseline: complete cases, or 15 features with medians.

    ``fraction`` may bound the training rows; the test rows are always all.
    Row counts before and after dropping incomplete rows are both reported.
    """
    features = [*FEATURES_15_COMPLETE, *FEATURES_15_NULLABLE] if imputed else list(FEATURES_14)

    def load(path: str, share: float) -> DataFrame:
        rows = read_table(spark, path)
        rows = rows if share >= 1.0 else sample_rows(rows, share)
        return select_features(rows, features, target, keep=tuple(available(rows, keys)))

    train_all, test_all = load(train_path, fraction), load(test_path, 1.0)
    with persisted(train_all), persisted(test_all):
        if imputed:
            plan = feature_plan(features, impute=FEATURES_15_NULLABLE, handle_invalid="skip")
            train, test = train_all, test_all
        else:
            plan = feature_plan(features, impute=(), handle_invalid="error")
            train, test = complete_cases(train_all, features), complete_cases(test_all, features)
        model = Pipeline(stages=[*plan.stages, baseline_linear()]).fit(train)
        row = {"model": "LinearRegressionImputed" if imputed else "LinearRegression"}
        measured = {
            part: regression_metrics(model.transform(df)).first()
            for part, df in (("train", train), ("test", test))
        }
        for name in ("rows", "rmse", "r2", "mae"):
            row.update({f"{part}_{name}": measured[part][name] for part in measured})
        row["train_rows_read"], row["test_rows_read"] = train_all.count(), test_all.count()
        row["fraction"] = float(fraction)
        scored = model.transform(test)
        _write_predictions(
            scored.select(*available(scored, keys), "label", "prediction"),
            f"{output_path}/sample_predictions", prediction_rows, keys)
    write_result(rows_table(spark, [row]), f"{output_path}/metrics")
    write_result(
        coefficient_table(train, model.stages[-1], plan.inputs), f"{output_path}/coefficients")
    save_model(model, f"{output_path}/model")
    return row


def run_training(
    spark: SparkSession, train_path: str, output_path: str, preset_name: str,
    features=FEATURES_14, target: str = "temperature", partitions: int | None = None,
    fold_keys=ROW_KEYS, handle_invalid: str = "keep", parallelism: int | None = None,
    prediction_rows: int = 10_000, rolling: tuple[str, str] | None = None,
    share_trees: bool = True,
) -> dict:
    """Grid search on a train table; writes model, metrics, scores and importances.

    ``preset_name`` names a preset, or is one. ``rolling``, a time column and a
    calendar unit, scores every one of the last periods by models of those
    before it, in place of folds over all time. ``share_trees`` scores all
    forest sizes from one fit a fold.
    """
    preset = PRESETS[preset_name] if isinstance(preset_name, str) else preset_name
    mode = preset_name if isinstance(preset_name, str) else "custom"
    rows = read_table(spark, train_path)
    if preset.fraction < 1.0:
        rows = sample_rows(rows, preset.fraction)
    keys = available(rows, fold_keys)
    if rolling:
        rows = with_period(rows, *rolling, name="fold")
    elif keys:
        rows = with_fold(rows, keys, preset.fold_count)
    folded = bool(rolling or keys)
    data = spread(
        select_features(rows, features, target, keep=("fold", *keys) if folded else ()), partitions)
    with persisted(data):
        used, _ = split_empty_columns(data, features)
        plan = feature_plan(used, handle_invalid=handle_invalid)
        search = grid_search(data, plan, preset, "fold" if folded else None, parallelism,
                             rolling=bool(rolling), share_trees=share_trees)
        scored = materialize(search.model.transform(data).select(*keys, "label", "prediction"))
    metrics = regression_metrics(scored).first()
    row = training_row(search, mode, preset.family, metrics["rows"], metrics, preset.fraction)
    write_result(rows_table(spark, [row]), f"{output_path}/metrics")
    write_result(cv_table(data, search), f"{output_path}/cv_results")
    if preset.family == "linear":
        write_result(coefficient_table(data, search.best, plan.inputs), f"{output_path}/coefficients")
    else:
        importances = importance_table(data, search.best, plan.inputs)
        write_result(top_k(importances, "importance", "feature_index"), f"{output_path}/feature_importances")
    _write_predictions(scored, f"{output_path}/sample_predictions", prediction_rows, fold_keys)
    save_model(search.model, f"{output_path}/model")
    return row


def run_encoded_training(
    spark: SparkSession, input_path: str, output_path: str, preset_name: str | None,
    numeric, categorical=(), split_keys=("STATION", "DATE"), partitions: int | None = None,
    scale: bool = False, parallelism: int | None = None, prediction_rows: int = 1_000_000,
    importance_rows: int | None = None,
) -> dict:
    """Training on the value-quality table with encoded categories.

    ``preset_name=None`` fits the linear model on an 80/20 split without a
    search. Candidates the table lacks are skipped, as are empty ones; at least
    one of the split keys must be there. Hour and day come from ``ts``, or from
    the text ``DATE`` where there is no ``ts``.
    """
    df = read_table(spark, input_path).where(F.col("label").isNotNull())
    if "ts" not in df.columns and "DATE" in df.columns:
        df = df.withColumn("ts", F.try_to_timestamp("DATE"))
    if "ts" in df.columns:
        df = with_day_of_year(df.withColumn("hour", F.hour("ts")), "ts")
    df = spread(clean_numbers(df, available(df, numeric)), partitions)
    weights = {"train": 80, "test": 20} if preset_name is None else None
    table = hash_split(df, available(df, split_keys), weights)
    categories = available(df, categorical)
    preset = PRESETS[preset_name] if preset_name else None
    if preset:
        table = with_fold(table, available(df, split_keys), preset.fold_count)
    train, test = split_parts(table)
    with persisted(train), persisted(test):
        used, _ = split_empty_columns(train, available(df, numeric))
        plan = feature_plan(used, categories, suffix="_imp", scale=scale)
        started = time.monotonic()
        if preset is None:
            model, family, search = Pipeline(stages=[*plan.stages, linear()]).fit(train), "linear", None
        else:
            search = grid_search(train, plan, preset, "fold", parallelism)
            model, family = search.model, preset.family
        seconds = time.monotonic() - started
        vectors = model.transform(test)
        scored = materialize(vectors.select(*available(df, split_keys), "label", "prediction"))
        both = train.select("label", F.lit(True).alias("is_train")).union(test.select("label", F.lit(False)))
        baseline = mean_baseline(both, F.col("is_train")).first()["baseline_rmse"]
    row = {
        "model": family, "strategy": preset_name or "linear",
        "rmse": regression_metrics(scored).first()["rmse"],
        "baseline_rmse": baseline, "seconds": seconds,
    }
    write_result(rows_table(spark, [row]), f"{output_path}/metrics")
    write_result(feature_list(df, plan.inputs), f"{output_path}/feature_list")
    if search:
        write_result(cv_table(df, search, "rmse"), f"{output_path}/cv_results")
        importances = importance_table(vectors, search.best, plan.inputs)
        write_result(
            top_k(importances, "importance", "feature_index", importance_rows),
            f"{output_path}/feature_importances")
    _write_predictions(scored, f"{output_path}/sample_predictions", prediction_rows, split_keys, kind="csv")
    save_model(model, f"{output_path}/model")
    return row


def run_evaluation(
    spark: SparkSession, model_path: str, test_path: str, output_path: str,
    features=FEATURES_14, target: str = "temperature", key=ROW_KEYS, k: int = 10,
) -> dict[str, DataFrame]:
    """Score the test rows once, write the error table and report from it.

    The written table takes the place of a cache: every report is an aggregate
    over its columns, and a lost executor costs no second scoring.
    """
    test = read_table(spark, test_path)
    keys = available(test, key)
    data = select_features(test, features, target, keep=tuple(keys))
    scored = with_errors(load_model(model_path).transform(data))
    columns = [*keys, "label", "prediction", "error", "abs_error"]
    write_table(scored.select(*columns), f"{output_path}/error_analysis")
    errors = read_table(spark, f"{output_path}/error_analysis")
    write_table(errors.select("label", "prediction"), f"{output_path}/test_predictions")
    metrics = regression_metrics(errors).select(
        F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"),
        F.col("mae").alias("test_mae"), F.col("mse").alias("test_mse"),
        F.col("rows").alias("test_rows"))
    write_result(metrics, f"{output_path}/test_metrics")
    return {
        "metrics": read_result(spark, f"{output_path}/test_metrics"),
        "error_stats": summary_stats(errors, ["error", "abs_error"]),
        "by_range": errors_by_range(errors),
        "best_and_worst": best_and_worst(errors, *keys, k=k),
    }


def run_comparison(
    spark: SparkSession, runs: dict[str, str], evaluations: dict[str, str],
) -> dict[str, DataFrame]:
    """Comparison and top features of the runs that exist.

    ``runs`` maps a model name to its training output, ``evaluations`` to its
    evaluation output.
    """
    training = _present(spark, runs, "metrics")
    tested = _present(spark, evaluations, "test_metrics")
    importances = _present(spark, runs, "feature_importances")
    if not training:
        raise ValueError("none of the runs has metrics")
    trained = union_metrics(training)
    empty = spark.createDataFrame([], "model string, test_rmse double")
    found = {"comparison": compare_models(trained, union_metrics(tested) if tested else empty)}
    if importances:
        found["top_features"] = top_features(union_metrics(importances))
    return found


def _present(spark: SparkSession, paths: dict[str, str], table: str) -> dict[str, DataFrame]:
    read = {name: read_result(spark, f"{path}/{table}") for name, path in paths.items()}
    return {name: df for name, df in read.items() if df is not None}
