"""Trees, searches, history models and whole training jobs with closed-form counterparts."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.aggregate import cv_summary, regression_metrics, top_k
from barograph.operators.cells import feature_cells
from barograph.operators.compare import best_model
from barograph.operators.decode import columns_with_prefix
from barograph.operators.derive import (
    CATEGORIES, FEATURES_14, FEATURES_15_COMPLETE, FEATURES_15_NULLABLE, clean_numbers, with_day_of_year,
)
from barograph.operators.features import feature_list, feature_plan, split_empty_columns
from barograph.operators.history import (
    HISTORY_COLUMNS, STATION_AVERAGES, apply_station_stats, attach_history, fit_station_stats,
    history_features, hourly_series,
)
from barograph.operators.learn import (
    baseline_linear, boosted, cv_table, forest, grid_search, importance_table, training_row,
)
from barograph.operators.presets import Preset
from barograph.operators.quality import complete_cases
from barograph.operators.split import hash_split, split_parts, time_split, with_fold
from barograph.plans.modeling import (
    run_baseline, run_comparison, run_encoded_training, run_evaluation, run_training,
)
from barograph.session import persisted, scratch_path, spread
from barograph.sources.tables import key_sample, read_result, read_table, write_table
from workload.cleaning import clean, packed
from workload.common import Registry, hash_bucket_sql, is_train_sql, load, r, rounded, stored
from workload.learning import WEATHER, _ridge_sql
from workload.packed import clean_sql

registry = Registry()
query = registry.query


# Trees of one cut, whose best place SQL finds by the variance explained.

def _stump_sql(name: str, source: str, label: str) -> str:
    """CTEs with the best cut of ``l_quantity`` for ``label`` and the means on either side."""
    return f"""{name}_values AS (SELECT l_quantity AS v, count(*) AS n, sum({label}) AS s FROM {source} GROUP BY 1),
  {name}_sums AS (SELECT v, sum(n) OVER (ORDER BY v) AS n, sum(s) OVER (ORDER BY v) AS s,
    sum(n) OVER () AS n_all, sum(s) OVER () AS s_all FROM {name}_values),
  {name} AS (SELECT v, s / n AS low, (s_all - s) / (n_all - n) AS high FROM {name}_sums WHERE n < n_all
    ORDER BY s * s / n + (s_all - s) * (s_all - s) / (n_all - n) DESC, v LIMIT 1)"""


_PRICES_SQL = "prices AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / 1000 AS label FROM lineitem)"
_FIRST_SQL = f"""WITH {_PRICES_SQL}, {_stump_sql('stump', 'prices', 'label')},
  first AS (SELECT p.*, CASE WHEN l_quantity <= v THEN low ELSE high END AS prediction FROM prices p, stump)"""
_CUT = {"maxDepth": 1, "maxBins": 64}


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_discount") * 0).alias("nothing"),
        (F.col("l_extendedprice") / 1000).alias("label"))


def _fit_prices(rows: DataFrame, estimator):
    """Trees over the cells of the rows, which are no more than there are quantities."""
    plan = feature_plan(["l_quantity", "nothing"], impute=(), handle_invalid="error")
    cells = feature_cells(rows, list(plan.numeric))
    return plan, Pipeline(stages=[*plan.stages, estimator.setWeightCol("weight")]).fit(cells)


def _one_tree():
    return forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all", **_CUT)


@query(f"{_FIRST_SQL} SELECT l_orderkey, l_linenumber, {r('prediction')} FROM first")
def rf_stump_scores(spark, sf_dir):
    rows = _prices(spark, sf_dir)
    _, model = _fit_prices(rows, _one_tree())
    return rounded(model.transform(rows).select("l_orderkey", "l_linenumber", "prediction"))


@query(f"""{_FIRST_SQL}, left_over AS (SELECT *, 2 * (label - prediction) AS residual FROM first),
  {_stump_sql('second', 'left_over', 'residual')}
  SELECT l_orderkey, l_linenumber,
    {r('prediction + 0.1 * CASE WHEN l_quantity <= v THEN low ELSE high END', 'prediction')} FROM left_over, second""")
def gbt_two_stumps(spark, sf_dir):
    rows = _prices(spark, sf_dir)
    _, model = _fit_prices(rows, boosted(maxIter=2, stepSize=0.1, **_CUT))
    return rounded(model.transform(rows).select("l_orderkey", "l_linenumber", "prediction"))


@query("""SELECT * FROM (VALUES (CAST(0 AS INTEGER), 'l_quantity', CAST(1 AS DOUBLE)), (1, 'nothing', 0.0))
  AS t(feature_index, feature, importance)""")
def rf_stump_importances(spark, sf_dir):
    rows = _prices(spark, sf_dir)
    plan, model = _fit_prices(rows, _one_tree())
    return top_k(importance_table(rows, model.stages[-1], plan.inputs), "importance", "feature_index", 2)


# Searches over the number of trees: one fit a fold, all sizes scored from it.

def _cut_value(stump: str, x: str = "l_quantity") -> str:
    return f"(SELECT CASE WHEN {x} <= v THEN low ELSE high END FROM {stump})"


_FOLD_SQL = hash_bucket_sql("l_orderkey", 2).replace("md5(", "md5('fold|' || ")
_SIZES_SQL = f"WITH priced AS (SELECT l_quantity, l_extendedprice / 1000 AS label, {_FOLD_SQL} AS fold FROM lineitem), " + ", ".join(
    f"""fit{k} AS (SELECT * FROM priced WHERE fold <> {k}), {_stump_sql(f'one{k}', f'fit{k}', 'label')},
  left{k} AS (SELECT l_quantity, 2 * (label - {_cut_value(f'one{k}')}) AS residual FROM fit{k}),
  {_stump_sql(f'two{k}', f'left{k}', 'residual')},
  held{k} AS (SELECT label - {_cut_value(f'one{k}')} AS first, label - {_cut_value(f'one{k}')} - 0.1 * {_cut_value(f'two{k}')} AS second
    FROM priced WHERE fold = {k})""" for k in (0, 1))


def _mean_rmse(error: str) -> str:
    return r(" + ".join(f"(SELECT sqrt(avg({error} * {error})) FROM held{k}) / 2" for k in (0, 1)), "cv_rmse")


def _size_search(spark: SparkSession, sf_dir: str, family: str, grid: dict, **fixed) -> DataFrame:
    data = with_fold(_prices(spark, sf_dir), ["l_orderkey"], 2)
    with persisted(data):
        preset = Preset(family, grid, folds=2, fixed={"maxBins": 64, **fixed})
        return rounded(cv_table(data, grid_search(data, feature_plan(["l_quantity", "nothing"], impute=()), preset, "fold")))


@query(f"""{_SIZES_SQL} SELECT n AS "numTrees", CAST(1 AS INTEGER) AS "maxDepth", {_mean_rmse('first')}
  FROM (VALUES (CAST(1 AS INTEGER)), (2), (4)) AS t(n)""")
def rf_prefix_scores(spark, sf_dir):
    """Forests without sampling, whose trees are all the best cut."""
    return _size_search(spark, sf_dir, "rf", {"numTrees": [1, 2, 4], "maxDepth": [1]}, bootstrap=False, featureSubsetStrategy="all")


@query(f"""{_SIZES_SQL} SELECT CAST(1 AS INTEGER) AS "maxIter", CAST(1 AS INTEGER) AS "maxDepth", {_mean_rmse('first')}
  UNION ALL SELECT 2, 1, {_mean_rmse('second')}""")
def gbt_prefix_scores(spark, sf_dir):
    return _size_search(spark, sf_dir, "gbt", {"maxIter": [1, 2], "maxDepth": [1]}, stepSize=0.1)


# Searches over the penalty of a linear model: every score has a closed form.

_PENALTIES = (0.0, 0.1, 1.0)
_OBS_SQL = f"""obs AS (SELECT event_id, dew_point, wind_speed, temperature AS label,
    {hash_bucket_sql('event_id').replace('md5(', "md5('fold|' || ").replace('% 100', '% 2')} AS fold,
    {hash_bucket_sql('event_id').replace('md5(', "md5('fold|' || ")} AS part
  FROM kept WHERE dew_point IS NOT NULL AND wind_speed IS NOT NULL)"""


def _ridge_value(value: str, penalty: float, fit: str, held: str = "TRUE") -> str:
    """SQL: an aggregate over ``held`` rows of the ridge model fitted on ``fit`` rows."""
    return (f"(WITH {_ridge_sql('obs', 'dew_point', 'wind_speed', 'label', penalty, fit)}, predicted AS ("
            f"SELECT label, b0 + b1 * dew_point + b2 * wind_speed AS prediction FROM obs, fit2 WHERE {held}) "
            f"SELECT {value} FROM predicted)")


_RMSE = "sqrt(avg(pow(label - prediction, 2)))"
_CV = {p: " + ".join(f"{_ridge_value(_RMSE, p, f'fold <> {k}', f'fold = {k}')} / 2" for k in (0, 1)) for p in _PENALTIES}
_CV_SQL = "scores AS (" + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS \"regParam\", {sql} AS cv_rmse" for p, sql in _CV.items()) + ")"


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir).select("event_id", *WEATHER, F.col("temperature").alias("label"))
    return stored(complete_cases(rows, WEATHER), "observations")


def _search(spark: SparkSession, sf_dir: str, **settings):
    preset = Preset("linear", {"regParam": list(_PENALTIES)}, **settings)
    data = with_fold(_observations(spark, sf_dir), ["event_id"], preset.fold_count)
    with persisted(data):
        search = grid_search(data, feature_plan(WEATHER, impute=()), preset, "fold")
        metrics = regression_metrics(search.model.transform(data)).first()
    return data, search, metrics


@query(clean_sql(_OBS_SQL, _CV_SQL) + f""" SELECT "regParam", {r('cv_rmse')} FROM scores""")
def lr_cv_results(spark, sf_dir):
    data, search, _ = _search(spark, sf_dir, folds=2)
    return rounded(cv_table(data, search), "cv_rmse")


@query(clean_sql(_OBS_SQL, _CV_SQL) + f""" SELECT {r('min(cv_rmse)', 'best_cv_rmse')},
  {r('max(cv_rmse)', 'worst_cv_rmse')}, {r('avg(cv_rmse)', 'mean_cv_rmse')} FROM scores""")
def lr_cv_summary(spark, sf_dir):
    data, search, _ = _search(spark, sf_dir, folds=2)
    return rounded(cv_summary(cv_table(data, search)))


_BEST_SQL = "best AS (SELECT * FROM scores ORDER BY cv_rmse, \"regParam\" LIMIT 1)"
_TRAIN_SQL = "CASE \"regParam\" " + " ".join(
    f"WHEN {p} THEN {_ridge_value(_RMSE, p, 'TRUE')}" for p in _PENALTIES) + " END"


@query(clean_sql(_OBS_SQL, _CV_SQL, _BEST_SQL) + f""" SELECT 'LinearRegression' AS model, (SELECT count(*) FROM obs) AS train_rows,
  "regParam" AS reg_param, {r(_TRAIN_SQL, 'train_rmse')}, {r('cv_rmse', 'best_cv_rmse')}, TRUE AS took_time FROM best""")
def lr_best_params(spark, sf_dir):
    _, search, metrics = _search(spark, sf_dir, folds=2)
    row = training_row(search, "penalties", "linear", metrics["rows"], metrics)
    return rounded(spark.createDataFrame(
        [(row["model"], row["train_rows"], row["reg_param"], row["train_rmse"], row["best_cv_rmse"],
          row["training_seconds"] > 0)],
        "model string, train_rows bigint, reg_param double, train_rmse double, best_cv_rmse double, took_time boolean"))


@query(clean_sql(_OBS_SQL) + " " + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS \"regParam\", {r(_ridge_value(_RMSE, p, 'part < 80', 'part >= 80'), 'rmse')}"
    for p in _PENALTIES))
def lr_single_split(spark, sf_dir):
    data, search, _ = _search(spark, sf_dir, train_ratio=0.8)
    return rounded(cv_table(data, search, "rmse"), "rmse")


_GAPPY_SQL = f"""gappy AS (SELECT dew_point, wind_speed, temperature AS label,
    {hash_bucket_sql('event_id').replace('md5(', "md5('fold|' || ").replace('% 100', '% 2')} AS fold FROM kept), """ + ", ".join(
    f"""filled{k} AS (SELECT {', '.join(f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM gappy WHERE fold <> {k})) AS {c}" for c in WEATHER)},
    label, fold FROM gappy)""" for k in (0, 1))


def _filled_score(penalty: float, k: int) -> str:
    fit = _ridge_sql(f"filled{k}", "dew_point", "wind_speed", "label", penalty, f"fold <> {k}")
    return (f"(WITH {fit} SELECT sqrt(avg(pow(label - (SELECT b0 FROM fit2) - (SELECT b1 FROM fit2) * dew_point "
            f"- (SELECT b2 FROM fit2) * wind_speed, 2))) FROM filled{k} WHERE fold = {k})")


@query(clean_sql(_GAPPY_SQL) + " " + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS \"regParam\", {r(' + '.join(f'{_filled_score(p, k)} / 2' for k in (0, 1)), 'cv_rmse')}"
    for p in _PENALTIES))
def lr_imputed_cv_results(spark, sf_dir):
    """Penalties scored from the statistics of each fold, gaps filled with its own medians."""
    rows = clean(spark, sf_dir).select("event_id", *WEATHER, F.col("temperature").alias("label"))
    preset = Preset("linear", {"regParam": list(_PENALTIES)}, folds=2)
    data = with_fold(rows, ["event_id"], 2)
    with persisted(data):
        return rounded(cv_table(data, grid_search(data, feature_plan(WEATHER), preset, "fold")), "cv_rmse")


# The history model: all earlier features, a split by time, medians and a linear model.

_STATION_COLUMNS = tuple(STATION_AVERAGES.values())
_HISTORY_FEATURES = (*FEATURES_14, *HISTORY_COLUMNS, *_STATION_COLUMNS, "doy_sin", "doy_cos")


def _lag(column: str, k: int) -> str:
    return (f"max({column}) OVER (PARTITION BY \"STATION\" ORDER BY hour_epoch "
            f"RANGE BETWEEN {3600 * k} PRECEDING AND {3600 * k} PRECEDING)")


_HISTORY_SQL = f"""stationed AS (SELECT * REPLACE (right("STATION", 1) AS "STATION") FROM kept),
  cut AS (SELECT min(timestamp) + (max(timestamp) - min(timestamp)) * 0.7 AS moment FROM stationed),
  hourly AS (SELECT "STATION", CAST(floor(epoch(timestamp) / 3600) * 3600 AS BIGINT) AS hour_epoch,
    avg(temperature) AS temperature, avg(sea_level_pressure) AS sea_level_pressure FROM stationed GROUP BY 1, 2),
  history AS (SELECT "STATION", hour_epoch, {_lag('temperature', 1)} AS temp_lag_1h, {_lag('temperature', 2)} AS temp_lag_2h,
    {_lag('temperature', 3)} AS temp_lag_3h, {_lag('sea_level_pressure', 1)} AS pressure_lag_1h,
    avg(temperature) OVER (PARTITION BY "STATION" ORDER BY hour_epoch RANGE BETWEEN 10800 PRECEDING AND 1 PRECEDING)
      AS temp_rolling_3h, {_lag('temperature', 1)} - {_lag('temperature', 2)} AS temp_change_1h FROM hourly),
  stations AS (SELECT "STATION", avg(temperature) AS station_avg_temp, avg(dew_point) AS station_avg_dew,
    avg(sea_level_pressure) AS station_avg_pressure FROM stationed, cut WHERE timestamp < date_trunc('day', moment) GROUP BY 1),
  featured AS (SELECT k.*, h.* EXCLUDE ("STATION", hour_epoch), s.* EXCLUDE ("STATION"),
    sin(dayofyear(timestamp) * 2 * pi() / 365.25) AS doy_sin, cos(dayofyear(timestamp) * 2 * pi() / 365.25) AS doy_cos,
    CASE WHEN timestamp < date_trunc('day', moment) THEN 'train' ELSE 'test' END AS split
    FROM stationed k CROSS JOIN cut
    LEFT JOIN history h ON k."STATION" = h."STATION"
      AND CAST(floor(epoch(k.timestamp) / 3600) * 3600 AS BIGINT) = h.hour_epoch
    LEFT JOIN stations s ON k."STATION" = s."STATION")"""


def _history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 25 features; the split is at a day seven tenths into the time covered.

    The last digit of the station stands for it, so that most hours have a past.
    """
    rows = stored(clean(spark, sf_dir).withColumn("STATION", F.right("STATION", F.lit(1))), "history-rows")
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    cutoff = (first + (last - first) * 0.7).replace(hour=0, minute=0, second=0, microsecond=0)
    parted = time_split(rows, "timestamp", str(cutoff))
    history = history_features(hourly_series(rows, "STATION", "timestamp", ["temperature", "sea_level_pressure"]))
    stats = fit_station_stats(parted.where(F.col("split") == "train"))
    featured = apply_station_stats(attach_history(parted, history), stats)
    return with_day_of_year(featured).select(
        "event_id", "split", *_HISTORY_FEATURES, F.col("temperature").alias("label"))


@query(clean_sql(_HISTORY_SQL) + f""" SELECT event_id, split, {', '.join(r(c) for c in _HISTORY_FEATURES)},
  {r('temperature', 'label')} FROM featured""")
def history_feature_table(spark, sf_dir):
    return rounded(_history_table(spark, sf_dir))


@query(clean_sql(_HISTORY_SQL) + """ SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows, CAST(25 AS INTEGER) AS features, TRUE AS below_train_mean FROM featured""")
def history_model_metrics(spark, sf_dir):
    """Test errors of the history model, which must stay below those of the training mean."""
    train, test = split_parts(stored(_history_table(spark, sf_dir), "history-features"))
    plan = feature_plan(split_empty_columns(train, _HISTORY_FEATURES)[0])
    model = Pipeline(stages=[*plan.stages, baseline_linear()]).fit(train)
    found = regression_metrics(model.transform(test)).first()
    mean = train.agg(F.avg("label")).first()[0]
    constant = regression_metrics(test.withColumn("prediction", F.lit(mean))).first()
    return spark.createDataFrame(
        [(train.count(), found["rows"], len(plan.inputs), found["rmse"] < constant["rmse"])],
        "train_rows bigint, test_rows bigint, features int, below_train_mean boolean")


# Whole jobs, read back from what they wrote.

_JOB_SQL = f"""base AS (SELECT *, {is_train_sql('event_id')} AS is_train FROM kept)"""


def _written_parts(spark: SparkSession, sf_dir: str, *keep: str) -> tuple[str, str]:
    parts = split_parts(hash_split(stored(clean(spark, sf_dir, *keep), "job-rows"), ["event_id"]))
    paths = tuple(scratch_path(spark, name) for name in ("job-train", "job-test"))
    for part, path in zip(parts, paths):
        write_table(part, path)
    return paths


def _baseline(spark: SparkSession, sf_dir: str, imputed: bool) -> DataFrame:
    train, test = _written_parts(spark, sf_dir)
    out = scratch_path(spark, "baseline")
    run_baseline(spark, train, test, out, imputed=imputed, keys=("event_id",))
    metrics = read_result(spark, f"{out}/metrics")
    terms = read_result(spark, f"{out}/coefficients").count()
    return metrics.select(
        "model", *[F.col(f"{part}_{name}").cast("bigint").alias(f"{part}_{name}")
                   for part in ("train", "test") for name in ("rows", "rows_read")],
        (F.col("test_rmse") > 0).alias("has_errors"), F.lit(terms).cast("bigint").alias("terms"))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES_14)


@query(clean_sql(_JOB_SQL) + f""" SELECT 'LinearRegression' AS model,
  count(*) FILTER (WHERE is_train AND {_COMPLETE}) AS train_rows, count(*) FILTER (WHERE is_train) AS train_rows_read,
  count(*) FILTER (WHERE NOT is_train AND {_COMPLETE}) AS test_rows, count(*) FILTER (WHERE NOT is_train) AS test_rows_read,
  TRUE AS has_errors, CAST(15 AS BIGINT) AS terms FROM base""")
def baseline_job(spark, sf_dir):
    return _baseline(spark, sf_dir, imputed=False)


_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES_15_COMPLETE)


@query(clean_sql(_JOB_SQL) + f""" SELECT 'LinearRegressionImputed' AS model,
  count(*) FILTER (WHERE is_train AND {_PRESENT}) AS train_rows, count(*) FILTER (WHERE is_train) AS train_rows_read,
  count(*) FILTER (WHERE NOT is_train AND {_PRESENT}) AS test_rows, count(*) FILTER (WHERE NOT is_train) AS test_rows_read,
  TRUE AS has_errors, CAST({len(FEATURES_15_COMPLETE + FEATURES_15_NULLABLE) + 1} AS BIGINT) AS terms FROM base""")
def baseline_imputed_job(spark, sf_dir):
    return _baseline(spark, sf_dir, imputed=True)


@query(clean_sql(_OBS_SQL, _CV_SQL, _BEST_SQL) + f""" SELECT (SELECT count(*) FROM obs) AS train_rows, "regParam" AS reg_param,
  {r(_TRAIN_SQL, 'train_rmse')}, {r('cv_rmse', 'best_cv_rmse')}, CAST(1 AS DOUBLE) AS fraction,
  (SELECT count(*) FROM obs) AS sample_rows, CAST(3 AS BIGINT) AS terms FROM best""")
def training_job(spark, sf_dir):
    """Grid search over a written table: metrics, scores and coefficients as the job wrote them."""
    train, out = scratch_path(spark, "train"), scratch_path(spark, "training")
    write_table(_observations(spark, sf_dir), train)
    run_training(spark, train, out, Preset("linear", {"regParam": list(_PENALTIES)}, folds=2), WEATHER,
                 target="label", fold_keys=("event_id",), prediction_rows=10 ** 9)
    sample = read_table(spark, f"{out}/sample_predictions").count()
    terms = read_result(spark, f"{out}/coefficients").count()
    return rounded(read_result(spark, f"{out}/metrics").select(
        F.col("train_rows").cast("bigint").alias("train_rows"), "reg_param", "train_rmse", "best_cv_rmse",
        F.col("fraction").cast("double").alias("fraction"), F.lit(sample).cast("bigint").alias("sample_rows"),
        F.lit(terms).cast("bigint").alias("terms")))


_ENCODED = ("DEW_num", "SLP_num", "LATITUDE", "hour", "dayofyear", "absent")


@query(clean_sql() + f""" SELECT 'linear' AS strategy, 'DEW_num_imp,SLP_num_imp,LATITUDE_imp,hour_imp,dayofyear_imp,REPORT_TYPE_oh' AS columns,
  count(*) FILTER (WHERE NOT {hash_bucket_sql('event_id')} < 80) AS scored_rows, TRUE AS below_mean FROM kept""")
def encoded_training_job(spark, sf_dir):
    """Encoded categories, numbers as text (some malformed), hour and day from the text DATE."""
    source, out = scratch_path(spark, "encoded"), scratch_path(spark, "encoded-run")
    rows = clean(spark, sf_dir, "REPORT_TYPE").select(
        "event_id", "REPORT_TYPE", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.col("dew_point").alias("DEW_num"), F.col("sea_level_pressure").alias("SLP_num"),
        F.when(F.col("event_id") % 13 == 0, "abc").otherwise(F.col("latitude").cast("string")).alias("LATITUDE"),
        F.col("temperature").alias("label"))
    write_table(rows, source)
    run_encoded_training(spark, source, out, None, _ENCODED, CATEGORIES, split_keys=("event_id",),
                         scale=True, prediction_rows=10 ** 9)
    names = read_result(spark, f"{out}/feature_list").orderBy("index").collect()
    scored = spark.read.csv(f"{out}/sample_predictions", header=True).count()
    return read_result(spark, f"{out}/metrics").select(
        "strategy", F.lit(",".join(row["column"] for row in names)).alias("columns"),
        F.lit(scored).cast("bigint").alias("scored_rows"), (F.col("rmse") < F.col("baseline_rmse")).alias("below_mean"))


@query(clean_sql(_JOB_SQL) + f""" SELECT model, CASE model WHEN 'Linear' THEN
    (SELECT count(*) FROM base WHERE is_train AND {_COMPLETE}) ELSE (SELECT count(*) FROM base WHERE is_train) END AS train_rows,
  CASE model WHEN 'Linear' THEN (SELECT count(*) FROM base WHERE NOT is_train AND {_COMPLETE})
    WHEN 'Forest' THEN (SELECT count(*) FROM base WHERE NOT is_train) END AS test_rows,
  CAST(CASE model WHEN 'Linear' THEN 0 ELSE 5 END AS BIGINT) AS top_features, model = 'Forest' AS searched,
  TRUE AS best_is_tested FROM (VALUES ('Linear'), ('Forest')) AS t(model)""")
def comparison_job(spark, sf_dir):
    """A baseline and a forest, trained, evaluated and compared by the jobs."""
    train, test = _written_parts(spark, sf_dir)
    base, run, evaluated = (scratch_path(spark, n) for n in ("compare-base", "compare-rf", "compare-eval"))
    run_baseline(spark, train, test, base, keys=("event_id",))
    small = Preset("rf", {"numTrees": [3], "maxDepth": [2, 3], "minInstancesPerNode": [1]}, folds=2)
    run_training(spark, train, run, small, fold_keys=("event_id",))
    run_evaluation(spark, f"{run}/model", test, evaluated, key=("event_id",))
    found = run_comparison(spark, {"Linear": base, "Forest": run, "Absent": f"{run}/none"}, {"Forest": evaluated})
    best = best_model(found["comparison"], "Linear").first()["model"]
    tops = found["top_features"].groupBy("model").agg(F.count("*").alias("top_features"))
    return found["comparison"].join(tops, "model", "left").select(
        "model", F.col("train_rows").cast("bigint").alias("train_rows"),
        F.col("test_rows").cast("bigint").alias("test_rows"),
        F.coalesce("top_features", F.lit(0)).cast("bigint").alias("top_features"),
        F.col("best_cv_rmse").isNotNull().alias("searched"), F.lit(best in ("Linear", "Forest")).alias("best_is_tested"))


# Small operators that had no query of their own.

_SAMPLE = 2_000


@query(f"""SELECT o_orderkey FROM orders WHERE
  CAST(concat('0x', substr(md5('sample|' || o_orderkey), 1, 8)) AS BIGINT) % 1000000
    < {_SAMPLE} * 1000000 // (SELECT count(*) FROM orders)""")
def sample_sink_by_key(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    path = scratch_path(spark, "key-sample")
    write_table(key_sample(orders, _SAMPLE, ["o_orderkey"], orders.count()), path)
    return read_table(spark, path)


@query(f"""SELECT CAST(i AS INTEGER) AS index, [{', '.join(f"'{c}_imputed'" for c in FEATURES_14)}][i + 1] AS column
  FROM range(0, {len(FEATURES_14)}) t(i)""")
def feature_list_table(spark, sf_dir):
    """Inputs of a plan over the columns that have values in the clean observations."""
    rows = clean(spark, sf_dir)
    return feature_list(rows, feature_plan(split_empty_columns(rows, FEATURES_14)[0]).inputs)


@query("""SELECT count(*) AS rows, 'AA1,AA2' AS precipitation_columns FROM events""")
def prefixed_columns(spark, sf_dir):
    rows = packed(spark, sf_dir)
    names = columns_with_prefix(rows, ("AA", "GA"))
    return rows.agg(F.count("*").alias("rows")).withColumn("precipitation_columns", F.lit(",".join(names)))


@query("SELECT event_type, count(*) AS rows, TRUE AS one_partition FROM events GROUP BY 1")
def spread_by_key(spark, sf_dir):
    parts = spread(load(spark, sf_dir, "events"), 5, "event_type").withColumn("part", F.spark_partition_id())
    return parts.groupBy("event_type").agg(
        F.count("*").alias("rows"), (F.count_distinct("part") == 1).alias("one_partition"))


@query(f"""SELECT event_id, {r("CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 5 = 0 THEN NULL ELSE value END", 'value')} FROM events""")
def malformed_numbers(spark, sf_dir):
    """Numbers as text: malformed text and NaN become NULL."""
    text = F.when(F.col("event_id") % 3 == 0, "12,5x").when(F.col("event_id") % 5 == 0, "NaN").otherwise(
        F.col("value").cast("string"))
    rows = load(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return rounded(clean_numbers(rows, ["value"]))
