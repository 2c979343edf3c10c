"""Feature pipelines, models and their comparison."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.functions.derived import nan_to_null
from barograph.operators.aggregate import (
    cv_summary, errors_by_range, mean_baseline, regression_metrics, top_k,
)
from barograph.operators.compare import (
    best_model, compare_models, pairwise_deltas, top_features,
)
from barograph.operators.derive import FEATURES_14, with_errors
from barograph.operators.features import feature_plan, with_imputed
from barograph.operators.learn import (
    baseline_linear, boosted, coefficient_table, cv_table, forest, grid_search, importance_table,
    linear, rows_table, training_row,
)
from barograph.operators.moments import Line, fit_line, linear_moments
from barograph.operators.presets import PRESETS, Preset
from barograph.operators.quality import complete_cases, fit_median_fill
from barograph.operators.split import hash_split, split_parts, with_fold
from barograph.session import persisted
from workload.cleaning import GAPS, GAPS_SQL, clean, with_gaps
from workload.common import Registry, every, hash_bucket_sql, is_train_sql, load, r, rounded, stored
from workload.packed import clean_sql

registry = Registry()
query = registry.query


@query(f"""WITH {GAPS_SQL} SELECT l_orderkey, l_linenumber,
  {', '.join(r(c) for c in GAPS)}, {', '.join(
      r(f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM gaps))", f'{c}_imputed') for c in GAPS)}
  FROM gaps""")
def impute_median(spark, sf_dir):
    gaps = with_gaps(load(spark, sf_dir, "lineitem"))
    medians = fit_median_fill(gaps, list(GAPS), relative_error=None)
    return rounded(with_imputed(gaps, medians))


_VECTOR = ("dew_point", "visibility", "wind_speed", "precipitation")


@query(clean_sql() + f" SELECT event_id, CAST(4 AS INTEGER) AS slots, {', '.join(r(c) for c in _VECTOR)} FROM kept")
def assemble_vectors(spark, sf_dir):
    assembler = VectorAssembler(inputCols=list(_VECTOR), outputCol="features", handleInvalid="keep")
    vectors = assembler.transform(clean(spark, sf_dir)).select(
        "event_id", vector_to_array("features").alias("values"))
    return rounded(vectors.select(
        "event_id", F.size("values").alias("slots"),
        *[nan_to_null(F.get("values", F.lit(i))).alias(name) for i, name in enumerate(_VECTOR)]))


_TYPED_SQL = """typed AS (SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS kind FROM part),
  ranked AS (SELECT kind, row_number() OVER (ORDER BY count(*) DESC, kind) - 1 AS idx
    FROM typed WHERE kind IS NOT NULL GROUP BY kind)"""


def _typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(~every("p_partkey", 10), F.col("p_type"))
    return load(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"))


@query(f"""WITH {_TYPED_SQL} SELECT p_partkey, t.kind,
    CAST(coalesce(idx, (SELECT count(*) FROM ranked)) AS DOUBLE) AS kind_idx
  FROM typed t LEFT JOIN ranked ON t.kind = ranked.kind""")
def category_index(spark, sf_dir):
    parts = _typed_parts(spark, sf_dir)
    indexer = StringIndexer(inputCol="kind", outputCol="kind_idx", handleInvalid="keep")
    return indexer.fit(parts).transform(parts)


@query(f"""WITH {_TYPED_SQL} SELECT p_partkey,
    CAST(coalesce(idx, (SELECT count(*) FROM ranked)) AS INTEGER) AS slot, CAST(1 AS DOUBLE) AS total,
    CAST((SELECT count(*) FROM ranked) + 1 AS INTEGER) AS slots
  FROM typed t LEFT JOIN ranked ON t.kind = ranked.kind""")
def one_hot_slots(spark, sf_dir):
    parts = _typed_parts(spark, sf_dir)
    stages = [
        StringIndexer(inputCols=["kind"], outputCols=["kind_idx"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["kind_idx"], outputCols=["kind_oh"], handleInvalid="keep"),
    ]
    encoded = Pipeline(stages=stages).fit(parts).transform(parts)
    values = encoded.select("p_partkey", vector_to_array("kind_oh").alias("v"))
    return values.select(
        "p_partkey", (F.array_position("v", F.lit(1.0)) - 1).cast("int").alias("slot"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"), F.size("v").alias("slots"))


@query(f"""SELECT l_orderkey, l_linenumber,
    {r('l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem)', 'quantity_scaled')},
    {r('l_discount / (SELECT stddev_samp(l_discount) FROM lineitem)', 'discount_scaled')} FROM lineitem""")
def standard_scale(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    assembler = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features_raw")
    scaler = StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=False, withStd=True)
    scaled = Pipeline(stages=[assembler, scaler]).fit(rows).transform(rows)
    values = scaled.withColumn("v", vector_to_array("features"))
    return rounded(values.select(
        "l_orderkey", "l_linenumber",
        F.get("v", F.lit(0)).alias("quantity_scaled"), F.get("v", F.lit(1)).alias("discount_scaled")))


def _ridge_sql(source: str, x1: str, x2: str, y: str, penalty: float, where: str = "TRUE") -> str:
    """SQL CTEs ``fit1`` (x1 only) and ``fit2`` (x1, x2): ridge coefficients in closed form.

    The penalty acts on standardised columns, as in Spark's linear regression.
    """
    return f"""moments AS (SELECT avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
    var_pop({x1}) * (1 + {penalty} / stddev_pop({y})) AS v1,
    var_pop({x2}) * (1 + {penalty} / stddev_pop({y})) AS v2,
    covar_pop({x1}, {x2}) AS v12, covar_pop({x1}, {y}) AS c1, covar_pop({x2}, {y}) AS c2
    FROM {source} WHERE {where}),
  fit1 AS (SELECT c1 / v1 AS b1, my - c1 / v1 * m1 AS b0, my FROM moments),
  slopes AS (SELECT (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1,
    (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2, m1, m2, my FROM moments),
  fit2 AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM slopes)"""


_ITEMS_SQL = "items AS (SELECT l_orderkey, l_quantity, l_discount, l_extendedprice / 1000 AS label FROM lineitem)"
_TERMS_SQL = f"""SELECT 'l_quantity' AS term, {r('b1', 'coefficient')} FROM fit2
  UNION ALL SELECT 'l_discount', {r('b2', 'coefficient')} FROM fit2
  UNION ALL SELECT 'intercept', {r('b0', 'coefficient')} FROM fit2"""


def _fit_items(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_discount", (F.col("l_extendedprice") / 1000).alias("label"))
    plan = feature_plan(["l_quantity", "l_discount"], impute=(), handle_invalid="error")
    model = Pipeline(stages=[*plan.stages, estimator]).fit(rows)
    return rounded(coefficient_table(rows, model.stages[-1], plan.inputs))


@query(f"WITH {_ITEMS_SQL}, {_ridge_sql('items', 'l_quantity', 'l_discount', 'label', 0.1)} {_TERMS_SQL}")
def lr_baseline_coefficients(spark, sf_dir):
    return _fit_items(spark, sf_dir, baseline_linear())


@query(f"WITH {_ITEMS_SQL}, {_ridge_sql('items', 'l_quantity', 'l_discount', 'label', 0.0)} {_TERMS_SQL}")
def lr_default_coefficients(spark, sf_dir):
    return _fit_items(spark, sf_dir, linear())


WEATHER = ["dew_point", "wind_speed"]
WEATHER_SQL = f"""weather AS (SELECT event_id, dew_point, wind_speed, temperature AS label,
    {is_train_sql('event_id')} AS is_train FROM kept WHERE dew_point IS NOT NULL AND wind_speed IS NOT NULL),
  {_ridge_sql('weather', 'dew_point', 'wind_speed', 'label', 0.1, 'is_train')},
  scored AS (
    SELECT 'mean' AS model, event_id, is_train, label, (SELECT my FROM fit1) AS prediction FROM weather
    UNION ALL SELECT 'linear_one', event_id, is_train, label,
      (SELECT b0 FROM fit1) + (SELECT b1 FROM fit1) * dew_point FROM weather
    UNION ALL SELECT 'linear_two', event_id, is_train, label, (SELECT b0 FROM fit2)
      + (SELECT b1 FROM fit2) * dew_point + (SELECT b2 FROM fit2) * wind_speed FROM weather),
  measured AS (SELECT model, is_train, count(*) AS rows,
    sqrt(avg(pow(label - prediction, 2))) AS rmse,
    1 - avg(pow(label - prediction, 2)) / var_pop(label) AS r2,
    avg(abs(label - prediction)) AS mae, avg(pow(label - prediction, 2)) AS mse
    FROM scored GROUP BY 1, 2),
  comparison AS (SELECT a.model, a.rows AS train_rows, a.rmse AS train_rmse, a.r2 AS train_r2,
    a.mae AS train_mae, CAST(NULL AS DOUBLE) AS best_cv_rmse, b.rmse AS test_rmse, b.r2 AS test_r2,
    b.mae AS test_mae, b.rows AS test_rows
    FROM measured a JOIN measured b ON a.model = b.model AND a.is_train AND NOT b.is_train)"""


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir).select(
        "event_id", *WEATHER, F.col("temperature").alias("label"))
    return stored(hash_split(complete_cases(rows, WEATHER), ["event_id"]), "weather")


def fit_weather(train: DataFrame, features: list[str]):
    plan = feature_plan(features, impute=(), handle_invalid="error")
    return Pipeline(stages=[*plan.stages, baseline_linear()]).fit(train)


@query(clean_sql(WEATHER_SQL) + f""" SELECT {r('rmse', 'test_rmse')}, {r('r2', 'test_r2')},
    {r('mae', 'test_mae')}, {r('mse', 'test_mse')}, rows AS test_rows
  FROM measured WHERE model = 'linear_two' AND NOT is_train""")
def evaluate_linear(spark, sf_dir):
    train, test = split_parts(weather_rows(spark, sf_dir))
    scored = fit_weather(train, WEATHER).transform(test)
    return rounded(regression_metrics(scored).select(
        F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"),
        F.col("mae").alias("test_mae"), F.col("mse").alias("test_mse"),
        F.col("rows").alias("test_rows")))


@query(clean_sql(WEATHER_SQL) + f""" SELECT event_id, {r('label', digits=4)}, {r('prediction', digits=4)},
    {r('label - prediction', 'error', 4)}, {r('abs(label - prediction)', 'abs_error', 4)}
  FROM scored WHERE model = 'linear_two' AND NOT is_train""")
def score_test_rows(spark, sf_dir):
    train, test = split_parts(weather_rows(spark, sf_dir))
    scored = with_errors(fit_weather(train, WEATHER).transform(test))
    return rounded(scored.select("event_id", "label", "prediction", "error", "abs_error"), digits=4)


@query(clean_sql(WEATHER_SQL) + f""", ranged AS (SELECT label - prediction AS error,
    CASE WHEN label < 0 THEN 0 WHEN label < 10 THEN 1 WHEN label < 20 THEN 2 WHEN label < 30 THEN 3 ELSE 4 END AS range_id
    FROM scored WHERE model = 'linear_two' AND NOT is_train)
  SELECT CAST(range_id AS INTEGER) AS range_id,
    CASE range_id WHEN 0 THEN 'Below 0°C' WHEN 1 THEN '0-10°C' WHEN 2 THEN '10-20°C'
      WHEN 3 THEN '20-30°C' ELSE 'Above 30°C' END AS temp_range, count(*) AS count,
    {r('avg(abs(error))', 'mean_abs_error')}, {r('avg(error * error)', 'mean_squared_error')}
  FROM ranged GROUP BY 1, 2""")
def evaluate_linear_by_range(spark, sf_dir):
    train, test = split_parts(weather_rows(spark, sf_dir))
    return rounded(errors_by_range(fit_weather(train, WEATHER).transform(test)))


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models of the same split: training mean, one feature, two features.

    One scan gives the statistics all three are fitted from, another all their measures.
    """
    rows = weather_rows(spark, sf_dir)
    train = linear_moments(rows, WEATHER, by="split").total(["train"])
    fitted = {
        "mean": (Line(np.zeros(0), float(train.mean[-1])), []),
        "linear_one": (fit_line(train.of([0]), 0.1), WEATHER[:1]),
        "linear_two": (fit_line(train, 0.1), WEATHER),
    }
    scored = rows.select("split", "label", F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), line.prediction(features).alias("prediction"))
        for name, (line, features) in fitted.items()])))
    # A handful of rows, written once: what follows reads them several times.
    measured = stored(regression_metrics(scored, "model", "split"), "measured")

    def part(name: str) -> DataFrame:
        return measured.where(F.col("split") == name).select("model", *[
            F.col(c).alias(f"{name}_{c}") for c in ("rows", "rmse", "r2", "mae")])

    return compare_models(part("train"), part("test"))


@query(clean_sql(WEATHER_SQL) + f""" SELECT model, train_rows, {r('train_rmse')}, {r('train_r2')},
    {r('train_mae')}, best_cv_rmse, {r('test_rmse')}, {r('test_r2')}, {r('test_mae')}, test_rows
  FROM comparison""")
def model_comparison(spark, sf_dir):
    return rounded(_comparison(spark, sf_dir))


@query(clean_sql(WEATHER_SQL) + f""", base AS (SELECT test_rmse AS baseline_rmse FROM comparison WHERE model = 'mean')
  SELECT model, {r('test_rmse')}, {r('test_r2')}, {r('test_mae')}, {r('baseline_rmse')},
    {r('(baseline_rmse - test_rmse) * 100 / baseline_rmse', 'improvement_pct')}
  FROM comparison, base ORDER BY comparison.test_rmse, model LIMIT 1""")
def best_test_model(spark, sf_dir):
    return rounded(best_model(_comparison(spark, sf_dir), "mean"))


@query(clean_sql(WEATHER_SQL) + f""" SELECT a.model AS model_a, b.model AS model_b,
    {r('a.train_rmse', 'value_a')}, {r('b.train_rmse', 'value_b')},
    {r('abs(a.train_rmse - b.train_rmse)', 'difference')},
    {r('(a.train_rmse - b.train_rmse) * 100 / a.train_rmse', 'change_pct')}
  FROM comparison a JOIN comparison b ON (a.model, b.model) IN (('mean', 'linear_two'), ('linear_one', 'linear_two'))""")
def model_deltas(spark, sf_dir):
    pairs = [("mean", "linear_two"), ("linear_one", "linear_two")]
    return rounded(pairwise_deltas(_comparison(spark, sf_dir), pairs, "train_rmse"))


_RANKED = ("dew_point", "sea_level_pressure", "visibility", "wind_speed", "precipitation",
           "latitude", "longitude", "hour_cos")


@query(clean_sql() + ", importances AS (" + " UNION ALL ".join(
    f"SELECT report_type AS model, '{c}' AS feature, abs(corr(temperature, {c})) AS importance "
    f"FROM kept JOIN (SELECT event_id AS id, event_type AS report_type FROM events) ON id = event_id GROUP BY 1"
    for c in _RANKED) + f""")
  SELECT * FROM (SELECT model, feature, {r('importance')}, CAST(row_number() OVER (
    PARTITION BY model ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM importances) WHERE rank <= 5""")
def top_five_features(spark, sf_dir):
    """Five features most correlated with temperature, per report type."""
    rows = clean(spark, sf_dir, "REPORT_TYPE").withColumnRenamed("REPORT_TYPE", "model")
    table = rows.groupBy("model").agg(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.abs(F.corr("temperature", c)).alias("importance"))
        for c in _RANKED]).alias("lines"))
    return rounded(top_features(table.select("model", F.inline("lines")), 5))


def _model_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Clean observations with 14 features."""
    return stored(clean(spark, sf_dir, *keep).select(
        "event_id", *keep, *FEATURES_14, F.col("temperature").alias("label")), "features")


def _search(spark: SparkSession, sf_dir: str, preset: Preset):
    data = with_fold(_model_rows(spark, sf_dir), ["event_id"], preset.fold_count)
    with persisted(data):
        return data, grid_search(data, feature_plan(FEATURES_14), preset, "fold")


def _grid_sql(columns: str, *points: str) -> str:
    """SQL: the grid points of a search, each with a plausible score."""
    return f"SELECT *, TRUE AS plausible FROM (VALUES {', '.join(points)}) AS t({columns})"


def _held_against_constant(data: DataFrame, table: DataFrame, score: str = "cv_rmse") -> DataFrame:
    """The grid with each score held against the deviation of the label, the error of its mean.

    Deep trees may do a little worse than the mean where the features tell nothing.
    """
    spread = data.agg(F.stddev_pop("label")).first()[0]
    return table.withColumn("plausible", F.col(score).between(1e-9, spread * 1.2)).drop(score)


@query(_grid_sql('"numTrees", "maxDepth", "minInstancesPerNode"', *[
    f"(CAST({n} AS INTEGER), CAST({d} AS INTEGER), CAST(1 AS INTEGER))" for n in (10, 20) for d in (5, 10)]))
def rf_cv_results(spark, sf_dir):
    data, search = _search(spark, sf_dir, PRESETS["rf-test"])
    return _held_against_constant(data, cv_table(data, search))


@query(_grid_sql('"maxIter", "maxDepth", "stepSize"', *[
    f"(CAST({n} AS INTEGER), CAST(3 AS INTEGER), CAST(0.1 AS DOUBLE))" for n in (5, 10)]))
def gbt_cv_results(spark, sf_dir):
    grid = {"maxIter": [5, 10], "maxDepth": [3], "stepSize": [0.1]}
    data, search = _search(spark, sf_dir, Preset("gbt", grid, folds=2))
    return _held_against_constant(data, cv_table(data, search))


@query(_grid_sql('"maxIter", "maxDepth", "stepSize"', *[
    f"(CAST(5 AS INTEGER), CAST({d} AS INTEGER), CAST(0.1 AS DOUBLE))" for d in (2, 3)]))
def gbt_single_split_results(spark, sf_dir):
    grid = {"maxIter": [5], "maxDepth": [2, 3], "stepSize": [0.1]}
    data, search = _search(
        spark, sf_dir, Preset("gbt", grid, train_ratio=0.8, fixed={"subsamplingRate": 0.8}))
    return _held_against_constant(data, cv_table(data, search, "rmse"), "rmse")


@query("SELECT TRUE AS ordered, TRUE AS positive")
def cv_score_summary(spark, sf_dir):
    grid = {"numTrees": [5, 10], "maxDepth": [4], "minInstancesPerNode": [1]}
    found = cv_summary(cv_table(*_search(spark, sf_dir, Preset("rf", grid, folds=2))))
    return found.select(
        (F.col("mean_cv_rmse").between(F.col("best_cv_rmse"), F.col("worst_cv_rmse"))).alias("ordered"),
        (F.col("best_cv_rmse") > 0).alias("positive"))


@query(clean_sql() + """ SELECT 'RandomForest' AS model, count(*) AS train_rows, CAST(1 AS DOUBLE) AS fraction,
  CAST(10 AS INTEGER) AS num_trees, CAST(5 AS INTEGER) AS max_depth, TRUE AS fits, TRUE AS took_time FROM kept""")
def rf_training_metrics(spark, sf_dir):
    data = with_fold(_model_rows(spark, sf_dir), ["event_id"], 2)
    preset = Preset("rf", {"numTrees": [10], "maxDepth": [5], "minInstancesPerNode": [1]}, folds=2)
    with persisted(data):
        search = grid_search(data, feature_plan(FEATURES_14), preset, "fold")
        metrics = regression_metrics(search.model.transform(data)).first()
    row = training_row(search, "rf-one-point", "rf", metrics["rows"], metrics)
    return rows_table(spark, [row]).select(
        "model", "train_rows", "fraction", F.col("num_trees").cast("int").alias("num_trees"),
        F.col("max_depth").cast("int").alias("max_depth"),
        ((F.col("train_r2") > 0) & (F.col("train_mae") <= F.col("train_rmse"))).alias("fits"),
        (F.col("training_seconds") > 0).alias("took_time"))


def _importances(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    data = _model_rows(spark, sf_dir)
    plan = feature_plan(FEATURES_14)
    with persisted(data):
        model = Pipeline(stages=[*plan.stages, estimator]).fit(data)
    table = importance_table(data, model.stages[-1], plan.inputs)
    total = table.agg(F.sum("importance"), F.min("importance")).first()
    return top_k(table, "importance", "feature_index", 10).agg(
        F.count("*").alias("listed"), F.lit(abs(total[0] - 1) < 1e-9 and total[1] >= 0).alias("shares"),
        (F.count_distinct("feature") == 10).alias("distinct_features"))


_IMPORTANCES_SQL = "SELECT CAST(10 AS BIGINT) AS listed, TRUE AS shares, TRUE AS distinct_features"


@query(_IMPORTANCES_SQL)
def rf_feature_importances(spark, sf_dir):
    return _importances(spark, sf_dir, forest(numTrees=20, maxDepth=5))


@query(_IMPORTANCES_SQL)
def gbt_feature_importances(spark, sf_dir):
    return _importances(spark, sf_dir, boosted(maxIter=10, maxDepth=3))


def _test_metrics(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    """Test metrics of a model next to the predict-the-mean baseline."""
    rows = hash_split(_model_rows(spark, sf_dir), ["event_id"])
    train, test = split_parts(rows)
    with persisted(train):
        model = Pipeline(stages=[*feature_plan(FEATURES_14).stages, estimator]).fit(train)
    baseline = mean_baseline(rows, F.col("split") == "train").first()["baseline_rmse"]
    found = regression_metrics(model.transform(test))
    return found.select("rows", (F.col("rmse") < baseline).alias("below_baseline"),
                        (F.abs(F.col("mse") - F.col("rmse") * F.col("rmse")) < 1e-6).alias("consistent"))


_TEST_SQL = clean_sql() + f""" SELECT count(*) AS rows, TRUE AS below_baseline, TRUE AS consistent FROM kept
  WHERE NOT {is_train_sql('event_id')}"""


@query(_TEST_SQL)
def rf_test_metrics(spark, sf_dir):
    return _test_metrics(spark, sf_dir, forest(numTrees=20, maxDepth=5))


@query(_TEST_SQL)
def gbt_test_metrics(spark, sf_dir):
    return _test_metrics(spark, sf_dir, boosted(maxIter=10, maxDepth=3))


@query(_TEST_SQL)
def lr_imputed_test_metrics(spark, sf_dir):
    return _test_metrics(spark, sf_dir, baseline_linear())


@query(clean_sql() + f""" SELECT count(*) AS rows, TRUE AS explains FROM kept
  WHERE NOT {hash_bucket_sql('event_id')} < 80""")
def encoded_feature_pipeline(spark, sf_dir):
    """Imputed, encoded and scaled features with a default linear model."""
    rows = hash_split(
        _model_rows(spark, sf_dir, "REPORT_TYPE"), ["event_id"], {"train": 80, "test": 20})
    train, test = split_parts(rows)
    plan = feature_plan(FEATURES_14, ["REPORT_TYPE"], suffix="_imp", scale=True)
    model = Pipeline(stages=[*plan.stages, linear()]).fit(train)
    return regression_metrics(model.transform(test)).select("rows", (F.col("r2") > 0).alias("explains"))


_ITEM_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with gaps in two features; the label is the price in thousands."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(key % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 5 != 0, F.col("l_discount")).alias("l_discount"), "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_extendedprice") / 1000).alias("label"))


def _search_items(spark: SparkSession, sf_dir: str, preset: Preset) -> DataFrame:
    data = with_fold(_items(spark, sf_dir), ["l_orderkey"], preset.fold_count)
    search = grid_search(data, feature_plan(_ITEM_FEATURES), preset, "fold", keep=True)
    score = "cv_rmse" if preset.train_ratio is None else "rmse"
    return _held_against_constant(data, cv_table(data, search, score), score)


@query("SELECT count(*) AS rows, TRUE AS below_constant, TRUE AS consistent FROM lineitem")
def lr_lineitem_metrics(spark, sf_dir):
    data = _items(spark, sf_dir).hint("rebalance")
    with persisted(data):
        model = Pipeline(stages=[*feature_plan(_ITEM_FEATURES).stages, baseline_linear()]).fit(data)
        row = regression_metrics(model.transform(data)).first()
        spread = data.agg(F.stddev_pop("label")).first()[0]
    return rows_table(spark, [{
        "rows": row["rows"], "below_constant": row["rmse"] < spread,
        "consistent": abs(1 - row["mse"] / spread ** 2 - row["r2"]) < 1e-9}])


@query(_grid_sql('"numTrees", "maxDepth", "minInstancesPerNode"', *[
    f"(CAST({n} AS INTEGER), CAST({d} AS INTEGER), CAST(1 AS INTEGER))" for n in (10, 20) for d in (5, 10)]))
def rf_lineitem_cv_results(spark, sf_dir):
    return _search_items(spark, sf_dir, PRESETS["rf-test"])


@query(_grid_sql('"maxIter", "maxDepth", "stepSize"', *[
    f"(CAST(10 AS INTEGER), CAST({d} AS INTEGER), CAST(0.1 AS DOUBLE))" for d in (2, 3)]))
def gbt_lineitem_single_split(spark, sf_dir):
    grid = {"maxIter": [10], "maxDepth": [2, 3], "stepSize": [0.1]}
    return _search_items(spark, sf_dir, Preset("gbt", grid, train_ratio=0.8))
