"""Aggregates, profiles, splits and history features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barograph.operators.aggregate import (
    best_and_worst, count_by, errors_by_range, mean_baseline, partition_keys, preview,
    regression_metrics, split_ratio_report,
)
from barograph.operators.derive import with_calendar, with_errors
from barograph.operators.history import (
    HISTORY_COLUMNS, apply_station_stats, attach_history, fit_station_stats, history_features,
    hourly_series,
)
from barograph.operators.profile import (
    null_profile, null_report, profile, summary_stats, typed_null_profile,
)
from barograph.operators.quantile import exact_medians
from barograph.operators.split import (
    hash_split, random_split, sample_rows, split_parts, time_split, with_fold,
)
from workload.cleaning import GAPS, clean, decoded, features, with_gaps, GAPS_SQL
from workload.common import Registry, every, hash_bucket_sql, is_train_sql, load, r, rounded
from workload.packed import clean_sql

registry = Registry()
query = registry.query


@query(clean_sql() + f""", daily AS (SELECT event_id, year, month, day, temperature,
    {is_train_sql('event_id')} AS is_train FROM kept),
  fitted AS (SELECT avg(temperature) FILTER (WHERE is_train) AS m FROM daily)
  SELECT year, month, day, count(*) AS observations,
    {r('avg(temperature)', 'mean_temperature')},
    {r('sqrt(avg(pow(temperature - (SELECT m FROM fitted), 2)) FILTER (WHERE NOT is_train))', 'baseline_rmse')}
  FROM daily GROUP BY year, month, day""")
def daily_observations(spark, sf_dir):
    """Valid observations per day and how far the training mean is off on test rows.

    One pass: the mean squared distance of a day's test rows to the overall
    training mean follows from the day's own mean and variance. The window runs
    over the days only.
    """
    rows = hash_split(
        clean(spark, sf_dir).select("event_id", "year", "month", "day", "temperature"), ["event_id"])
    in_train = F.when(F.col("split") == "train", F.col("temperature"))
    in_test = F.when(F.col("split") == "test", F.col("temperature"))
    daily = rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("observations"), F.avg("temperature").alias("mean_temperature"),
        F.sum(in_train).alias("train_sum"), F.count(in_train).alias("train_rows"),
        F.avg(in_test).alias("test_mean"), F.var_pop(in_test).alias("test_variance"))
    all_days = Window.partitionBy(F.lit(0))
    overall = F.sum("train_sum").over(all_days) / F.sum("train_rows").over(all_days)
    distance = F.col("test_mean") - overall
    return rounded(daily.select(
        "year", "month", "day", "observations", "mean_temperature",
        F.sqrt(F.col("test_variance") + distance * distance).alias("baseline_rmse"),
    ).orderBy("year", "month", "day"))


@query("SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem "
       "UNION ALL SELECT 'orders', count(*) FROM orders "
       "UNION ALL SELECT 'events', count(*) FROM events")
def row_counts(spark, sf_dir):
    counted = None
    for name in ("lineitem", "orders", "events"):
        one = load(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        counted = one if counted is None else counted.unionByName(one)
    return counted


_STATS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS column_id, '{c}' AS "column", count({c}) AS count,
    CAST(0 AS BIGINT) AS nan_count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'stddev')},
    {r(f'min({c})', '"min"')}, {r(f'max({c})', '"max"')} FROM lineitem"""
    for i, c in enumerate(_STATS)))
def summary_statistics(spark, sf_dir):
    return rounded(summary_stats(load(spark, sf_dir, "lineitem"), list(_STATS)))


_NAN_VALUE = "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 9 = 0 THEN 'NaN'::DOUBLE ELSE value END"


def _with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(every("event_id", 4), None).when(every("event_id", 9), float("nan")).otherwise(
        F.col("value"))
    kind = F.when(~every("event_id", 6), F.col("event_type"))
    return load(spark, sf_dir, "events").select(
        "event_id", value.alias("value"), kind.alias("event_type"))


_WITH_NAN_SQL = f"""dirty AS (SELECT event_id, {_NAN_VALUE} AS value,
    CASE WHEN event_id % 6 <> 0 THEN event_type END AS event_type FROM events)"""


@query(f"""WITH {_WITH_NAN_SQL}
  SELECT CAST(0 AS INTEGER) AS column_id, 'value' AS "column",
    count(value) FILTER (WHERE NOT isnan(value)) AS count, count(*) FILTER (WHERE isnan(value)) AS nan_count,
    {r('avg(value) FILTER (WHERE NOT isnan(value))', 'mean')},
    {r('stddev_samp(value) FILTER (WHERE NOT isnan(value))', 'stddev')},
    {r('min(value) FILTER (WHERE NOT isnan(value))', '"min"')},
    {r('max(value) FILTER (WHERE NOT isnan(value))', '"max"')} FROM dirty""")
def summary_statistics_nan(spark, sf_dir):
    return rounded(summary_stats(_with_nan(spark, sf_dir), ["value"]))


_NULLABLE = ("temperature", "dew_point", "sea_level_pressure", "wind_speed", "wind_direction",
             "visibility", "precipitation", "latitude", "longitude")


def _null_sql(columns, source: str, condition="{c} IS NULL", where: str = "") -> str:
    return "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS column_id, '{c.strip('"')}' AS "column",
      count(*) FILTER (WHERE NOT ({condition.format(c=c)})) AS non_null_count,
      count(*) FILTER (WHERE {condition.format(c=c)}) AS null_count,
      {r(f'100.0 * count(*) FILTER (WHERE {condition.format(c=c)}) / count(*)', 'null_pct')} FROM {source}"""
        for i, c in enumerate(columns)) + ")" + where


@query(clean_sql() + " " + _null_sql(_NULLABLE, "kept"))
def null_counts(spark, sf_dir):
    return rounded(null_profile(clean(spark, sf_dir), list(_NULLABLE)))


@query(f"""WITH {_WITH_NAN_SQL}, flagged AS (SELECT event_id,
    CASE WHEN NOT isnan(value) THEN value END AS value, event_type FROM dirty) """
       + _null_sql(("event_id", "value", "event_type"), "flagged"))
def typed_null_counts(spark, sf_dir):
    return rounded(typed_null_profile(_with_nan(spark, sf_dir)))


_DECODED_NAMES = ("event_id", '"STATION"', "timestamp", "latitude", "longitude", "elevation",
                  "station_name", "temperature", "dew_point", "sea_level_pressure", "visibility",
                  "wind_direction", "wind_speed", "precipitation", "ceiling_height")


@query(clean_sql() + " " + _null_sql(_DECODED_NAMES, "decoded", where=" WHERE null_count > 0"))
def columns_with_nulls(spark, sf_dir):
    return rounded(null_report(decoded(spark, sf_dir)))


def _profile_sql(source: str, columns) -> str:
    lines = []
    for i, (name, dtype, kind) in enumerate(columns):
        value = f"CAST({name} AS DOUBLE)" if kind != "other" else "CAST(NULL AS DOUBLE)"
        if kind == "float":
            value = f"CASE WHEN NOT isnan({name}) THEN {name} END"
        nans = f"count(*) FILTER (WHERE isnan({name}))" if kind == "float" else "CAST(0 AS BIGINT)"
        lines.append(f"""SELECT CAST({i} AS INTEGER) AS column_id, '{name}' AS "column", '{dtype}' AS dtype,
      count(*) AS row_count, count(*) FILTER (WHERE {name} IS NULL) AS null_count, {nans} AS nan_count,
      {r(f'avg({value})', 'mean')}, {r(f'stddev_samp({value})', 'stddev')},
      {r(f'min({value})', '"min"')}, {r(f'max({value})', '"max"')} FROM {source}""")
    return " UNION ALL ".join(lines)


@query(f"WITH {_WITH_NAN_SQL} " + _profile_sql("dirty", (
    ("event_id", "bigint", "int"), ("value", "double", "float"), ("event_type", "string", "other"))))
def table_profile(spark, sf_dir):
    return rounded(profile(_with_nan(spark, sf_dir)))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(*) AS count FROM orders GROUP BY 1, 2""")
def monthly_counts(spark, sf_dir):
    orders = with_calendar(load(spark, sf_dir, "orders").select("o_orderdate"), "o_orderdate")
    return count_by(orders, "year", "month")


def _split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return hash_split(with_calendar(orders, "o_orderdate"), ["o_orderkey"])


_SPLIT_SQL = f"CASE WHEN {is_train_sql('o_orderkey')} THEN 'train' ELSE 'test' END"


@query(f"""SELECT {_SPLIT_SQL} AS split, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(*) AS count FROM orders GROUP BY 1, 2""")
def split_monthly_counts(spark, sf_dir):
    return count_by(_split_orders(spark, sf_dir), "split", "month")


@query(f"SELECT o_orderkey, {_SPLIT_SQL} AS split FROM orders")
def hash_split_rows(spark, sf_dir):
    return _split_orders(spark, sf_dir).select("o_orderkey", "split")


@query(f"""WITH parts AS (SELECT {_SPLIT_SQL} AS split, count(*) AS rows FROM orders GROUP BY 1)
  SELECT split, rows, CAST((SELECT sum(rows) FROM parts) AS BIGINT) AS total_rows,
    {r('100.0 * rows / (SELECT sum(rows) FROM parts)', 'share_pct')} FROM parts""")
def split_ratio(spark, sf_dir):
    return rounded(split_ratio_report(_split_orders(spark, sf_dir)))


@query(f"""WITH parts AS (SELECT CASE WHEN {hash_bucket_sql('o_orderkey')} < 80 THEN 'train' ELSE 'test' END AS split,
    o_totalprice FROM orders)
  SELECT split, count(*) AS rows, {r('avg(o_totalprice)', 'mean_price', 4)},
    {r('stddev_samp(o_totalprice)', 'stddev_price', 4)} FROM parts GROUP BY 1""")
def hash_split_80_20(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    parts = hash_split(orders, ["o_orderkey"], {"train": 80, "test": 20})
    return rounded(parts.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("o_totalprice").alias("mean_price"),
        F.stddev_samp("o_totalprice").alias("stddev_price")), digits=4)


@query(f"""SELECT o_orderkey, CAST(CAST(concat('0x', substr(md5(concat('fold|', CAST(o_orderkey AS VARCHAR))), 1, 8))
    AS BIGINT) % 3 AS INTEGER) AS fold FROM orders""")
def hash_folds(spark, sf_dir):
    return with_fold(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 3)


@query("""SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-10-01' THEN 'train' ELSE 'test' END AS split,
    CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS count FROM orders GROUP BY 1, 2""")
def time_split_counts(spark, sf_dir):
    orders = with_calendar(load(spark, sf_dir, "orders").select("o_orderdate"), "o_orderdate")
    return count_by(time_split(orders, "o_orderdate", "1998-10-01 00:00:00"), "split", "year")


def _near_share(count, total, share: float):
    """Whether a random part has its share of the rows within four standard deviations."""
    return F.abs(count - total * share) <= 4 * F.sqrt(total * share * (1 - share)) + 1


@query("SELECT count(*) AS rows, TRUE AS near_share, TRUE AS disjoint FROM orders")
def random_split_counts(spark, sf_dir):
    train, test = random_split(load(spark, sf_dir, "orders").select("o_orderkey"))
    parts = train.select("o_orderkey", F.lit("train").alias("split")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("split")))
    shares = split_ratio_report(parts)  # one row per part
    known = parts.agg(F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("keys"),
                      F.count_if(F.col("split") == "train").alias("train"))
    return known.crossJoin(shares.agg(F.count("*").alias("parts"))).select(
        "rows", _near_share(F.col("train"), F.col("rows"), 0.7).alias("near_share"),
        ((F.col("keys") == F.col("rows")) & (F.col("parts") == 2)).alias("disjoint"))


def _sample(spark: SparkSession, sf_dir: str, share: float) -> DataFrame:
    """The size of a sample held against its table's."""
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey")
    found = sample_rows(rows, share).agg(F.count("*").alias("n"))
    return found.crossJoin(rows.agg(F.count("*").alias("rows"))).select(
        "rows", _near_share(F.col("n"), F.col("rows"), share).alias("near_share"))


_SAMPLE_SQL = "SELECT count(*) AS rows, TRUE AS near_share FROM lineitem"


@query(_SAMPLE_SQL)
def sample_tenth(spark, sf_dir):
    return _sample(spark, sf_dir, 0.1)


@query(_SAMPLE_SQL)
def sample_hundredth(spark, sf_dir):
    return _sample(spark, sf_dir, 0.01)


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, "
       "CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def distinct_partition_keys(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderdate")
    return partition_keys(with_calendar(orders, "o_orderdate"), "year", "month")


@query("WITH " + GAPS_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median FROM gaps" for c in GAPS))
def column_medians(spark, sf_dir):
    found = exact_medians(with_gaps(load(spark, sf_dir, "lineitem")), list(GAPS))
    return spark.createDataFrame(list(found.items()), "column string, median double")


@query(f"""WITH fitted AS (SELECT l_quantity AS y, {is_train_sql('l_orderkey')} AS is_train FROM lineitem),
  m AS (SELECT avg(y) FILTER (WHERE is_train) AS train_mean FROM fitted)
  SELECT {r('(SELECT train_mean FROM m)', 'train_mean')},
    count(*) FILTER (WHERE is_train) AS train_rows, count(*) FILTER (WHERE NOT is_train) AS test_rows,
    {r('sqrt(avg(pow(y - (SELECT train_mean FROM m), 2)) FILTER (WHERE NOT is_train))', 'baseline_rmse')}
  FROM fitted""")
def mean_baseline_rmse(spark, sf_dir):
    rows = hash_split(
        load(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias("label")),
        ["l_orderkey"])
    return rounded(mean_baseline(rows, F.col("split") == "train"))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label in -10...45 and a closed-form prediction."""
    label = F.col("o_totalprice") / 10000.0 - 10.0
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", label.alias("label"),
        (label * 0.9 + (F.col("o_custkey") % 11) - 4.0).alias("prediction"))


_PREDICTED_SQL = """predicted AS (SELECT o_orderkey, o_orderpriority, o_totalprice / 10000.0 - 10.0 AS label,
    (o_totalprice / 10000.0 - 10.0) * 0.9 + (o_custkey % 11) - 4.0 AS prediction FROM orders),
  errors AS (SELECT *, label - prediction AS error, abs(label - prediction) AS abs_error,
    pow(label - prediction, 2) AS squared_error FROM predicted)"""

_METRICS_SQL = (f"{r('sqrt(avg(squared_error))', 'rmse')}, "
                f"{r('1 - avg(squared_error) / var_pop(label)', 'r2')}, "
                f"{r('avg(abs_error)', 'mae')}, {r('avg(squared_error)', 'mse')}, count(*) AS rows")


@query(f"WITH {_PREDICTED_SQL} SELECT {_METRICS_SQL} FROM errors")
def regression_measures(spark, sf_dir):
    return rounded(regression_metrics(_predicted(spark, sf_dir)))


@query(f"WITH {_PREDICTED_SQL} SELECT o_orderpriority, {_METRICS_SQL} FROM errors GROUP BY 1")
def regression_measures_by_group(spark, sf_dir):
    return rounded(regression_metrics(_predicted(spark, sf_dir), "o_orderpriority"))


# Labels and predictions have up to seven decimals: eight digits keep them exact.
_ERRORS = ("label", "prediction", "error", "abs_error", "squared_error")


@query(f"""WITH {_PREDICTED_SQL} SELECT o_orderkey, {', '.join(r(c, digits=8) for c in _ERRORS)}
  FROM errors""")
def error_columns(spark, sf_dir):
    return rounded(with_errors(_predicted(spark, sf_dir).drop("o_orderpriority")), digits=8)


@query(f"""WITH {_PREDICTED_SQL}, ranged AS (SELECT *,
    CASE WHEN label < 0 THEN 0 WHEN label < 10 THEN 1 WHEN label < 20 THEN 2 WHEN label < 30 THEN 3 ELSE 4 END AS range_id
    FROM errors)
  SELECT CAST(range_id AS INTEGER) AS range_id,
    CASE range_id WHEN 0 THEN 'Below 0°C' WHEN 1 THEN '0-10°C' WHEN 2 THEN '10-20°C'
      WHEN 3 THEN '20-30°C' ELSE 'Above 30°C' END AS temp_range,
    count(*) AS count, {r('avg(abs_error)', 'mean_abs_error')},
    {r('avg(squared_error)', 'mean_squared_error')} FROM ranged GROUP BY 1, 2""")
def error_by_range(spark, sf_dir):
    return rounded(errors_by_range(_predicted(spark, sf_dir)))


@query(f"""WITH {_PREDICTED_SQL},
  best AS (SELECT * FROM errors ORDER BY abs_error, o_orderkey LIMIT 10),
  worst AS (SELECT * FROM errors ORDER BY abs_error DESC, o_orderkey LIMIT 10)
  SELECT 'best' AS kind, o_orderkey, {r('label', digits=8)}, {r('prediction', digits=8)},
    {r('abs_error', digits=8)} FROM best
  UNION ALL SELECT 'worst', o_orderkey, {r('label', digits=8)}, {r('prediction', digits=8)},
    {r('abs_error', digits=8)} FROM worst""")
def best_worst_errors(spark, sf_dir):
    return rounded(best_and_worst(_predicted(spark, sf_dir), "o_orderkey"), digits=8)


@query(clean_sql() + f""" SELECT {r('temperature')}, {r('dew_point')}, {r('wind_speed')}, hour, month
  FROM kept ORDER BY event_id LIMIT 10""")
def first_rows(spark, sf_dir):
    return rounded(preview(
        clean(spark, sf_dir), ["temperature", "dew_point", "wind_speed", "hour", "month"],
        order_by=["event_id"]))


_HOURLY_SQL = """hourly AS (SELECT user_id, CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS hour_epoch,
    avg(value) AS temperature, avg(value * 2 + event_id % 7) AS sea_level_pressure
  FROM events GROUP BY 1, 2)"""


def _frame(k: int) -> str:
    return (f"OVER (PARTITION BY user_id ORDER BY hour_epoch "
            f"RANGE BETWEEN {3600 * k} PRECEDING AND {3600 * k} PRECEDING)")


_HISTORY_SQL = f"""history AS (SELECT *,
    max(temperature) {_frame(1)} AS temp_lag_1h, max(temperature) {_frame(2)} AS temp_lag_2h,
    max(temperature) {_frame(3)} AS temp_lag_3h, max(sea_level_pressure) {_frame(1)} AS pressure_lag_1h,
    avg(temperature) OVER (PARTITION BY user_id ORDER BY hour_epoch
      RANGE BETWEEN 10800 PRECEDING AND 1 PRECEDING) AS temp_rolling_3h,
    max(temperature) {_frame(1)} - max(temperature) {_frame(2)} AS temp_change_1h FROM hourly)"""


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.col("value").alias("temperature"),
        (F.col("value") * 2 + F.col("event_id") % 7).alias("sea_level_pressure"))


def _history(stations: DataFrame) -> DataFrame:
    hourly = hourly_series(stations, "user_id", "ts", ["temperature", "sea_level_pressure"])
    return history_features(hourly, "user_id")


@query(f"""WITH {_HOURLY_SQL}, {_HISTORY_SQL} SELECT user_id, hour_epoch, {r('temperature')},
    {r('sea_level_pressure')}, {', '.join(r(c) for c in HISTORY_COLUMNS)} FROM history""")
def station_history(spark, sf_dir):
    return rounded(_history(_stations(spark, sf_dir)))


@query(f"""WITH {_HOURLY_SQL}, {_HISTORY_SQL}
  SELECT e.event_id, {', '.join(r(f'h.{c}', c) for c in HISTORY_COLUMNS)}
  FROM events e LEFT JOIN history h ON e.user_id = h.user_id
    AND CAST(floor(epoch(e.ts) / 3600) * 3600 AS BIGINT) = h.hour_epoch""")
def observation_history(spark, sf_dir):
    stations = _stations(spark, sf_dir)
    attached = attach_history(stations, _history(stations), "user_id", "ts")
    return rounded(attached.select("event_id", *HISTORY_COLUMNS))


@query(f"""WITH fitted AS (SELECT user_id, avg(value) AS station_avg_temp,
    avg(value * 2 + event_id % 7) AS station_avg_pressure
    FROM events WHERE {is_train_sql('event_id')} GROUP BY 1)
  SELECT e.event_id, {r('station_avg_temp')}, {r('station_avg_pressure')}
  FROM events e LEFT JOIN fitted f ON e.user_id = f.user_id""")
def station_averages(spark, sf_dir):
    stations = _stations(spark, sf_dir)
    train, _ = split_parts(hash_split(stations, ["event_id"]))
    stats = fit_station_stats(train, "user_id", {
        "temperature": "station_avg_temp", "sea_level_pressure": "station_avg_pressure"})
    applied = apply_station_stats(stations, stats, "user_id")
    return rounded(applied.select("event_id", "station_avg_temp", "station_avg_pressure"))
