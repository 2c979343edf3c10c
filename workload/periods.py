"""Profiles by period, searches in time and samples of an exact size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.derive import with_calendar
from barograph.operators.features import feature_plan
from barograph.operators.learn import cv_table, grid_search
from barograph.operators.presets import Preset
from barograph.operators.sketches import (
    merge_sketches, profile_sketches, read_profile, sketch_statistics, update_profile,
)
from barograph.operators.split import hash_split, with_period
from barograph.session import persisted, scratch_path
from barograph.sources.tables import exact_sample, read_table, write_sample
from workload.cleaning import clean
from workload.common import Registry, every, is_train_sql, load, r, rounded, stored
from workload.learning import WEATHER
from workload.models import _PENALTIES, _RMSE, _cut_value, _ridge_value, _stump_sql
from workload.packed import clean_sql

registry = Registry()
query = registry.query


# Profiles from sketches by year and month.

_DIRTY_SQL = f"""dirty AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice / 1000 END AS price,
    CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS status, {is_train_sql('o_orderkey')} AS is_train FROM orders)"""
_SHOWN = ("null_pct", "mean", "stddev", "min", "max", "median")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(every("o_orderkey", 7), None).when(every("o_orderkey", 11), float("nan")).otherwise(F.col("o_totalprice") / 1000)
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", price.alias("price"), F.when(~every("o_orderkey", 6), F.col("o_orderstatus")).alias("status"))
    return with_calendar(rows, "o_orderdate").select("o_orderkey", "year", "month", "price", "status")


def _statistics_sql(by: str, source: str = "dirty") -> str:
    number = "price) FILTER (WHERE NOT isnan(price))"
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""SELECT {lead}'price' AS "column", count(*) AS rows, count(*) - count(price) AS null_count,
    count(*) FILTER (WHERE isnan(price)) AS nan_count, {r('100.0 * (count(*) - count(price)) / count(*)', 'null_pct')},
    {r(f'avg({number}', 'mean')}, {r(f'stddev_samp({number}', 'stddev')}, {r(f'min({number}', '"min"')}, {r(f'max({number}', '"max"')},
    {r('quantile_disc(price, 0.5) FILTER (WHERE NOT isnan(price))', 'median')} FROM {source}{group}
  UNION ALL SELECT {lead}'status', count(*), count(*) - count(status), 0, {r('100.0 * (count(*) - count(status)) / count(*)', 'null_pct')},
    NULL, NULL, NULL, NULL, NULL FROM {source}{group}"""


def _shown(merged: DataFrame, *by: str) -> DataFrame:
    return rounded(sketch_statistics(merged).select(*by, "column", "rows", "null_count", "nan_count", *_SHOWN))


@query(f"WITH {_DIRTY_SQL} {_statistics_sql('year, month')}")
def monthly_profile(spark, sf_dir):
    return _shown(profile_sketches(_dirty(spark, sf_dir), ["price", "status"]), "year", "month")


@query(f"WITH {_DIRTY_SQL} {_statistics_sql('year')}")
def yearly_profile_from_months(spark, sf_dir):
    """Years from the sketches of their months: the rows are not read again."""
    months = stored(profile_sketches(_dirty(spark, sf_dir), ["price", "status"]), "sketches")
    return _shown(merge_sketches(months, "year"), "year")


@query(f"""WITH {_DIRTY_SQL}, parted AS (SELECT *, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split
    FROM dirty WHERE year = 1997) {_statistics_sql('split', 'parted')}""")
def split_profile_from_months(spark, sf_dir):
    """One year's parts of a split, from sketches by year, month and part."""
    rows = hash_split(_dirty(spark, sf_dir), ["o_orderkey"])
    sketches = stored(profile_sketches(rows, ["price", "status"], ("year", "month", "split")), "sketches")
    return _shown(merge_sketches(sketches.where("year = 1997"), "split"), "split")


@query(f"WITH {_DIRTY_SQL} {_statistics_sql('year')}")
def updated_profile(spark, sf_dir):
    """A profile table written from some rows, whose incomplete months are then written again."""
    path = scratch_path(spark, "profile")
    rows = _dirty(spark, sf_dir)
    whole = (F.col("year") % 2 == 0) | (F.col("month") <= 6)
    update_profile(rows.where(whole | every("o_orderkey", 3)), path, ["price", "status"])
    update_profile(rows.where(~whole), path, ["price", "status"])
    return _shown(merge_sketches(read_profile(spark, path), "year"), "year")


# Searches whose folds roll through time.

_WEEKS_SQL = """obs AS (SELECT event_id, dew_point, wind_speed, temperature AS label,
    CAST(floor(date_diff('day', DATE '1970-01-05', CAST(timestamp AS DATE)) / 7) AS INTEGER) AS period
  FROM kept WHERE dew_point IS NOT NULL AND wind_speed IS NOT NULL), last AS (SELECT max(period) AS p FROM obs)"""


def _rolling_value(penalty: float, back: int) -> str:
    at = f"(SELECT p - {back} FROM last)"
    return _ridge_value(_RMSE, penalty, f"period < {at}", f"period = {at}")


@query(clean_sql(_WEEKS_SQL) + " " + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS \"regParam\", {r(' + '.join(f'{_rolling_value(p, k)} / 3' for k in range(3)), 'cv_rmse')}"
    for p in _PENALTIES))
def rolling_fold_scores(spark, sf_dir):
    """Penalties by how well each of the last three weeks is predicted from all weeks before it."""
    rows = clean(spark, sf_dir).select("timestamp", *WEATHER, F.col("temperature").alias("label"))
    data = with_period(rows.dropna(), "timestamp", "week")
    with persisted(data):
        search = grid_search(data, feature_plan(WEATHER, impute=()), Preset("linear", {"regParam": list(_PENALTIES)}, folds=3),
                             "period", rolling=True)
    return rounded(cv_table(data, search), "cv_rmse")


_SHIPPED_SQL = "WITH priced AS (SELECT l_quantity, l_extendedprice / 1000 AS label, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS period FROM lineitem), " + ", ".join(
    f"""at{k} AS (SELECT period AS p FROM priced GROUP BY 1 ORDER BY 1 DESC LIMIT 1 OFFSET {k}),
  fit{k} AS (SELECT * FROM priced WHERE period < (SELECT p FROM at{k})), {_stump_sql(f'cut{k}', f'fit{k}', 'label')},
  held{k} AS (SELECT label - {_cut_value(f'cut{k}')} AS error FROM priced WHERE period = (SELECT p FROM at{k}))""" for k in (0, 1))


@query(f"""{_SHIPPED_SQL} SELECT CAST(1 AS INTEGER) AS "maxDepth", {r(' + '.join(
    f'(SELECT sqrt(avg(error * error)) FROM held{k}) / 2' for k in (0, 1)), 'cv_rmse')}""")
def rolling_tree_scores(spark, sf_dir):
    """A tree of one cut, on the last two months with shipments."""
    rows = load(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_quantity", (F.col("l_discount") * 0).alias("nothing"), (F.col("l_extendedprice") / 1000).alias("label"))
    data = with_period(rows, "l_shipdate", "month")
    preset = Preset("rf", {"maxDepth": [1]}, folds=2, fixed={
        "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": 64})
    with persisted(data):
        return rounded(cv_table(data, grid_search(data, feature_plan(["l_quantity", "nothing"], impute=()), preset, "period", rolling=True)))


# Samples of an exact size.

_SIZES = (1_000, 10_000, 1_000_000)
_HASH_SQL = "md5('sample|' || l_orderkey || '|' || l_linenumber)"


@query(" UNION ALL ".join(f"SELECT CAST({n} AS INTEGER) AS size, * FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
                          f"ORDER BY {_HASH_SQL} LIMIT {n})" for n in _SIZES))
def sample_exact_by_key(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return reduce(DataFrame.unionByName, [
        exact_sample(items, n, ["l_orderkey", "l_linenumber"]).select(F.lit(n).alias("size"), "*") for n in _SIZES])


@query("""SELECT l_returnflag, count(*) AS rows FROM (SELECT l_returnflag FROM lineitem
  ORDER BY md5('sample|' || l_returnflag) LIMIT 5000) GROUP BY 1""")
def sample_sink_of_repeated_keys(spark, sf_dir):
    """Three keys for all rows: the sample is as large as asked for all the same."""
    path = scratch_path(spark, "exact-sample")
    write_sample(load(spark, sf_dir, "lineitem").select("l_returnflag"), path, 5_000, keys=["l_returnflag"])
    return read_table(spark, path).groupBy("l_returnflag").agg(F.count("*").alias("rows"))
