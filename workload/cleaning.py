"""Decoding, derived features, row rules and fills."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.functions import derived, fields
from barograph.operators.aggregate import count_by, retention_report
from barograph.operators.decode import decode_observations, decode_value_quality
from barograph.operators.derive import (
    FEATURES_14, clean_numbers, derive_features, select_features, with_day_of_year, with_humidity,
    with_partition_keys,
)
from barograph.operators.quality import (
    apply_median_fill, complete_cases, fit_median_fill, quality_filter, quality_report,
    standard_rules, tag_rejections,
)
from workload.common import Registry, every, load, r, rounded
from workload.packed import (
    DERIVED_SQL, KEPT_WHERE, PACKED_SQL, clean_sql, decoded_sql, packed_observations, part_sql,
)

registry = Registry()
query = registry.query


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_observations(load(spark, sf_dir, "events"))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_observations(packed(spark, sf_dir), keep=("event_id",))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(decoded(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Clean observations, with further packed columns if named."""
    rows = decode_observations(packed(spark, sf_dir), keep=("event_id", *keep))
    return quality_filter(derive_features(rows))


_DECODED_COLUMNS = f"""event_id, "STATION", strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS observed_at,
  {r('latitude')}, {r('longitude')}, {r('elevation')}, station_name,
  {r('temperature')}, {r('dew_point')}, {r('sea_level_pressure')}, {r('visibility')},
  CAST(wind_direction AS DOUBLE) AS wind_direction, {r('wind_speed')}, {r('precipitation')},
  {r('ceiling_height')}"""


def _decoded_output(df: DataFrame) -> DataFrame:
    shown = df.withColumns({
        "observed_at": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        "wind_direction": F.col("wind_direction").cast("double"),
    }).drop("timestamp")
    return rounded(shown)


@query(f"WITH {PACKED_SQL}, {decoded_sql()} SELECT {_DECODED_COLUMNS} FROM decoded")
def decode_packed_observations(spark, sf_dir):
    return _decoded_output(decoded(spark, sf_dir))


_ODD_SQL = """odd AS (SELECT * REPLACE (
    CASE WHEN event_id % 19 = 0 THEN '+9999,1' WHEN event_id % 23 = 0 THEN '' ELSE "TMP" END AS "TMP",
    CASE WHEN event_id % 21 = 0 THEN '+9999,1' ELSE "DEW" END AS "DEW",
    CASE WHEN event_id % 29 = 0 THEN '120,1,N' WHEN event_id % 31 = 0 THEN '999,9,V,9999,9'
      ELSE "WND" END AS "WND",
    CASE WHEN event_id % 37 = 0 THEN 'not-a-date' ELSE "DATE" END AS "DATE")
  FROM packed)"""


def _odd(df: DataFrame) -> DataFrame:
    """Packed observations with short, malformed and half-missing fields."""
    return df.withColumns({
        "TMP": F.when(every("event_id", 19), "+9999,1").when(every("event_id", 23), "")
        .otherwise(F.col("TMP")),
        "DEW": F.when(every("event_id", 21), "+9999,1").otherwise(F.col("DEW")),
        "WND": F.when(every("event_id", 29), "120,1,N").when(every("event_id", 31), "999,9,V,9999,9")
        .otherwise(F.col("WND")),
        "DATE": F.when(every("event_id", 37), "not-a-date").otherwise(F.col("DATE")),
    })


@query(f"WITH {PACKED_SQL}, {_ODD_SQL}, {decoded_sql(source='odd')} "
       f"SELECT {_DECODED_COLUMNS} FROM decoded")
def decode_malformed_fields(spark, sf_dir):
    return _decoded_output(decode_observations(_odd(packed(spark, sf_dir)), keep=("event_id",)))


@query(f"WITH {PACKED_SQL}, {_ODD_SQL}, {decoded_sql(exact=True, source='odd')} "
       f"SELECT {_DECODED_COLUMNS} FROM decoded")
def decode_exact_sentinel(spark, sf_dir):
    return _decoded_output(
        decode_observations(_odd(packed(spark, sf_dir)), exact_sentinel=True, keep=("event_id",)))


@query(f"""WITH {PACKED_SQL},
  groups AS (SELECT event_id, "AA1", "AA2", "AA2" AS "GA1" FROM packed),
  depths AS (SELECT event_id,
    coalesce(CASE WHEN NOT contains("AA1", '9999') THEN try_cast({part_sql('"AA1"', 2)} AS DOUBLE) / 10 END, 0.0) AS aa1,
    coalesce(CASE WHEN NOT contains("AA2", '9999') THEN try_cast({part_sql('"AA2"', 2)} AS DOUBLE) / 10 END, 0.0) AS aa2
    FROM groups)
  SELECT event_id, {r('aa1')}, CAST(NULL AS DOUBLE) AS unknown, {r('aa1 + aa2', 'total_aa')},
    {r('aa1 + aa2 + aa2', 'total_with_ga')} FROM depths""")
def precipitation_groups(spark, sf_dir):
    groups = packed(spark, sf_dir).withColumn("GA1", F.col("AA2"))
    return rounded(groups.select(
        "event_id",
        fields.precipitation_depth("AA1").alias("aa1"),
        fields.precipitation_depth("NAME").alias("unknown"),
        fields.precipitation_total(["AA1", "AA2"]).alias("total_aa"),
        fields.precipitation_total(["AA1", "AA2", "GA1"]).alias("total_with_ga")))


_PLAIN_SQL = """plain AS (SELECT event_id,
    CASE WHEN event_id % 5 = 0 THEN 'M' WHEN event_id % 6 = 0 THEN '' WHEN event_id % 7 = 0 THEN NULL
      WHEN event_id % 8 = 0 THEN 'x,1'
      ELSE printf('%d.%d,1', (user_id % 40)::INT, (event_id % 10)::INT) END AS "TMP",
    printf('%d.%d,1', (user_id % 20)::INT, (event_id % 10)::INT) AS "DEW",
    printf('%d,1,N,%04d,1', (event_id % 360)::INT, (user_id % 90)::INT) AS "WND"
  FROM events)"""


def _plain(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.when(every("event_id", 5), "M").when(every("event_id", 6), "")
        .when(every("event_id", 7), None).when(every("event_id", 8), "x,1")
        .otherwise(F.expr("concat(user_id % 40, '.', event_id % 10, ',1')")).alias("TMP"),
        F.expr("concat(user_id % 20, '.', event_id % 10, ',1')").alias("DEW"),
        F.expr("concat(event_id % 360, ',1,N,00', lpad(string(user_id % 90), 2, '0'), ',1')").alias("WND"))


@query(f"""WITH {_PLAIN_SQL}
  SELECT event_id, {r(f"try_cast(nullif(nullif({part_sql('"TMP"', 1)}, 'M'), '') AS DOUBLE)", 'label')},
    {r(f"try_cast({part_sql('"WND"', 4)} AS DOUBLE) / 10", '"WS_num"')},
    {r(f"try_cast({part_sql('"DEW"', 1)} AS DOUBLE)", '"DEW_num"')} FROM plain""")
def decode_value_quality_fields(spark, sf_dir):
    decoded_fields = decode_value_quality(
        _plain(load(spark, sf_dir, "events")), scales={"WND": 10.0}, parts={"WND": 3})
    return rounded(decoded_fields.select("event_id", "label", "WS_num", "DEW_num"))


@query("""WITH texts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'not-a-date'
    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS "DATE" FROM orders)
  SELECT o_orderkey, strftime(try_cast("DATE" AS TIMESTAMP), '%Y-%m-%d') AS observed_on FROM texts""")
def parse_observation_time(spark, sf_dir):
    text = F.when(every("o_orderkey", 10), "not-a-date").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    texts = load(spark, sf_dir, "orders").select("o_orderkey", text.alias("DATE"))
    return texts.select(
        "o_orderkey", F.date_format(fields.observation_time("DATE"), "yyyy-MM-dd").alias("observed_on"))


_CYCLES = ("hour_sin", "hour_cos", "month_sin", "month_cos", "wind_dir_sin", "wind_dir_cos")


@query(f"""WITH decoded AS (SELECT event_id, ts AS timestamp, CASE WHEN event_id % 6 <> 0
    THEN CAST(event_id % 361 AS INTEGER) END AS wind_direction FROM events), {DERIVED_SQL}
  SELECT event_id, year, month, day, hour, {', '.join(r(c) for c in _CYCLES)} FROM derived""")
def cyclical_features(spark, sf_dir):
    direction = F.when(~every("event_id", 6), (F.col("event_id") % 361).cast("int"))
    rows = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("timestamp"), direction.alias("wind_direction"))
    return rounded(derive_features(rows).select("event_id", "year", "month", "day", "hour", *_CYCLES))


@query(f"""SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INTEGER) AS dayofyear,
    {r('sin(dayofyear(o_orderdate) * 2 * pi() / 365.25)', 'doy_sin')},
    {r('cos(dayofyear(o_orderdate) * 2 * pi() / 365.25)', 'doy_cos')} FROM orders""")
def day_of_year_features(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return rounded(with_day_of_year(orders, "o_orderdate").drop("o_orderdate"))


@query(clean_sql() + f""" SELECT event_id,
    {r('100 * exp(17.625 * dew_point / (243.04 + dew_point) - 17.625 * temperature / (243.04 + temperature))', 'relative_humidity')}
  FROM kept""")
def relative_humidity(spark, sf_dir):
    return rounded(with_humidity(clean(spark, sf_dir)).select("event_id", "relative_humidity"))


@query(f"""SELECT event_id, {r("CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 THEN value END", 'value')},
    CAST(user_id AS DOUBLE) AS user_id FROM events""")
def nan_to_null(spark, sf_dir):
    dirty = F.when(every("event_id", 4), None).when(every("event_id", 9), float("nan")).otherwise(
        F.col("value"))
    events = load(spark, sf_dir, "events").select("event_id", "user_id", dirty.alias("value"))
    return rounded(clean_numbers(events, ["value", "user_id", "absent"]), "value")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(*) AS count, CAST(0 AS INTEGER) AS undated_year, CAST(0 AS INTEGER) AS undated_month
  FROM orders GROUP BY 1, 2""")
def default_partition_keys(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    dated = with_partition_keys(orders.select(F.col("o_orderdate").cast("string").alias("DATE")))
    undated = with_partition_keys(dated.drop("DATE").withColumnsRenamed(
        {"year": "kept_year", "month": "kept_month"}))
    counted = count_by(undated, "kept_year", "kept_month", "year", "month")
    return counted.select(
        F.col("kept_year").alias("year"), F.col("kept_month").alias("month"), "count",
        F.col("year").alias("undated_year"), F.col("month").alias("undated_month"))


@query(clean_sql() + f""" SELECT event_id, {', '.join(r(c) for c in FEATURES_14)},
    {r('temperature', 'label')} FROM derived WHERE temperature IS NOT NULL""")
def select_model_features(spark, sf_dir):
    return rounded(select_features(
        features(spark, sf_dir), FEATURES_14, "temperature", keep=("event_id",)))


_KEPT_COLUMNS = ("temperature", "dew_point", "sea_level_pressure", "visibility", "wind_speed",
                 "precipitation", *_CYCLES)


@query(clean_sql() + f""" SELECT event_id, year, month, day, hour,
    {', '.join(r(c) for c in _KEPT_COLUMNS)} FROM kept""")
def quality_filtered(spark, sf_dir):
    return rounded(clean(spark, sf_dir).select(
        "event_id", "year", "month", "day", "hour", *_KEPT_COLUMNS))


_TAG_SQL = """CASE WHEN temperature IS NULL THEN 'target_present'
      WHEN NOT temperature BETWEEN -90 AND 60 THEN 'target_plausible'
      WHEN dew_point > temperature THEN 'dew_point_consistent'
      WHEN NOT sea_level_pressure BETWEEN 950 AND 1050 THEN 'pressure_plausible' END"""


@query(f"""WITH {PACKED_SQL}, {_ODD_SQL}, {decoded_sql(exact=True, source='odd')},
  tagged AS (SELECT {_TAG_SQL} AS rejected_by FROM decoded),
  rules(rule_id, rule) AS (VALUES (0, 'target_present'), (1, 'target_plausible'),
    (2, 'dew_point_consistent'), (3, 'pressure_plausible'))
  SELECT CAST(rule_id AS INTEGER) AS rule_id, rule,
    (SELECT count(*) FROM tagged WHERE rejected_by = rule) AS rows_rejected,
    (SELECT count(*) FROM tagged) AS rows_in,
    (SELECT count(*) FROM tagged WHERE rejected_by IS NULL) AS rows_kept,
    {r('100.0 * (SELECT count(*) FROM tagged WHERE rejected_by IS NULL) / (SELECT count(*) FROM tagged)', 'retention_pct')}
  FROM rules""")
def quality_rule_report(spark, sf_dir):
    rows = decode_observations(_odd(packed(spark, sf_dir)), exact_sentinel=True)
    return rounded(quality_report(rows))


@query(f"""WITH {PACKED_SQL}, {decoded_sql()}
  SELECT event_id, {_TAG_SQL} AS rejected_by FROM decoded""")
def rejected_rows(spark, sf_dir):
    return tag_rejections(decoded(spark, sf_dir)).select("event_id", "rejected_by")


@query(f"""WITH {PACKED_SQL}, {decoded_sql()}, counts AS (
    SELECT count(*) AS rows_before, count(*) FILTER (WHERE {KEPT_WHERE}) AS rows_kept FROM decoded)
  SELECT rows_before, rows_kept, rows_before - rows_kept AS rows_removed,
    {r('100.0 * rows_kept / rows_before', 'retention_pct')} FROM counts""")
def retention(spark, sf_dir):
    passes = None
    for rule in standard_rules().values():
        passes = rule if passes is None else passes & rule
    return rounded(retention_report(decoded(spark, sf_dir), passes))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in (*FEATURES_14, "temperature"))


@query(clean_sql() + f" SELECT event_id, {r('temperature')} FROM kept WHERE {_COMPLETE}")
def complete_case_rows(spark, sf_dir):
    kept = complete_cases(clean(spark, sf_dir), [*FEATURES_14, "temperature"])
    return rounded(kept.select("event_id", "temperature"))


@query(clean_sql() + f""" SELECT event_id, {r('temperature')}, {r('dew_point')}, {r('wind_speed')}
  FROM kept WHERE dew_point IS NOT NULL AND sea_level_pressure IS NOT NULL AND visibility IS NOT NULL""")
def skip_invalid_rows(spark, sf_dir):
    columns = ["dew_point", "sea_level_pressure", "visibility", "wind_speed"]
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")
    assembled = assembler.transform(clean(spark, sf_dir))
    return rounded(assembled.select("event_id", "temperature", "dew_point", "wind_speed"))


GAPS = {"l_quantity": 7, "l_extendedprice": 5, "l_discount": 11}


def with_gaps(lineitem: DataFrame) -> DataFrame:
    """Line items with NULLs at fixed keys."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        *[F.when(key % modulus != 0, F.col(name)).alias(name) for name, modulus in GAPS.items()])


GAPS_SQL = "gaps AS (SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN (l_orderkey + l_linenumber) % {m} <> 0 THEN {c} END AS {c}" for c, m in GAPS.items()
) + " FROM lineitem)"

_FILLED_SQL = ", ".join(
    r(f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM gaps))", c) for c in GAPS)


@query(f"WITH {GAPS_SQL} SELECT l_orderkey, l_linenumber, {_FILLED_SQL} FROM gaps")
def median_fill(spark, sf_dir):
    gaps = with_gaps(load(spark, sf_dir, "lineitem"))
    medians = fit_median_fill(gaps, list(GAPS), relative_error=None)
    return rounded(apply_median_fill(gaps, medians))


@query("""SELECT CASE WHEN temperature < 0 THEN 0 WHEN temperature < 10 THEN 1
    WHEN temperature < 20 THEN 2 WHEN temperature < 30 THEN 3 ELSE 4 END AS range_id,
    CASE WHEN temperature < 0 THEN 'Below 0°C' WHEN temperature < 10 THEN '0-10°C'
    WHEN temperature < 20 THEN '10-20°C' WHEN temperature < 30 THEN '20-30°C' ELSE 'Above 30°C' END AS temp_range,
    count(*) AS count FROM (SELECT round(value * 10 - 400) / 10 AS temperature FROM events) GROUP BY 1, 2""")
def label_range_counts(spark, sf_dir):
    label = F.round(F.col("value") * 10 - 400) / 10
    labels = load(spark, sf_dir, "events").select(label.alias("label"))
    return count_by(labels.select(
        derived.label_range_id(F.col("label")).alias("range_id"),
        derived.label_range(F.col("label")).alias("temp_range")), "range_id", "temp_range")
