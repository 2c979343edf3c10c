"""Sources, sinks and whole jobs, as round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.aggregate import regression_metrics
from barograph.operators.decode import decode_observations
from barograph.operators.derive import with_calendar
from barograph.operators.split import split_parts
from barograph.plans.cleaning import (
    run_cleaning, run_split, run_value_quality_cleaning, run_value_quality_etl, split_path,
)
from barograph.plans.modeling import run_evaluation
from barograph.session import scratch_path
from barograph.sources.models import load_model, save_model
from barograph.sources.raw import read_raw
from barograph.sources.tables import (
    read_partition, read_result, read_table, replace_partitions, write_bounded, write_partitioned,
    write_result, write_sample, write_table,
)
from workload.cleaning import packed
from workload.common import Registry, is_train_sql, load, r, rounded
from workload.learning import WEATHER, WEATHER_SQL, fit_weather, weather_rows
from workload.packed import PACKED_SQL, clean_sql, decoded_sql

registry = Registry()
query = registry.query

# Two kinds of files: one without AA2 and CIG, one with the columns in another order.
_NARROW = ("STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "WND", "VIS", "TMP",
           "DEW", "SLP", "AA1")
_WIDE = ("STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "WND", "CIG", "VIS",
         "TMP", "DEW", "SLP", "AA1", "AA2", "REPORT_TYPE")
_MIXED_SQL = """mixed AS (SELECT * REPLACE (
    CASE WHEN event_id % 2 = 1 THEN "AA2" END AS "AA2",
    CASE WHEN event_id % 2 = 1 THEN "CIG" END AS "CIG") FROM packed)"""


def _write_raw(spark: SparkSession, sf_dir: str, with_id: bool = False) -> str:
    """Packed observations as CSV files with two different headers."""
    path = scratch_path(spark, "raw")
    rows = packed(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    key = ["event_id"] if with_id else []
    for name, part, columns in (("narrow", ~odd, _NARROW), ("wide", odd, _WIDE)):
        table = rows.where(part).select(*columns[:2], *key, *columns[2:])
        table.write.csv(f"{path}/{name}", header=True, emptyValue="", nullValue="")
    return path


@query(f"""WITH {PACKED_SQL}, {_MIXED_SQL}, {decoded_sql(source='mixed')}
  SELECT event_id, "STATION", {r('latitude')}, {r('longitude')}, station_name, {r('temperature')},
    {r('dew_point')}, {r('sea_level_pressure')}, {r('visibility')}, {r('wind_speed')},
    {r('precipitation')}, {r('ceiling_height')} FROM decoded""")
def raw_files_mixed_headers(spark, sf_dir):
    raw = read_raw(spark, f"{_write_raw(spark, sf_dir, with_id=True)}/*")
    rows = decode_observations(
        raw.withColumn("event_id", F.col("event_id").cast("bigint")), keep=("event_id",))
    return rounded(rows.drop("timestamp", "elevation", "wind_direction"))


@query("""SELECT printf('%d', event_id::INT) AS "STATION", strftime(ts, '%Y-%m-%d') AS "DATE",
    printf('%d.5,1', (user_id % 30)::INT) AS "TMP" FROM events
  WHERE event_id % 10 <> 0 AND event_id % 11 <> 0""")
def raw_files_drop_malformed(spark, sf_dir):
    line = F.expr("""concat(event_id, ',', date_format(ts, 'yyyy-MM-dd'), CASE
      WHEN event_id % 10 = 0 THEN '' WHEN event_id % 11 = 0 THEN ',1,2,3'
      ELSE concat(',"', user_id % 30, '.5,1"') END)""")
    path = scratch_path(spark, "malformed")
    load(spark, sf_dir, "events").select(line.alias("STATION,DATE,TMP")).write.csv(
        path, header=True, sep="\u0001", quote="")
    return read_raw(spark, path, malformed="drop")


@query("SELECT event_id, event_type, CASE WHEN event_id % 3 = 2 THEN CAST(user_id AS VARCHAR) END AS user_id FROM events")
def raw_files_blank_first_line(spark, sf_dir):
    """Three folders: plain, with a blank line before the header, and with one more column."""
    path = scratch_path(spark, "blank-first-line")
    events = load(spark, sf_dir, "events")
    short, long = "concat(event_id, ',', event_type)", "concat(event_id, ',', user_id, ',', event_type)"
    for part, (line, header) in enumerate((
            (short, "event_id,event_type"), (short, "\n\nevent_id,event_type"), (long, "event_id,user_id,event_type"))):
        rows = events.where(F.col("event_id") % 3 == part).coalesce(1).select(F.expr(line).alias("value"))
        first = spark.createDataFrame([(header,)], "value string")
        first.unionByName(rows).coalesce(1).write.text(f"{path}/{part}", lineSep="\n")
    raw = read_raw(spark, f"{path}/*", glob="*.txt")
    return raw.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "user_id")


MANY = 32


def _many_headers(spark: SparkSession, sf_dir: str) -> str:
    """One folder of files per header; every seventh event has a value too many."""
    path = scratch_path(spark, "many-headers")
    events = load(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % MANY).alias("part"), F.expr(f"""concat(event_id, ',',
            repeat('q,', int(event_id % {MANY})), event_type, if(event_id % 7 = 0, ',more', ''))""").alias("value"))
    headers = spark.range(MANY).selectExpr(
        "-1 AS event_id", "id AS part",
        "concat('event_id,', array_join(transform(sequence(0, int(id)), x -> concat('q', x, ',')), ''), 'kind') AS value")
    headers = headers.withColumn("value", F.expr("replace(value, concat('q', part, ','), '')"))
    both = headers.unionByName(events).repartition(MANY, "part").sortWithinPartitions("part", "event_id")
    both.select("part", "value").write.partitionBy("part").text(path)
    return path


@query("SELECT event_id, event_type AS kind FROM events")
def raw_files_many_headers(spark, sf_dir):
    raw = read_raw(spark, _many_headers(spark, sf_dir), glob="*.txt", columns=["event_id", "kind"])
    return raw.select(F.col("event_id").cast("bigint").alias("event_id"), "kind")


@query("SELECT event_id, event_type AS kind FROM events WHERE event_id % 7 <> 0")
def raw_files_many_headers_drop(spark, sf_dir):
    raw = read_raw(spark, _many_headers(spark, sf_dir), malformed="drop", glob="*.txt")
    return raw.select(F.col("event_id").cast("bigint").alias("event_id"), "kind")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return with_calendar(orders, "o_orderdate").drop("day", "hour")


@query(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(*) AS rows, {r('sum(o_totalprice)', 'total', 2)} FROM orders GROUP BY 1, 2""")
def partitioned_table(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    write_partitioned(_orders(spark, sf_dir), path)
    return rounded(read_table(spark, path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total")), digits=2)


@query(f"SELECT o_orderkey, {r('o_totalprice')} FROM orders "
       "WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5")
def one_partition(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    write_partitioned(_orders(spark, sf_dir), path)
    month = read_partition(spark, path, year=1997, month=5)
    return rounded(month.select("o_orderkey", "o_totalprice"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered_on FROM orders")
def unpartitioned_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    write_table(_orders(spark, sf_dir), path)
    return read_table(spark, path).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered_on"))


@query(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows,
    {r('sum(CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice + 1 ELSE o_totalprice END)', 'total', 2)}
  FROM orders GROUP BY 1""")
def replaced_partitions(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    orders = _orders(spark, sf_dir)
    write_partitioned(orders, path)
    changed = orders.where(F.col("year") == 1996).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        replace_partitions(changed, path, rows_per_file=1_000_000)
    return rounded(read_table(spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total")), digits=2)


@query("SELECT count(*) AS rows, CAST(4 AS BIGINT) AS files FROM orders")
def bounded_files(spark, sf_dir):
    path = scratch_path(spark, "bounded")
    write_bounded(_orders(spark, sf_dir), path, files=4)
    return read_table(spark, path).select("o_orderkey", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("f").alias("files"))


@query(f"""SELECT o_orderpriority, count(*) AS rows, {r('avg(o_totalprice)', 'mean_price', 4)}
  FROM orders GROUP BY 1""")
def result_table(spark, sf_dir):
    path = scratch_path(spark, "result")
    write_result(load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("o_totalprice").alias("mean_price")), path)
    assert read_result(spark, f"{path}/absent") is None
    found = read_result(spark, path)
    return rounded(found.withColumn("rows", F.col("rows").cast("bigint")), digits=4)


@query(f"SELECT o_orderkey, {r('o_totalprice')} FROM orders ORDER BY o_orderkey LIMIT 1000")
def ordered_sample(spark, sf_dir):
    path = scratch_path(spark, "sample")
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    write_sample(orders, path, 1000, order_by=["o_orderkey"])
    return rounded(read_table(spark, path))


@query(f"""WITH {PACKED_SQL}, {_MIXED_SQL}, {decoded_sql(source='mixed')}, kept AS (SELECT * FROM decoded
    WHERE temperature BETWEEN -90 AND 60 AND (dew_point IS NULL OR dew_point <= temperature)
      AND (sea_level_pressure IS NULL OR sea_level_pressure BETWEEN 950 AND 1050))
  SELECT CAST(day(timestamp) AS INTEGER) AS day, count(*) AS rows, {r('avg(temperature)', 'temperature')},
    {r('sum(precipitation)', 'precipitation')}, {r('avg(ceiling_height)', 'ceiling_height')},
    (SELECT count(*) FROM decoded) AS rows_in, (SELECT count(*) FROM kept) AS rows_kept
  FROM kept GROUP BY 1""")
def cleaning_job(spark, sf_dir):
    """Raw files to the clean table, with the counts the job reports."""
    path = scratch_path(spark, "clean")
    report = run_cleaning(spark, f"{_write_raw(spark, sf_dir)}/*", path)
    return rounded(read_table(spark, path).groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("temperature").alias("temperature"),
        F.sum("precipitation").alias("precipitation"),
        F.avg("ceiling_height").alias("ceiling_height"),
        F.lit(report.rows_in).cast("bigint").alias("rows_in"),
        F.lit(report.rows_kept).cast("bigint").alias("rows_kept")))


_ORDER_SPLIT = f"CASE WHEN {is_train_sql('o_orderkey')} THEN 'train' ELSE 'test' END"


@query(f"""WITH parts AS (SELECT {_ORDER_SPLIT} AS split, o_totalprice, month(o_orderdate) AS month FROM orders)
  SELECT split, count(*) AS rows, count(*) AS reported_rows, {r('avg(o_totalprice)', 'mean_price', 4)},
    count(DISTINCT month) AS months FROM parts GROUP BY 1""")
def split_job(spark, sf_dir):
    """Train and test tables written by one job, read back by path."""
    source, target = scratch_path(spark, "orders"), scratch_path(spark, "split")
    write_partitioned(_orders(spark, sf_dir), source)
    reported = run_split(spark, source, target, keys=["o_orderkey"], target="o_totalprice")
    parts = [
        read_table(spark, split_path(target, part)).agg(
            F.lit(part).alias("split"), F.count(F.lit(1)).alias("rows"),
            F.lit(count).cast("bigint").alias("reported_rows"),
            F.avg("o_totalprice").alias("mean_price"), F.countDistinct("month").alias("months"))
        for part, count in reported.items()
    ]
    return rounded(parts[0].unionByName(parts[1]), digits=4)


@query(clean_sql(WEATHER_SQL) + f""" SELECT {r('rmse')}, {r('r2')}, {r('mae')}, {r('mse')}, rows
  FROM measured WHERE model = 'linear_two' AND NOT is_train""")
def saved_model_scores(spark, sf_dir):
    train, test = split_parts(weather_rows(spark, sf_dir))
    path = scratch_path(spark, "model")
    save_model(fit_weather(train, WEATHER), path)
    return rounded(regression_metrics(load_model(path).transform(test)))


@query(clean_sql(WEATHER_SQL) + f""", ranged AS (SELECT label - prediction AS error,
    CASE WHEN label < 0 THEN 0 WHEN label < 10 THEN 1 WHEN label < 20 THEN 2 WHEN label < 30 THEN 3 ELSE 4 END AS range_id
    FROM scored WHERE model = 'linear_two' AND NOT is_train)
  SELECT CAST(range_id AS INTEGER) AS range_id, count(*) AS count, {r('avg(abs(error))', 'mean_abs_error')},
    {r('avg(error * error)', 'mean_squared_error')},
    {r("(SELECT rmse FROM measured WHERE model = 'linear_two' AND NOT is_train)", 'test_rmse')}
  FROM ranged GROUP BY 1""")
def evaluation_job(spark, sf_dir):
    """Scores written once; reports read from the written error table."""
    train, test = split_parts(weather_rows(spark, sf_dir))
    model, rows, out = (scratch_path(spark, n) for n in ("model", "test", "evaluation"))
    save_model(fit_weather(train, WEATHER), model)
    write_table(test, rows)
    found = run_evaluation(spark, model, rows, out, WEATHER, target="label", key=("event_id",))
    rmse = read_result(spark, f"{out}/test_metrics").first()["test_rmse"]
    return rounded(found["by_range"].drop("temp_range").withColumn("test_rmse", F.lit(rmse)))


@query(f"""WITH plain AS (SELECT event_id, ts, round(value * 10) / 10 AS label,
    CASE WHEN event_id % 5 <> 0 THEN (user_id % 20) + 0.5 END AS dew FROM events WHERE event_id % 6 <> 0)
  SELECT CAST(day(ts) AS INTEGER) AS day, count(*) AS rows, {r('avg(label)', 'label')},
    {r('avg(coalesce(dew, (SELECT quantile_disc(dew, 0.5) FROM plain)))', '"DEW_num"')}
  FROM plain WHERE label BETWEEN -90 AND 60 GROUP BY 1""")
def value_quality_job(spark, sf_dir):
    """Value-quality files to the cleaned, median-filled table."""
    raw, table, cleaned = (scratch_path(spark, n) for n in ("vq-raw", "vq-table", "vq-clean"))
    load(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.expr("""CASE WHEN event_id % 6 = 0 THEN 'M'
          ELSE concat(round(value * 10) / 10, ',1') END""").alias("TMP"),
        F.expr("CASE WHEN event_id % 5 <> 0 THEN concat(user_id % 20, '.5,1') END").alias("DEW"),
    ).write.csv(raw, header=True)
    run_value_quality_etl(spark, raw, table)
    run_value_quality_cleaning(spark, table, cleaned, month_by_month=True, relative_error=None)
    return rounded(read_table(spark, cleaned).groupBy(F.dayofmonth("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("label").alias("label"),
        F.avg("DEW_num").alias("DEW_num")))
