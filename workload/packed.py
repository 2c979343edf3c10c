"""The events table as packed weather observations, in Spark and in SQL.

Both build the same strings, so the decoders can be checked end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.common import every


def digits(expr: str, width: int):
    """Integer as text, padded with zeros to at least ``width`` digits."""
    text = F.expr(f"string(int({expr}))")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _signed(expr: str):
    sign = F.when(F.expr(f"{expr} < 0"), "-").otherwise("+")
    return F.concat(sign, digits(f"abs({expr})", 4), F.lit(",1"))


def _when_else(condition, code, text):
    return F.when(condition, F.lit(code)).otherwise(text)


def packed_observations(events: DataFrame) -> DataFrame:
    x = "round(value * 10) - 400"
    dew = f"({x} - event_id % 60 + 2)"

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    return events.select(
        "event_id",
        digits("user_id", 5).alias("STATION"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        _when_else(every("event_id", 13), "abc", text(
            digits("user_id % 90", 1), ".", digits("user_id % 100", 2))).alias("LATITUDE"),
        text("-", digits("user_id % 180", 1), ".", digits("event_id % 100", 2)).alias("LONGITUDE"),
        text(digits("user_id * 7 % 2000", 1), ".", digits("event_id % 10", 1)).alias("ELEVATION"),
        text("STATION ", digits("user_id % 500", 1)).alias("NAME"),
        _when_else(every("event_id", 17), "+9999,9", _signed(f"({x})")).alias("TMP"),
        _when_else(every("event_id", 7), "+9999,9", _signed(dew)).alias("DEW"),
        _when_else(every("event_id", 3), "99999,9",
                   text(digits("9400 + event_id % 1150", 5), ",1")).alias("SLP"),
        _when_else(every("event_id", 5), "999999,9,9,9",
                   text(digits("event_id * 37 % 30000", 6), ",1,9,9")).alias("VIS"),
        text(digits("event_id % 361", 3), ",1,N,", digits("user_id % 90", 4), ",1").alias("WND"),
        F.when(~every("event_id", 4), _when_else(
            every("event_id", 11), "24,9999,9,9",
            text("24,", digits("user_id % 50", 4), ",3,1"))).alias("AA1"),
        F.when(every("event_id", 9), "06,0010,9,5")
        .when(every("event_id", 10), "24").alias("AA2"),
        _when_else(every("event_id", 2), "99999,9,9,9",
                   text(digits("event_id * 13 % 22000", 5), ",1,9,9")).alias("CIG"),
        F.col("event_type").alias("REPORT_TYPE"),
    )


PACKED_SQL = """packed AS (
  SELECT event_id, lpad(CAST(user_id AS VARCHAR), 5, '0') AS "STATION",
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "DATE",
    CASE WHEN event_id % 13 = 0 THEN 'abc'
      ELSE printf('%d.%02d', (user_id % 90)::INT, (user_id % 100)::INT) END AS "LATITUDE",
    printf('-%d.%02d', (user_id % 180)::INT, (event_id % 100)::INT) AS "LONGITUDE",
    printf('%d.%d', (user_id * 7 % 2000)::INT, (event_id % 10)::INT) AS "ELEVATION",
    printf('STATION %d', (user_id % 500)::INT) AS "NAME",
    CASE WHEN event_id % 17 = 0 THEN '+9999,9'
      ELSE printf('%+05d,1', (round(value * 10) - 400)::INT) END AS "TMP",
    CASE WHEN event_id % 7 = 0 THEN '+9999,9'
      ELSE printf('%+05d,1', (round(value * 10) - 400 - event_id % 60 + 2)::INT) END AS "DEW",
    CASE WHEN event_id % 3 = 0 THEN '99999,9'
      ELSE printf('%05d,1', (9400 + event_id % 1150)::INT) END AS "SLP",
    CASE WHEN event_id % 5 = 0 THEN '999999,9,9,9'
      ELSE printf('%06d,1,9,9', (event_id * 37 % 30000)::INT) END AS "VIS",
    printf('%03d,1,N,%04d,1', (event_id % 361)::INT, (user_id % 90)::INT) AS "WND",
    CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '24,9999,9,9'
      ELSE printf('24,%04d,3,1', (user_id % 50)::INT) END AS "AA1",
    CASE WHEN event_id % 9 = 0 THEN '06,0010,9,5' WHEN event_id % 10 = 0 THEN '24' END AS "AA2",
    CASE WHEN event_id % 2 = 0 THEN '99999,9,9,9'
      ELSE printf('%05d,1,9,9', (event_id * 13 % 22000)::INT) END AS "CIG",
    event_type AS "REPORT_TYPE"
  FROM events)"""


def part_sql(column: str, position: int) -> str:
    return f"nullif(split_part({column}, ',', {position}), '')"


def _temperature_sql(column: str, exact: bool) -> str:
    value = part_sql(column, 1)
    missing = f"{column} = '+9999,9'" if exact else f"{value} = '+9999'"
    return f"CASE WHEN NOT ({missing}) THEN try_cast({value} AS DOUBLE) / 10 END"


def _scaled_sql(column: str, code: str, position: int = 1, scale: int = 1) -> str:
    return (f"CASE WHEN NOT contains({column}, '{code}') "
            f"THEN try_cast({part_sql(column, position)} AS DOUBLE) / {scale} END")


def decoded_sql(exact: bool = False, groups=("AA1", "AA2"), source: str = "packed") -> str:
    rain = " + ".join(["0.0::DOUBLE"] + [
        f"coalesce({_scaled_sql(g, '9999', 2, 10)}, 0.0)" for g in groups])
    return f"""decoded AS (
  SELECT event_id, "STATION", try_cast("DATE" AS TIMESTAMP) AS timestamp,
    try_cast("LATITUDE" AS DOUBLE) AS latitude, try_cast("LONGITUDE" AS DOUBLE) AS longitude,
    try_cast("ELEVATION" AS DOUBLE) AS elevation, "NAME" AS station_name,
    {_temperature_sql('"TMP"', exact)} AS temperature,
    {_temperature_sql('"DEW"', exact)} AS dew_point,
    {_scaled_sql('"SLP"', '99999', 1, 10)} AS sea_level_pressure,
    {_scaled_sql('"VIS"', '999999')} AS visibility,
    CASE WHEN {part_sql('"WND"', 1)} <> '999'
      THEN try_cast({part_sql('"WND"', 1)} AS INTEGER) END AS wind_direction,
    CASE WHEN {part_sql('"WND"', 4)} <> '9999'
      THEN try_cast({part_sql('"WND"', 4)} AS DOUBLE) / 10 END AS wind_speed,
    {rain} AS precipitation,
    {_scaled_sql('"CIG"', '99999')} AS ceiling_height
  FROM {source})"""


DERIVED_SQL = """derived AS (
  SELECT *, CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
    CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour,
    sin(hour(timestamp) * 2 * pi() / 24) AS hour_sin, cos(hour(timestamp) * 2 * pi() / 24) AS hour_cos,
    sin(month(timestamp) * 2 * pi() / 12) AS month_sin, cos(month(timestamp) * 2 * pi() / 12) AS month_cos,
    sin(wind_direction * pi() / 180) AS wind_dir_sin, cos(wind_direction * pi() / 180) AS wind_dir_cos
  FROM decoded)"""

KEPT_WHERE = """temperature IS NOT NULL AND temperature BETWEEN -90 AND 60
    AND (dew_point IS NULL OR dew_point <= temperature)
    AND (sea_level_pressure IS NULL OR sea_level_pressure BETWEEN 950 AND 1050)"""

KEPT_SQL = f"""kept AS (
  SELECT * FROM derived
  WHERE {KEPT_WHERE})"""


def clean_sql(*further: str) -> str:
    """WITH clause up to the clean observations, plus further CTEs."""
    return "WITH " + ",\n".join([PACKED_SQL, decoded_sql(), DERIVED_SQL, KEPT_SQL, *further])
