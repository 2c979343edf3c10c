import datetime

import pytest
from pyspark.sql import functions as F

from barograph.functions import fields
from barograph.operators.decode import (
    CLOUD_PREFIXES, PRECIPITATION_PREFIXES, columns_with_prefix, decode_observations,
    decode_value_quality,
)
from barograph.operators.derive import derive_features, with_partition_keys
from barograph.operators.quality import quality_filter
from workload.cleaning import packed


def value(spark, text, column):
    row = spark.createDataFrame([(text,)], "x string").select(column.alias("y")).first()
    return row["y"]


@pytest.mark.parametrize("rule, text, expected", [
    (fields.temperature, "-0070,1", -7.0),
    (fields.temperature, "+9999,9", None),
    (fields.temperature, "+9999,1", None),
    (fields.temperature, None, None),
    (fields.temperature, "", None),
    (fields.temperature, "abc,1", None),
    (fields.wind_direction, "318,1,N,0061,1", 318),
    (fields.wind_direction, "999,9,V,0061,1", None),
    (fields.wind_speed, "318,1,N,0061,1", 6.1),
    (fields.wind_speed, "318,1,N,9999,9", None),
    (fields.wind_speed, "318,1,N", None),
    (fields.pressure, "10208,1", 1020.8),
    (fields.pressure, "99999,9", None),
    (fields.visibility, "025000,1,9,9", 25000.0),
    (fields.visibility, "999999,9,9,9", None),
    (fields.ceiling_height, "00800,1,9,9", 800.0),
    (fields.ceiling_height, "99999,9,9,9", None),
    (fields.plain_value, "24.0,1", 24.0),
    (fields.plain_value, "M", None),
    (fields.plain_value, "", None),
    (fields.plain_value, "x,1", None),
    (fields.plain_value, None, None),
])
def test_field_rules(spark, rule, text, expected):
    assert value(spark, text, rule("x")) == expected


@pytest.mark.parametrize("text, expected", [
    ("24,0002,3,1", 0.2), ("24,9999,9,9", 0.0), (None, 0.0), ("", 0.0), ("24", 0.0),
])
def test_precipitation_depth(spark, text, expected):
    df = spark.createDataFrame([(text,)], "AA1 string")
    assert df.select(fields.precipitation_depth("AA1")).first()[0] == expected


def test_unknown_precipitation_name_is_null(spark):
    df = spark.createDataFrame([("24,0002,3,1",)], "ZZ1 string")
    assert df.select(fields.precipitation_depth("ZZ1")).first()[0] is None


def test_exact_sentinel_keeps_other_quality_codes(spark):
    assert value(spark, "+9999,1", fields.temperature("x", exact_sentinel=True)) == 999.9
    assert value(spark, "+9999,9", fields.temperature("x", exact_sentinel=True)) is None


def test_optional_columns_follow_the_schema(spark):
    bare = spark.createDataFrame(
        [("S", "2024-01-15T06:00:00", "+0100,1", "00800,1,9,9")],
        "STATION string, DATE string, TMP string, CIG string")
    row = decode_observations(bare).first().asDict()
    assert row == {
        "STATION": "S", "timestamp": datetime.datetime(2024, 1, 15, 6), "temperature": 10.0,
        "precipitation": 0.0, "ceiling_height": 800.0}
    assert "ceiling_height" not in decode_observations(bare.drop("CIG")).columns
    with pytest.raises(ValueError):
        decode_observations(bare.drop("TMP"))


def test_malformed_location_and_time_are_null(spark):
    df = spark.createDataFrame(
        [("S", "not-a-date", "+0100,1", "abc")],
        "STATION string, DATE string, TMP string, LATITUDE string")
    row = decode_observations(df).first()
    assert row["timestamp"] is None and row["latitude"] is None


@pytest.mark.parametrize("scale, rows, kept, dew, slp, temperature, rain, visibility", [
    ("0.001", 1000, 736, 622, 482, -4.540761, 369.4, 8074319),
    ("0.01", 10000, 7273, 6221, 4662, -5.301540, 12332.8, 87129559),
])
def test_packed_view_totals(spark, scale, rows, kept, dew, slp, temperature, rain, visibility):
    raw = packed(spark, f"/root/testdata/sf{scale}")
    assert raw.count() == rows
    found = quality_filter(decode_observations(raw, precipitation=("AA1",))).agg(
        F.count("*"), F.count("dew_point"), F.count("sea_level_pressure"),
        F.round(F.avg("temperature"), 6), F.round(F.sum("precipitation"), 1),
        F.sum("visibility")).first()
    assert tuple(found) == (kept, dew, slp, temperature, rain, visibility)


def test_clean_schema(spark):
    df = derive_features(decode_observations(packed(spark, "/root/testdata/sf0.001")))
    kinds = dict(df.dtypes)
    assert kinds["timestamp"] == "timestamp" and kinds["wind_direction"] == "int"
    assert set(df.columns) == {
        "STATION", "timestamp", "latitude", "longitude", "elevation", "station_name",
        "temperature", "dew_point", "sea_level_pressure", "visibility", "wind_direction",
        "wind_speed", "precipitation", "year", "month", "day", "hour", "hour_sin", "hour_cos",
        "month_sin", "month_cos", "wind_dir_sin", "wind_dir_cos", "ceiling_height"}


def test_value_quality_scale_and_part(spark):
    df = spark.createDataFrame([("0123,1", "318,1,N,0061,1")], "TMP string, WND string")
    row = decode_value_quality(df, scales={"TMP": 10.0, "WND": 10.0}, parts={"WND": 3}).first()
    assert (row["label"], row["WS_num"]) == (12.3, 6.1)
    assert decode_value_quality(df).first()["WS_num"] == 318.0


def test_column_discovery(spark):
    df = spark.createDataFrame([], "AA1 string, GA2 string, AJ1 string, SKC string, TMP string")
    assert columns_with_prefix(df, PRECIPITATION_PREFIXES) == ["AA1", "GA2", "AJ1"]
    assert columns_with_prefix(df, CLOUD_PREFIXES) == ["SKC"]


def test_partition_keys_default_to_zero(spark):
    undated = spark.createDataFrame([(1.0,)], "label double")
    assert with_partition_keys(undated).select("year", "month").first() == (0, 0)
    dated = spark.createDataFrame([("2024-05-06T07:08:09",)], "DATE string")
    assert with_partition_keys(dated).select("year", "month").first() == (2024, 5)
