"""Projections that add derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions import derived

# Features of the 14-feature generation, in model order.
FEATURES_14 = (
    "latitude", "longitude", "elevation",
    "dew_point", "sea_level_pressure", "visibility",
    "wind_speed", "wind_dir_sin", "wind_dir_cos",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
    "precipitation",
)

# The 15-feature generation, complete features first.
FEATURES_15_COMPLETE = (
    "latitude", "longitude", "elevation",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
    "precipitation",
)
FEATURES_15_NULLABLE = (
    "dew_point", "sea_level_pressure", "visibility",
    "wind_speed", "wind_dir_sin", "wind_dir_cos",
    "ceiling_height",
)

# Numeric candidates of the value-quality generation, by model.
# Left out, as they are the label or computed from it: temperature, humidity and
# the difference of dew point and temperature.
CANDIDATES_FOREST = (
    "DEW_num", "WS_num", "SLP_num", "VIS_num",
    "LAT", "LON", "ELEVATION",
    "hour", "dayofyear", "month", "hour_sin", "hour_cos", "doy_sin", "doy_cos",
)
CANDIDATES_BOOSTED = (
    "DEW_num", "WS_num", "SLP_num", "VIS_num",
    "LAT", "LON", "ELEVATION",
    "hour", "dayofyear", "month",
)
CANDIDATES_LINEAR = (
    "DEW_num", "SLP_num", "VIS_num", "WND_dir_num", "WND_speed_num",
    "CIG_num", "PRECIP_num", "LATITUDE", "LONGITUDE", "ELEVATION",
    "hour", "dayofyear", "month",
)
CATEGORIES = ("COUNTRY", "REPORT_TYPE")
CATEGORIES_LINEAR = ("REPORT_TYPE",)


def with_calendar(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add year, month, day and hour."""
    ts = F.col(timestamp)
    return df.withColumns({
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
    })


def with_cycles(df: DataFrame, cycles: dict[str, tuple[str, float]]) -> DataFrame:
    """Add ``<prefix>_sin`` and ``<prefix>_cos`` for each ``prefix: (column, period)``."""
    added = {}
    for prefix, (column, period) in cycles.items():
        added[f"{prefix}_sin"], added[f"{prefix}_cos"] = derived.cycle(F.col(column), period)
    return df.withColumns(added)


def with_day_of_year(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add dayofyear with its sine and cosine over a 365.25-day year."""
    dated = df.withColumn("dayofyear", F.dayofyear(timestamp))
    return with_cycles(dated, {"doy": ("dayofyear", 365.25)})


def derive_features(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Calendar parts and the hour, month and wind-direction cycles."""
    cycles = {"hour": ("hour", 24), "month": ("month", 12)}
    if "wind_direction" in df.columns:
        cycles["wind_dir"] = ("wind_direction", 360)
    return with_cycles(with_calendar(df, timestamp), cycles)


def with_humidity(
    df: DataFrame, dew_point: str = "dew_point", temperature: str = "temperature",
    name: str = "relative_humidity",
) -> DataFrame:
    """Add relative humidity in percent; a report column, not a feature."""
    return df.withColumn(name, derived.relative_humidity(F.col(dew_point), F.col(temperature)))


def clean_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to double and turn NaN into NULL, for the columns that exist."""
    present = available(df, columns)
    return df.withColumns({name: derived.nan_to_null(F.col(name)) for name in present})


def with_partition_keys(df: DataFrame, date: str = "DATE") -> DataFrame:
    """Add year and month from a date text, 0 and 0 where the table has no date."""
    if {"year", "month"} <= set(df.columns):
        return df
    if date not in df.columns:
        return df.withColumns({"year": F.lit(0), "month": F.lit(0)})
    timed = df.withColumn("ts", F.try_to_timestamp(F.col(date)))
    return timed.withColumns({"year": F.year("ts"), "month": F.month("ts")})


def available(df: DataFrame, candidates) -> list[str]:
    """Candidates the table has, in candidate order."""
    present = set(df.columns)
    return [name for name in candidates if name in present]


def select_features(df: DataFrame, features, target: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features and the target as ``label``, labelled rows only."""
    return df.where(F.col(target).isNotNull()).select(
        *keep, *features, F.col(target).alias("label"))


def with_errors(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Add error, abs_error and squared_error."""
    error = F.col(label) - F.col(prediction)
    return df.withColumns({
        "error": error, "abs_error": F.abs(error), "squared_error": error * error,
    })


def with_label_range(df: DataFrame, label: str = "label") -> DataFrame:
    """Add range_id (sorts by temperature) and temp_range."""
    return df.withColumns({
        "range_id": derived.label_range_id(F.col(label)),
        "temp_range": derived.label_range(F.col(label)),
    })
