"""Packed text to typed columns, one projection per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions import fields

REQUIRED = ("STATION", "DATE", "TMP")
PRECIPITATION_DEFAULT = ("AA1", "AA2", "AA3", "AA4")


def decode_observations(
    df: DataFrame,
    precipitation: tuple[str, ...] = PRECIPITATION_DEFAULT,
    exact_sentinel: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Typed observation columns from the raw all-string table.

    Optional fields are decoded only when the schema has them. ``keep`` carries
    further input columns through unchanged.
    """
    present = set(df.columns)
    absent = [name for name in REQUIRED if name not in present]
    if absent:
        raise ValueError(f"raw observations lack {absent}")
    rules: list[tuple[str, str, Column]] = [
        ("STATION", "STATION", F.col("STATION")),
        ("DATE", "timestamp", fields.observation_time("DATE")),
        ("LATITUDE", "latitude", F.col("LATITUDE").try_cast("double")),
        ("LONGITUDE", "longitude", F.col("LONGITUDE").try_cast("double")),
        ("ELEVATION", "elevation", F.col("ELEVATION").try_cast("double")),
        ("NAME", "station_name", F.col("NAME")),
        ("TMP", "temperature", fields.temperature("TMP", exact_sentinel)),
        ("DEW", "dew_point", fields.temperature("DEW", exact_sentinel)),
        ("SLP", "sea_level_pressure", fields.pressure("SLP")),
        ("VIS", "visibility", fields.visibility("VIS")),
        ("WND", "wind_direction", fields.wind_direction("WND")),
        ("WND", "wind_speed", fields.wind_speed("WND")),
    ]
    columns = [expr.alias(name) for source, name, expr in rules if source in present]
    groups = [name for name in precipitation if name in present]
    columns.append(fields.precipitation_total(groups).alias("precipitation"))
    if "CIG" in present:
        columns.append(fields.ceiling_height("CIG").alias("ceiling_height"))
    return df.select(*keep, *columns)


# Source field and output column of the value-quality table.
VALUE_QUALITY_COLUMNS = (
    ("TMP", "label"),
    ("WND", "WS_num"),
    ("DEW", "DEW_num"),
    ("SLP", "SLP_num"),
    ("VIS", "VIS_num"),
)


def decode_value_quality(
    df: DataFrame,
    scales: dict[str, float] | None = None,
    parts: dict[str, int] | None = None,
) -> DataFrame:
    """Add numeric columns for ``value,quality`` fields.

    ``scales`` divides a field's value and ``parts`` picks another part, e.g.
    ``{"TMP": 10.0}`` for tenths and ``{"WND": 3}`` for the speed of a wind field.
    """
    scales, parts = scales or {}, parts or {}
    present = set(df.columns)
    if "TMP" not in present:
        raise ValueError("value-quality observations lack TMP")
    return df.withColumns({
        output: fields.plain_value(source, parts.get(source, 0), scales.get(source, 1.0))
        for source, output in VALUE_QUALITY_COLUMNS
        if source in present
    })


def columns_with_prefix(df: DataFrame, prefixes: tuple[str, ...]) -> list[str]:
    """Names of the columns that start with one of the prefixes."""
    return [name for name in df.columns if name.startswith(prefixes)]


# Prefixes of precipitation and cloud field groups.
PRECIPITATION_PREFIXES = ("AA", "GA", "AJ", "AL")
CLOUD_PREFIXES = ("SKC", "CLD", "MW", "MA", "OC")
