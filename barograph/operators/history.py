"""Lag, rolling and station features.

The windows run over an hourly series, one row per station and hour. The
averaging before them combines rows on the map side, so a station with a large
share of all observations still gives at most one row per hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.functions.derived import epoch_hour
from barograph.session import materialize

HOUR = 3600
# Stations whose averages may be broadcast: some 50 bytes each.
BROADCAST_ROWS = 500_000


def hourly_series(df: DataFrame, station: str, timestamp: str, values: list[str]) -> DataFrame:
    """Mean of each value per station and hour (``hour_epoch``, seconds)."""
    return (
        df.where(F.col(timestamp).isNotNull())
        .groupBy(F.col(station), epoch_hour(F.col(timestamp)).alias("hour_epoch"))
        .agg(*[F.avg(value).alias(value) for value in values])
    )


def hours_earlier(value: str, hours: int, station: str) -> Column:
    """The value exactly ``hours`` earlier, NULL when that hour has no row."""
    frame = Window.partitionBy(station).orderBy("hour_epoch").rangeBetween(
        -HOUR * hours, -HOUR * hours)
    return F.max(value).over(frame)


def rolling_mean(value: str, hours: int, station: str) -> Column:
    """Mean of the ``hours`` before the row, the row itself excluded."""
    frame = Window.partitionBy(station).orderBy("hour_epoch").rangeBetween(-HOUR * hours, -1)
    return F.avg(value).over(frame)


def history_features(
    hourly: DataFrame, station: str = "STATION",
    temperature: str = "temperature", pressure: str = "sea_level_pressure",
) -> DataFrame:
    """Lags, 3-hour mean and 1-hour change from past values only."""
    lagged = hourly.select(
        "*",
        *[hours_earlier(temperature, k, station).alias(f"temp_lag_{k}h") for k in (1, 2, 3)],
        hours_earlier(pressure, 1, station).alias("pressure_lag_1h"),
        rolling_mean(temperature, 3, station).alias("temp_rolling_3h"))
    return lagged.withColumn("temp_change_1h", F.col("temp_lag_1h") - F.col("temp_lag_2h"))


HISTORY_COLUMNS = (
    "temp_lag_1h", "temp_lag_2h", "temp_lag_3h", "pressure_lag_1h",
    "temp_rolling_3h", "temp_change_1h",
)


def attach_history(
    df: DataFrame, features: DataFrame, station: str = "STATION", timestamp: str = "timestamp"
) -> DataFrame:
    """Give every observation the history features of its station and hour."""
    keyed = df.withColumn("hour_epoch", epoch_hour(F.col(timestamp)))
    wanted = features.select(station, "hour_epoch", *HISTORY_COLUMNS)
    return keyed.join(wanted, [station, "hour_epoch"], "left").drop("hour_epoch")


# Station averages by source column.
STATION_AVERAGES = {
    "temperature": "station_avg_temp",
    "dew_point": "station_avg_dew",
    "sea_level_pressure": "station_avg_pressure",
}


def fit_station_stats(
    train: DataFrame, station: str = "STATION", averages: dict[str, str] | None = None
) -> DataFrame:
    """Averages per station; fit on training rows only."""
    averages = STATION_AVERAGES if averages is None else averages
    return train.groupBy(station).agg(
        *[F.avg(source).alias(name) for source, name in averages.items()])


def apply_station_stats(
    df: DataFrame, stats: DataFrame, station: str = "STATION",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of the station averages; unseen stations get NULL.

    The averages are checkpointed and counted first (an action). Up to
    ``broadcast_rows`` stations are broadcast, so that the observations need no
    shuffle; more stations are joined by shuffle, where adaptive execution
    splits a station with a large share of the rows.
    """
    stats = materialize(stats)
    if stats.count() <= broadcast_rows:
        stats = F.broadcast(stats)
    return df.join(stats, station, "left")
