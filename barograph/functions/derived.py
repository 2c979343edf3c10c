"""Derived-feature expressions: calendar, cycles, humidity, errors, ranges."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnus formula constants.
MAGNUS_A = 17.625
MAGNUS_B = 243.04

# Label ranges (lower bound inclusive, upper bound exclusive).
LABEL_RANGES = (
    (None, 0.0, "Below 0°C"),
    (0.0, 10.0, "0-10°C"),
    (10.0, 20.0, "10-20°C"),
    (20.0, 30.0, "20-30°C"),
    (30.0, None, "Above 30°C"),
)


def cycle(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of ``period``; NULL stays NULL."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def relative_humidity(dew_point: Column, temperature: Column) -> Column:
    """Percent, from the Magnus formula.

    It reads the temperature, so it must not be a feature when temperature is
    the label.
    """
    def exponent(value: Column) -> Column:
        return F.lit(MAGNUS_A) * value / (F.lit(MAGNUS_B) + value)

    return F.lit(100.0) * F.exp(exponent(dew_point) - exponent(temperature))


def nan_to_null(value: Column) -> Column:
    """Double with NaN replaced by NULL; text that is no number is NULL."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def label_range_id(label: Column) -> Column:
    """0-based number of the label range, in order of temperature."""
    chosen = None
    for position, (_, upper, _) in enumerate(LABEL_RANGES[:-1]):
        below = label < F.lit(upper)
        chosen = F.when(below, position) if chosen is None else chosen.when(below, position)
    return chosen.otherwise(len(LABEL_RANGES) - 1)


def label_range(label: Column) -> Column:
    """Name of the label range."""
    names = F.array(*[F.lit(name) for _, _, name in LABEL_RANGES])
    return F.get(names, label_range_id(label))


def epoch_hour(timestamp: Column) -> Column:
    """Start of the hour in seconds since 1970."""
    seconds = F.unix_seconds(timestamp.cast("timestamp"))
    return seconds - F.pmod(seconds, F.lit(3600))
