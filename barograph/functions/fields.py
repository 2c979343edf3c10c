"""Decoders for packed observation fields.

A packed field is a comma-separated string whose parts hold a scaled value and
quality codes. All decoders are native expressions that return NULL (never an
error) on short or malformed text, also under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Precipitation groups that carry a depth.
PRECIPITATION_GROUPS = ("AA1", "AA2", "AA3", "AA4", "GA1", "GA2", "GA3")

# Missing-value codes of the packed fields.
MISSING_TEMPERATURE = "+9999"
MISSING_TEMPERATURE_EXACT = "+9999,9"
MISSING_DIRECTION = "999"
MISSING_SPEED = "9999"
MISSING_PRESSURE = "99999"
MISSING_VISIBILITY = "999999"
MISSING_CEILING = "99999"
MISSING_DEPTH = "9999"
MISSING_PLAIN = "M"


def part(column: str, index: int) -> Column:
    """Text of one comma-separated part, NULL when the field is too short."""
    if index == 0:
        return F.substring_index(F.col(column), ",", 1)
    return F.get(F.split(F.col(column), ","), F.lit(index))


def number(text: Column, scale: float = 1.0) -> Column:
    value = text.try_cast("double")
    return value if scale == 1.0 else value / F.lit(scale)


def temperature(column: str, exact_sentinel: bool = False) -> Column:
    """Degrees Celsius from tenths: ``-0070,1`` is -7.0.

    The missing code is recognised in the value part. With ``exact_sentinel``
    only the whole text ``+9999,9`` counts as missing.
    """
    if exact_sentinel:
        missing = F.col(column) == MISSING_TEMPERATURE_EXACT
    else:
        missing = part(column, 0) == MISSING_TEMPERATURE
    return F.when(~missing, number(part(column, 0), 10.0))


def wind_direction(column: str) -> Column:
    """Degrees from the first part: ``318,1,N,0061,1`` is 318."""
    direction = part(column, 0)
    return F.when(direction != MISSING_DIRECTION, direction.try_cast("int"))


def wind_speed(column: str) -> Column:
    """Metres per second from the fourth part: ``318,1,N,0061,1`` is 6.1."""
    speed = part(column, 3)
    return F.when(speed != MISSING_SPEED, number(speed, 10.0))


def pressure(column: str) -> Column:
    """Hectopascal from tenths: ``10208,1`` is 1020.8."""
    return F.when(~F.col(column).contains(MISSING_PRESSURE), number(part(column, 0), 10.0))


def visibility(column: str) -> Column:
    """Metres: ``025000,1,9,9`` is 25000."""
    return F.when(~F.col(column).contains(MISSING_VISIBILITY), number(part(column, 0)))


def ceiling_height(column: str) -> Column:
    """Metres: ``00800,1,9,9`` is 800."""
    return F.when(~F.col(column).contains(MISSING_CEILING), number(part(column, 0)))


def precipitation_depth(column: str) -> Column:
    """Millimetres from tenths in the second part: ``24,0002,3,1`` is 0.2.

    Missing or malformed depth counts as 0.0; a name that is no precipitation
    group gives NULL.
    """
    if column not in PRECIPITATION_GROUPS:
        return F.lit(None).cast("double")
    depth = F.when(~F.col(column).contains(MISSING_DEPTH), number(part(column, 1), 10.0))
    return F.coalesce(depth, F.lit(0.0))


def precipitation_total(columns: list[str]) -> Column:
    """Sum of the depths of several groups, 0.0 for none."""
    total = F.lit(0.0)
    for column in columns:
        total = total + precipitation_depth(column)
    return total


def plain_value(column: str, index: int = 0, scale: float = 1.0) -> Column:
    """``value,quality`` number; NULL for empty text or ``M``."""
    usable = (F.col(column) != "") & (F.col(column) != MISSING_PLAIN)
    return F.when(usable, number(part(column, index), scale))


def observation_time(column: str) -> Column:
    return F.try_to_timestamp(F.col(column))
