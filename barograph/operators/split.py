"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

BUCKETS = 100


def key_hash(df: DataFrame, keys: list[str], salt: str = "") -> Column:
    """MD5 of the keys of a row as hexadecimal text, NULL as empty."""
    if not keys:
        raise ValueError("a hash of a row needs at least one key column")
    types = {field.name: field.dataType for field in df.schema.fields}

    def text(name: str) -> Column:
        value = F.col(name)
        if isinstance(types[name], TimestampType):
            value = F.unix_micros(value)
        return F.coalesce(value.cast("string"), F.lit(""))

    parts = [text(name) for name in keys]
    if salt:
        parts.insert(0, F.lit(salt))
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("|", *parts))


def hash_bucket(df: DataFrame, keys: list[str], buckets: int = BUCKETS, salt: str = "") -> Column:
    """Bucket number of a row from the MD5 of its keys.

    It depends on the key values only, so the result is the same for every
    partitioning and run. Another ``salt`` gives an independent assignment.
    """
    return F.conv(F.substring(key_hash(df, keys, salt), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def hash_split(
    df: DataFrame, keys: list[str], weights: dict[str, int] | None = None, name: str = "split"
) -> DataFrame:
    """Add the split part of each row; weights are hundredths and sum to 100."""
    weights = {"train": 70, "test": 30} if weights is None else weights
    if sum(weights.values()) != BUCKETS:
        raise ValueError(f"split weights must sum to {BUCKETS}: {weights}")
    bucket = hash_bucket(df, keys)
    chosen, edge = None, 0
    for part, weight in list(weights.items())[:-1]:
        edge += weight
        test = bucket < F.lit(edge)
        chosen = F.when(test, part) if chosen is None else chosen.when(test, part)
    last = list(weights)[-1]
    return df.withColumn(name, F.lit(last) if chosen is None else chosen.otherwise(last))


def split_parts(df: DataFrame, parts=("train", "test"), name: str = "split") -> tuple[DataFrame, ...]:
    """The parts of a split table as separate tables."""
    return tuple(df.where(F.col(name) == part).drop(name) for part in parts)


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Spark's random split; the rows change with the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed=seed)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(fraction=fraction, seed=seed)


def time_split(df: DataFrame, timestamp: str, cutoff: str, name: str = "split") -> DataFrame:
    """Rows before the cutoff are train, all others test; no time, no part."""
    before = F.col(timestamp) < F.lit(cutoff).cast(df.schema[timestamp].dataType)
    return df.withColumn(name, F.when(before, "train").when(~before, "test"))


def with_fold(df: DataFrame, keys: list[str], folds: int, name: str = "fold") -> DataFrame:
    """Add a reproducible fold number for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(name, hash_bucket(df, keys, folds, salt="fold").cast("int"))


def with_period(df: DataFrame, timestamp: str, unit: str = "month", name: str = "period") -> DataFrame:
    """Add the number of the calendar ``unit`` (month, week, day) a row lies in, counted without gaps in the calendar."""
    at = F.col(timestamp).cast("timestamp_ntz")
    epoch = F.lit("1970-01-05").cast("timestamp_ntz")  # a Monday, and the first whole week
    start = {"month": F.year(at) * 12 + F.month(at) - 1,
             "week": F.floor(F.datediff(F.to_date(at), F.to_date(epoch)) / 7),
             "day": F.datediff(F.to_date(at), F.to_date(epoch))}[unit]
    return df.withColumn(name, start.cast("int"))


def rolling_folds(periods, folds: int) -> list[tuple[list[int], list[int]]]:
    """Training and held-out periods of the last ``folds`` origins: each period is predicted from all before it."""
    ordered = sorted({p for p in periods if p is not None})
    if len(ordered) <= folds:
        raise ValueError(f"{folds} rolling folds need more than {len(ordered)} periods")
    return [(ordered[:k], [ordered[k]]) for k in range(len(ordered) - folds, len(ordered))]
