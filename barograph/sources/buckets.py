"""Bucketed tables: rows of one station lie together, so work by station needs no shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """How a table is laid out: by a hash of ``key``, in ``count`` files sorted by ``key`` and ``sort``."""

    key: str
    count: int
    sort: tuple[str, ...] = ()


#: Times an even share that one bucket may hold.
MOST_UNEVEN = 4.0


def largest_bucket(df: DataFrame, layout: Buckets) -> float:
    """Rows of the largest bucket over the rows of an even one; 0 for an empty table."""
    counts = df.groupBy(F.pmod(F.hash(layout.key), F.lit(layout.count))).count()
    most, total = counts.agg(F.max("count"), F.sum("count")).first()
    return most * layout.count / total if total else 0.0


def write_bucketed(df: DataFrame, path: str, name: str, layout: Buckets, most_uneven: float = MOST_UNEVEN) -> DataFrame:
    """Overwrite the table ``name``, whose files lie below ``path``, and open it.

    A bucket is read by one task. Where a hot key makes one larger than
    ``most_uneven`` even shares, this refuses, and the table is better left to
    shuffles, which combine rows first and split a hot key.
    """
    uneven = largest_bucket(df, layout)
    if uneven > most_uneven:
        raise ValueError(f"the largest bucket of {layout.key} has {uneven:.1f} times an even share")
    rows = df.repartition(layout.count, layout.key)
    (rows.write.bucketBy(layout.count, layout.key).sortBy(layout.key, *layout.sort)
     .mode("overwrite").option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, name: str, layout: Buckets) -> DataFrame:
    """A table of ``write_bucketed`` in a session whose catalogue does not know it."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in spark.read.parquet(path).schema.fields)
    sort = ", ".join(f"`{column}`" for column in (layout.key, *layout.sort))
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{layout.key}`) SORTED BY ({sort}) "
              f"INTO {layout.count} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@contextmanager
def joins_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Within this, a join on the bucket key and others takes the tables as they lie.

    Spark else demands a shuffle by all keys of the join. Plans are made when
    they run, so the result must be written or collected inside.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
