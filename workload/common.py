"""Loading, rounding and registration shared by all queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.session import configure, scratch_path
from barograph.sources.tables import read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and their SQL counterparts by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def register(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.oracles[function.__name__] = sql
            return function
        return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in a session with the package's settings."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back.

    Models read their rows many times; a written table is decoded once and
    outlives a lost executor. The rebalance gives files of a good size at any
    scale.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df.hint("rebalance"), path)
    return read_table(spark, path)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round the given columns, all double columns by default."""
    names = columns or tuple(name for name, kind in df.dtypes if kind == "double")
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def every(key: str, modulus: int) -> Column:
    return F.col(key) % modulus == 0


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    """SQL: rounded double without negative zero."""
    value = f"round(CAST({expr} AS DOUBLE), {digits})"
    return f"(CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END) AS {name or expr}"


def hash_bucket_sql(key: str, buckets: int = 100) -> str:
    """SQL: the bucket of ``hash_bucket`` for one key."""
    return f"(CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % {buckets})"


def is_train_sql(key: str) -> str:
    return f"{hash_bucket_sql(key)} < 70"
