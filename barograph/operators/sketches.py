"""Profiles that can be merged: one row of counts, moments and sketches per period and column.

A profile of a large table is kept by year and month (and split, if wanted).
New data replace the rows of their own months; the profile of any choice of
periods follows from the small table alone. Counts, means, deviations and limits
are exact, quantiles and distinct counts come from bounded sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.profile import _number, numeric_columns
from barograph.operators.quality import percent
from barograph.sources.tables import PARTITION_KEYS, read_table, replace_partitions

#: Items of a quantile sketch; quantiles of as many values are exact.
SKETCH_ITEMS = 8_192
#: Binary logarithm of the registers of a distinct-count sketch.
DISTINCT_BITS = 12
QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def rank_error(items: int = SKETCH_ITEMS) -> float:
    """Largest distance of a sketch quantile's rank from the rank asked for, with 99 % confidence, as a share of the values."""
    return 2.296 / items ** 0.9021


def profile_sketches(df: DataFrame, columns: list[str] | None = None, keys=PARTITION_KEYS, items: int = SKETCH_ITEMS) -> DataFrame:
    """One row for each value of ``keys`` and each column, in one aggregate.

    NaN counts as a value of its own and enters no statistic. Columns that are
    not numeric have counts only.
    """
    columns = [c for c in df.columns if c not in keys] if columns is None else list(columns)
    types, numeric = dict(df.dtypes), set(numeric_columns(df))

    def line(position: int, name: str) -> Column:
        value, nans = _number(df, name) if name in numeric else (F.lit(None).cast("double"), F.lit(0).cast("bigint"))
        found = {
            "rows": F.count(F.lit(1)), "null_count": F.count_if(F.col(name).isNull()), "nan_count": nans, "count": F.count(value),
            "mean": F.avg(value), "spread": F.var_pop(value) * F.count(value), "min": F.min(value), "max": F.max(value),
            "quantiles": F.kll_sketch_agg_double(value, F.lit(items)),
            "distinct": F.hll_sketch_agg(F.col(name).cast("string"), F.lit(DISTINCT_BITS)),
        }
        return F.struct(F.lit(position).alias("column_id"), F.lit(name).alias("column"), F.lit(types[name]).alias("dtype"),
                        *[column.alias(measure) for measure, column in found.items()])

    lines = F.array(*[line(i, c) for i, c in enumerate(columns)])
    return df.groupBy(*keys).agg(lines.alias("lines")).select(*keys, F.inline("lines"))


def merge_sketches(table: DataFrame, *by: str, items: int = SKETCH_ITEMS) -> DataFrame:
    """Rows of ``table`` merged by column and ``by``; itself such a table."""
    part = F.struct("count", "mean", "spread")

    def joined(a: Column, b: Column) -> Column:
        count = a["count"] + b["count"]
        gap = b["mean"] - a["mean"]
        return F.when(b["count"] == 0, a).when(a["count"] == 0, b).otherwise(F.struct(
            count.alias("count"), (a["mean"] + gap * b["count"] / count).alias("mean"),
            (a["spread"] + b["spread"] + gap * gap * a["count"] * b["count"] / count).alias("spread")))

    nothing = F.struct(F.lit(0).cast("bigint").alias("count"), F.lit(None).cast("double").alias("mean"),
                       F.lit(None).cast("double").alias("spread"))
    merged = table.groupBy(*by, "column_id", "column", "dtype").agg(
        *[F.sum(c).alias(c) for c in ("rows", "null_count", "nan_count")],
        F.array_sort(F.collect_list(part)).alias("moments"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(items)).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))
    whole = merged.withColumn("moments", F.aggregate("moments", nothing, joined))
    return whole.select(*by, "column_id", "column", "dtype", "rows", "null_count", "nan_count", "moments.*",
                        "min", "max", "quantiles", "distinct")


def sketch_statistics(merged: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Readable statistics of every row: counts, null share, mean, sample deviation, limits, quantiles, distinct values."""
    quantiles = QUANTILES if quantiles is None else quantiles
    measures = ("column_id", "column", "dtype", "rows", "null_count", "nan_count", "count", "mean", "spread", "min", "max", "quantiles", "distinct")
    some = F.col("count") > 0
    return merged.select(
        *[c for c in merged.columns if c not in measures], "column_id", "column", "dtype", "rows", "null_count", "nan_count",
        percent(F.col("null_count"), F.col("rows")).alias("null_pct"), "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("spread") / (F.col("count") - 1))).alias("stddev"), "min", "max",
        *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(share))).alias(name) for name, share in quantiles.items()],
        F.hll_sketch_estimate("distinct").alias("distinct_values"))


def sketch_ranks(merged: DataFrame, value: Column) -> DataFrame:
    """Share of values at or below ``value``, a column of ``merged``, by its sketch."""
    return merged.withColumn("rank", F.when(F.col("count") > 0, F.kll_sketch_get_rank_double("quantiles", value)))


def update_profile(df: DataFrame, path: str, columns: list[str] | None = None, keys=PARTITION_KEYS) -> None:
    """Write the sketches of the periods ``df`` has below ``path``; all other periods stay as they are.

    ``df`` must hold its periods whole.
    """
    replace_partitions(profile_sketches(df, columns, keys), path, keys)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)
