"""Table profiles: counts, missing values and statistics, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from barograph.operators.quality import percent


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _float_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}


def _per_column(df: DataFrame, columns: list[str], measures) -> DataFrame:
    """One aggregate over ``df``, turned into one row per column.

    ``measures(name)`` maps a measure to its aggregate. All measures of a name
    must have the same type across columns.
    """
    structs = F.array(*[
        F.struct(
            F.lit(position).alias("column_id"), F.lit(name).alias("column"),
            *[expr.alias(measure) for measure, expr in measures(name).items()])
        for position, name in enumerate(columns)
    ])
    return df.agg(structs.alias("lines")).select(F.inline("lines"))


def _statistics(value: Column, nan_count: Column) -> dict[str, Column]:
    return {
        "count": F.count(value), "nan_count": nan_count,
        "mean": F.avg(value), "stddev": F.stddev_samp(value),
        "min": F.min(value), "max": F.max(value),
    }


def _number(df: DataFrame, name: str) -> tuple[Column, Column]:
    """NaN-free double value of a numeric column and its NaN count."""
    number = F.col(name).cast("double")
    if name in _float_columns(df):
        return F.when(~F.isnan(number), number), F.count_if(F.isnan(number))
    return number, F.lit(0).cast("bigint")


def summary_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, NaN count, mean, sample deviation, minimum and maximum per column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    return _per_column(df, columns, lambda name: _statistics(*_number(df, name)))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL and non-NULL counts with the NULL percentage per column."""
    columns = df.columns if columns is None else list(columns)
    return _missing(df, columns, lambda name: F.col(name).isNull())


def typed_null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """As ``null_profile``, with NaN counted as missing in float and double columns."""
    columns = df.columns if columns is None else list(columns)
    floats = _float_columns(df)

    def missing(name: str) -> Column:
        value = F.col(name)
        return value.isNull() | F.isnan(value) if name in floats else value.isNull()

    return _missing(df, columns, missing)


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, over all columns of the table."""
    return null_profile(df).where(F.col("null_count") > 0)


def _missing(df: DataFrame, columns: list[str], missing) -> DataFrame:
    counted = _per_column(df, columns, lambda name: {
        "null_count": F.count_if(missing(name)), "row_count": F.count(F.lit(1)),
    })
    return counted.select(
        "column_id", "column",
        (F.col("row_count") - F.col("null_count")).alias("non_null_count"),
        "null_count",
        percent(F.col("null_count"), F.col("row_count")).alias("null_pct"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, NaNs and numeric statistics."""
    types, numeric = dict(df.dtypes), set(numeric_columns(df))

    def measures(name: str) -> dict[str, Column]:
        if name in numeric:
            value, nan_count = _number(df, name)
        else:
            value, nan_count = F.lit(None).cast("double"), F.lit(0).cast("bigint")
        stats = _statistics(value, nan_count)
        del stats["count"]
        return {
            "dtype": F.lit(types[name]), "row_count": F.count(F.lit(1)),
            "null_count": F.count_if(F.col(name).isNull()), **stats,
        }

    return _per_column(df, df.columns, measures)
