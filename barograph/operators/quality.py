"""Row rules, fills and the reports that go with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.operators.quantile import approximate_medians, exact_medians

# Physical limits.
TEMPERATURE_LIMITS = (-90.0, 60.0)
PRESSURE_LIMITS = (950.0, 1050.0)


def plausible_range(column: str, low: float, high: float, nullable: bool) -> Column:
    """Inside the closed range; NULL passes only when ``nullable``."""
    return F.coalesce(F.col(column).between(low, high), F.lit(nullable))


def standard_rules(target: str = "temperature") -> dict[str, Column]:
    """The four observation rules in the order they apply. Never NULL."""
    return {
        "target_present": F.col(target).isNotNull(),
        "target_plausible": plausible_range(target, *TEMPERATURE_LIMITS, nullable=False),
        "dew_point_consistent": F.coalesce(F.col("dew_point") <= F.col(target), F.lit(True)),
        "pressure_plausible": plausible_range(
            "sea_level_pressure", *PRESSURE_LIMITS, nullable=True),
    }


def quality_filter(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows that pass every rule."""
    rules = standard_rules() if rules is None else rules
    return df.where(reduce(lambda left, right: left & right, rules.values()))


def tag_rejections(
    df: DataFrame, rules: dict[str, Column] | None = None, name: str = "rejected_by"
) -> DataFrame:
    """Add the name of the first rule a row fails, NULL for rows that pass."""
    rules = standard_rules() if rules is None else rules
    failed = [F.when(~passes, F.lit(rule)) for rule, passes in rules.items()]
    return df.withColumn(name, F.coalesce(*failed) if len(failed) > 1 else failed[0])


def rejection_counts(rules: dict[str, Column], name: str = "rejected_by") -> list[Column]:
    """Aggregates over a tagged table: rows_in, rows_kept and one count per rule."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(name).isNull()).alias("rows_kept"),
        *[F.count_if(F.col(name) == rule).alias(rule) for rule in rules],
    ]


def quality_report(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row per rule: rows it rejects first, in one pass over ``df``."""
    rules = standard_rules() if rules is None else rules
    totals = tag_rejections(df, rules).agg(*rejection_counts(rules))
    lines = F.array(*[
        F.struct(F.lit(position).alias("rule_id"), F.lit(rule).alias("rule"),
                 F.col(rule).alias("rows_rejected"))
        for position, rule in enumerate(rules)
    ])
    return totals.select("rows_in", "rows_kept", F.inline(lines)).select(
        "rule_id", "rule", "rows_rejected", "rows_in", "rows_kept",
        percent(F.col("rows_kept"), F.col("rows_in")).alias("retention_pct"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without NULL or NaN in the given columns."""
    return df.na.drop(subset=list(columns))


def fit_median_fill(
    df: DataFrame, columns: list[str], relative_error: float | None = 1e-3
) -> dict[str, float]:
    """Median per column, 0.0 for a column without values.

    ``relative_error=None`` gives the exact lower median. Fit on training rows
    and apply to both parts of a split.
    """
    if relative_error is None:
        found = exact_medians(df, columns)
    else:
        found = approximate_medians(df, columns, relative_error)
    return {name: 0.0 if value is None else value for name, value in found.items()}


def apply_median_fill(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.fillna(medians)
