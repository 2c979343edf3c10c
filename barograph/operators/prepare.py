"""Feature preparation fitted in one pass, and category codes of bounded width.

``fused_plan`` takes counts, medians and moments of all numeric inputs from one
aggregate. The imputed column's deviation follows from them, so imputer, scaler
and the search for empty columns need no passes of their own. ``CategoryCodes``
keeps the most frequent categories and hashes the others, so neither the driver
nor the vectors grow with their number. Both give plain SQL stages, which can be
saved with a pipeline and keep expressions inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.derived import nan_to_null
from barograph.operators.features import FeaturePlan
from barograph.operators.moments import near_values


@dataclass(frozen=True)
class ColumnFit:
    """What preparation knows of a numeric column: values, median, and the sample deviation once gaps are filled."""

    count: int
    median: float | None
    deviation: float | None


def fit_columns(df: DataFrame, columns: list[str], relative_error: float = 1e-3) -> dict[str, ColumnFit]:
    """Fits of all ``columns`` from one aggregate; values are shifted by constants near them before squaring."""
    shifts = near_values(df, columns)
    found = []
    for i, name in enumerate(columns):
        value = nan_to_null(F.col(name).cast("double"))
        gap = value - shifts[name]
        found += [F.count(value).alias(f"n{i}"), F.sum(gap).alias(f"s{i}"), F.sum(gap * gap).alias(f"q{i}"),
                  F.percentile_approx(value, 0.5, round(1 / relative_error)).alias(f"m{i}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *found).first()
    fits = {}
    for i, name in enumerate(columns):
        count, rows, median, deviation = row[f"n{i}"], row["rows"], row[f"m{i}"], None
        if count and rows > 1:
            filled, missing = median - shifts[name], rows - count
            mean = (row[f"s{i}"] + missing * filled) / rows
            deviation = (max(0.0, row[f"q{i}"] + missing * filled * filled - rows * mean * mean) / (rows - 1)) ** 0.5
        fits[name] = ColumnFit(count, median, deviation)
    return fits


@dataclass(frozen=True)
class CategoryCodes:
    """Codes of a text column: its most frequent values in order, ``hashed`` codes for all others, the last for null."""

    column: str
    labels: tuple[str, ...]
    hashed: int

    @property
    def size(self) -> int:
        return len(self.labels) + self.hashed + 1

    @property
    def sql(self) -> str:
        column = f"`{self.column}`"
        other = f"{len(self.labels)}D + CAST(conv(substring(md5({column}), 1, 8), 16, 10) AS BIGINT) % {self.hashed}"
        if self.labels:
            pairs = ", ".join(f"{_text(label)}, {code}D" for code, label in enumerate(self.labels))
            other = f"coalesce(element_at(map({pairs}), {column}), {other})"
        return f"CASE WHEN {column} IS NULL THEN {self.size - 1}D ELSE {other} END"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def fit_categories(df: DataFrame, column: str, top: int = 100, hashed: int = 32) -> CategoryCodes:
    """Codes for ``column``, whose ``top`` most frequent values (ties by value) get one each.

    Counting is a distributed aggregate with a bounded heap behind it; only the
    chosen values reach the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).count()
    best = counts.orderBy(F.col("count").desc(), "value").limit(top).collect()
    return CategoryCodes(column, tuple(row["value"] for row in best), hashed)


def code_stage(codes: list[CategoryCodes], suffix: str = "_idx") -> SQLTransformer:
    """Stage that adds the code of every column."""
    added = ", ".join(f"{c.sql} AS `{c.column}{suffix}`" for c in codes)
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def fused_plan(
    df: DataFrame, numeric, categorical=(), scale: bool = False, suffix: str = "_imputed", relative_error: float = 1e-3,
    top: int = 100, hashed: int = 32,
) -> FeaturePlan:
    """Plan whose numeric stages are fitted already, from one pass over ``df``.

    Columns without values are left out. With ``scale`` numeric inputs are
    divided by their deviation, as ``StandardScaler`` does it; constant ones
    become 0. Categories have bounded codes, one-hot encoded.
    """
    fits = {name: fit for name, fit in fit_columns(df, list(numeric), relative_error).items() if fit.count}
    codes = [fit_categories(df, name, top, hashed) for name in categorical]
    if not fits and not codes:
        raise ValueError("no feature columns left to assemble")

    def prepared(name: str, fit: ColumnFit) -> str:
        value = f"coalesce(nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE)), {fit.median!r}D)"
        if scale:
            value = f"{value} / {fit.deviation!r}D" if fit.deviation else f"{value} * 0D"
        return f"{value} AS `{name}{suffix}`"

    stages: list = []
    if fits:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(prepared(n, f) for n, f in fits.items())} FROM __THIS__"))
    inputs = [f"{name}{suffix}" for name in fits]
    if codes:
        names = [c.column for c in codes]
        stages.append(code_stage(codes))
        stages.append(OneHotEncoder(inputCols=[f"{n}_idx" for n in names], outputCols=[f"{n}_oh" for n in names],
                                    handleInvalid="keep", dropLast=False))
        inputs += [f"{n}_oh" for n in names]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return FeaturePlan(stages, inputs)
