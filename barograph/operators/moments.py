"""Linear models from sufficient statistics.

Counts, means and cross-products of the features and the label say all a
penalised linear model needs: its coefficients for every penalty and its squared
error on any rows the statistics cover. They are collected for every fold in one
aggregate and added up, so a whole search over penalties and folds reads its
rows once; what reaches the driver depends on the number of columns, not of rows.

A missing value that is to be imputed counts as zero in its column and one in a
column of its own. Whatever median is put in its place afterwards, the moments of
the filled column follow from those of the two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.derived import nan_to_null

#: Items a quantile sketch keeps of a column; medians of as many values are exact.
SKETCH_ITEMS = 8_192


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred cross-products of some columns; the last one is the label."""

    rows: int
    mean: np.ndarray
    scatter: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        rows = self.rows + other.rows
        if not self.rows or not other.rows:
            return self if self.rows else other
        gap = other.mean - self.mean
        return Moments(rows, self.mean + gap * (other.rows / rows),
                       self.scatter + other.scatter + np.outer(gap, gap) * (self.rows * other.rows / rows))

    def mapped(self, matrix: np.ndarray, shift: np.ndarray) -> "Moments":
        """Moments of ``matrix @ columns + shift``."""
        return Moments(self.rows, matrix @ self.mean + shift, matrix @ self.scatter @ matrix.T)

    def of(self, columns: list[int]) -> "Moments":
        """Moments of some features, by position, and the label."""
        chosen = [*columns, len(self.mean) - 1]
        return Moments(self.rows, self.mean[chosen], self.scatter[np.ix_(chosen, chosen)])


@dataclass(frozen=True)
class Line:
    """A fitted linear model."""

    coefficients: np.ndarray
    intercept: float

    def prediction(self, features: list[str]) -> Column:
        return reduce(lambda a, b: a + b, (F.col(f) * float(c) for f, c in zip(features, self.coefficients)), F.lit(self.intercept))

    def squared_error(self, moments: Moments) -> float:
        """Mean squared error on the rows of ``moments``."""
        slope = np.append(-self.coefficients, 1.0)
        gap = moments.mean @ slope - self.intercept
        return max(0.0, float(slope @ moments.scatter @ slope)) / moments.rows + float(gap) ** 2


def fit_line(moments: Moments, penalty: float = 0.0) -> Line:
    """Least squares with a squared penalty on standardised features, scaled by the label's deviation as Spark does it.

    Features that are constant or depend on others get the shortest solution.
    """
    covariance = moments.scatter / moments.rows
    inner, cross, spread = covariance[:-1, :-1], covariance[:-1, -1], np.sqrt(covariance[-1, -1])
    deviation = np.sqrt(np.diag(inner))
    varied = deviation > 1e-12 * np.maximum(1.0, np.abs(moments.mean[:-1]))
    coefficients = np.zeros(len(inner))
    if varied.any() and spread > 0:
        scale = deviation[varied]
        normal = inner[np.ix_(varied, varied)] / np.outer(scale, scale) + np.eye(varied.sum()) * (penalty / spread)
        coefficients[varied] = np.linalg.lstsq(normal, cross[varied] / scale, rcond=1e-12)[0] / scale
    return Line(coefficients, float(moments.mean[-1] - coefficients @ moments.mean[:-1]))


def _lower_half(names: list[str]):
    return [(i, j) for i in range(len(names)) for j in range(i + 1)]


def moment_table(df: DataFrame, features: list[str], label: str = "label", by: str | None = None,
                 impute: tuple[str, ...] = (), shifts: dict[str, float] | None = None) -> DataFrame:
    """One row for each value of ``by`` (null: all rows) with rows, sums, products and sketches for medians.

    Values are shifted by constants near them, so that squares of far-off values
    do not swallow the differences. Rows without a label, and rows without a
    feature that is not imputed, do not count.
    """
    shifts = shifts or {}
    value = {c: nan_to_null(F.col(c)) - float(shifts.get(c, 0.0)) for c in (*features, label)}
    needed = [c for c in features if c not in impute] + [label]
    rows = df.where(reduce(lambda a, b: a & b, (value[c].isNotNull() for c in needed)))
    columns = [F.coalesce(value[c], F.lit(0.0)) if c in impute else value[c] for c in features]
    columns += [value[c].isNull().cast("double") for c in impute] + [value[label]]
    names = [f"_m{i}" for i in range(len(columns))]
    group = F.lit(None).cast("int") if by is None else F.col(by)
    narrow = rows.select(group.alias("part"), *[c.alias(n) for c, n in zip(columns, names)],
                         *[nan_to_null(F.col(c)).alias(f"_v{i}") for i, c in enumerate(impute)])
    return narrow.groupBy("part").agg(
        F.count("*").alias("rows"), F.array(*[F.sum(n) for n in names]).alias("sums"),
        F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in _lower_half(names)]).alias("products"),
        *[F.kll_sketch_agg_double(f"_v{i}", F.lit(SKETCH_ITEMS)).alias(f"sketch_{i}") for i in range(len(impute))])


def near_values(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """A value of every column, from the first rows; 0 where these have none."""
    first = df.select(*[nan_to_null(F.col(c)).alias(c) for c in columns]).limit(100)
    row = first.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns]).first()
    return {c: float(row[c]) if row[c] is not None else 0.0 for c in columns}


class GroupedMoments:
    """Moments by fold or part, which can be added up in any choice."""

    def __init__(self, table: DataFrame, features: list[str], label: str, impute: tuple[str, ...], shifts: dict[str, float]) -> None:
        self.features, self.impute, self.shifts = list(features), tuple(impute), shifts
        self.label, self.table = label, table
        self.parts: dict = {}
        self.sketches: dict = {}
        for row in table.collect():
            size = len(row["sums"])
            products = np.zeros((size, size))
            for (i, j), value in zip(_lower_half(row["sums"]), row["products"]):
                products[i, j] = products[j, i] = value
            mean = np.array(row["sums"]) / row["rows"]
            self.parts[row["part"]] = Moments(row["rows"], mean, products - np.outer(mean, mean) * row["rows"])
            self.sketches[row["part"]] = [bytes(row[f"sketch_{i}"]) for i in range(len(impute))]

    def medians(self, parts) -> dict[str, float]:
        """Medians of the imputed columns over some parts, from the merged sketches."""
        if not self.impute:
            return {}
        spark = self.table.sparkSession
        rows = spark.createDataFrame([tuple(map(bytearray, self.sketches[p])) for p in parts if p in self.sketches],
                                     ", ".join(f"s{i} binary" for i in range(len(self.impute))))
        found = rows.agg(*[F.kll_merge_agg_double(f"s{i}", F.lit(SKETCH_ITEMS)).alias(f"s{i}") for i in range(len(self.impute))])
        found = found.select(*[F.when(F.kll_sketch_get_n_double(f"s{i}") > 0, F.kll_sketch_get_quantile_double(
            f"s{i}", F.lit(0.5))).alias(c) for i, c in enumerate(self.impute)]).first()
        return {c: found[c] for c in self.impute}

    def total(self, parts, medians: dict[str, float] | None = None) -> Moments:
        """Moments of the features, filled with ``medians``, and the label over some parts."""
        size, inputs = len(self.features), len(self.features) + len(self.impute) + 1
        whole = reduce(lambda a, b: a + b, (self.parts[p] for p in parts if p in self.parts),
                       Moments(0, np.zeros(inputs), np.zeros((inputs, inputs))))
        if not whole.rows:
            raise ValueError(f"no rows in {list(parts)}")
        matrix = np.zeros((size + 1, inputs))
        matrix[:size, :size] = np.eye(size)
        matrix[size, -1] = 1.0
        for k, name in enumerate(self.impute):
            if medians[name] is None:
                raise ValueError(f"{name} has no value to impute from")
            matrix[self.features.index(name), size + k] = medians[name] - self.shifts[name]
        return whole.mapped(matrix, np.array([self.shifts[c] for c in (*self.features, self.label)]))


def linear_moments(df: DataFrame, features: list[str], label: str = "label", by: str | None = None,
                   impute: tuple[str, ...] = ()) -> GroupedMoments:
    """Sufficient statistics of ``df`` by the values of ``by``, in one pass."""
    shifts = near_values(df, [*features, label])
    return GroupedMoments(moment_table(df, features, label, by, impute, shifts), features, label, impute, shifts)


def penalty_scores(found: GroupedMoments, penalties: list[float], folds: list[tuple[list, list]]) -> list[float]:
    """Mean RMSE over ``folds`` (training parts, held-out parts) of every penalty; medians are those of the training parts."""
    scores = []
    pairs = []
    for train, held in folds:
        medians = found.medians(train)
        pairs.append((found.total(train, medians), found.total(held, medians)))
    for penalty in penalties:
        errors = [np.sqrt(fit_line(train, penalty).squared_error(held)) for train, held in pairs]
        scores.append(float(sum(errors) / len(errors)))
    return scores
