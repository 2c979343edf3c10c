"""Whitening of vectors with a covariance found by polarisation.

The variance of the sum of two dimensions is the sum of their variances and
twice their covariance. So squares are added up for every dimension and for the
sum of every two dimensions, and differences of these variances give the whole
covariance; no products of different dimensions are formed. Components are
integers and are centred by the integer below their mean before they are
squared, so all sums are exact and the rest of the mean is taken off exactly
afterwards. A task shuffles one row for each dimension and pair, however many
vectors it has seen, and the driver holds one matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import load, query, stored
from barograph.llm.vectors import blocks, integer_vectors

SHIFT = 100_000  # added to floor(1024 * component); no result depends on it
COMPONENTS = 8
SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """``count`` and ``sums`` of the integer vectors; unit ``axes`` by column and ``variances``, the largest first."""

    count: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """Integers just below the means."""
        return np.array([total // self.count for total in self.sums], np.int64)

    @property
    def usable(self) -> np.ndarray:
        """Components whose variance is not zero to double precision."""
        floor = len(self.sums) * np.finfo(np.float64).eps * max([0.0, *self.variances])
        return self.variances > floor


def _totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every dimension."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, None
        for _, matrix in blocks(batches):
            count += len(matrix)
            sums = matrix.sum(0) + (0 if sums is None else sums)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(sums)), pa.int32()), pa.array([count] * len(sums)), pa.array(sums)], ["i", "n", "total"])

    found = vectors.select("x").mapInArrow(run, "i int, n bigint, total bigint").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    totals = {row["i"]: row["total"] for row in found}
    return (found[0]["n"] if found else 0), [totals[i] for i in range(len(totals))]


def pair_squares(matrix: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of squares of dimension ``i`` and of its sums with every later one."""
    own = matrix[:, i:i + 1]
    both = np.concatenate([own, own + matrix[:, i + 1:]], 1)
    return both.sum(0), (both * both).sum(0)


def covariance(vectors: DataFrame) -> tuple[int, list[int], np.ndarray, float]:
    """Count, sums, covariance matrix (divisor: count) and its trace, of the integer vectors ``x``."""
    count, sums = _totals(vectors)
    size = len(sums)
    if not count:
        return 0, [], np.zeros((0, 0)), 0.0
    centre = np.array([total // count for total in sums], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list | None = None
        for _, matrix in blocks(batches):
            matrix = matrix - centre
            if len(matrix) * (2 * int(np.abs(matrix).max(initial=0))) ** 2 >= SAFE:
                matrix = matrix.astype(object)  # Python's integers
            part = [tuple(a.astype(object) for a in pair_squares(matrix, i)) for i in range(size)]
            found = part if found is None else [(a + c, b + d) for (a, b), (c, d) in zip(found, part)]
        if found is not None:
            decimals = lambda k: pa.array([v for row in found for v in row[k]], pa.decimal128(38, 0))
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), decimals(0), decimals(1)],
                                             ["i", "j", "total", "squares"])

    rows = vectors.select("x").mapInArrow(run, "i int, j int, total decimal(38,0), squares decimal(38,0)").groupBy(
        "i", "j").agg(F.sum("total").alias("total"), F.sum("squares").alias("squares")).collect()
    #: count squared times the variance of a dimension (i = j) or of the sum of two
    spread = {(r["i"], r["j"]): count * int(r["squares"]) - int(r["total"]) ** 2 for r in rows}
    matrix = np.zeros((size, size))
    for (i, j), both in spread.items():
        if i == j:
            matrix[i, i] = both / count ** 2
        else:
            matrix[i, j] = matrix[j, i] = (both - spread[i, i] - spread[j, j]) / (2 * count ** 2)
    return count, sums, matrix, sum(spread[i, i] for i in range(size)) / count ** 2


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Largest ``components`` principal axes of ``vectors`` (``x`` from ``integer_vectors``), all of them counted."""
    count, sums, matrix, trace = covariance(vectors)
    _, axes = np.linalg.eigh(matrix)
    axes = axes[:, ::-1][:, :components]
    # Quotients in extended precision: small variances beside large ones stay right to many digits.
    wide = axes.astype(np.longdouble)
    variances = ((matrix.astype(np.longdouble) @ wide) * wide).sum(0) / (wide * wide).sum(0)
    return Whitening(count, sums, axes, np.maximum(variances.astype(np.float64), 0.0), trace)


def whiten_vectors(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """All columns of ``vectors`` but ``x``, with ``whitened array<double>`` and ``deviation``.

    ``deviation`` is the sum of (count * x - sum)^2 over dimensions, null beyond
    64 bits. A component without variance cannot be whitened and is null.
    """
    names = [c for c in vectors.columns if c != "x"]
    count, centre, usable = fitted.count, fitted.centre, fitted.usable
    rest = np.array([total - count * int(c) for total, c in zip(fitted.sums, centre)], np.int64)
    scaled = np.where(usable, fitted.axes / np.sqrt(np.where(usable, fitted.variances, 1.0)), 0.0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, matrix in blocks(batches):
            matrix = matrix - centre
            whitened = (matrix - rest / count) @ scaled
            if len(centre) * (count * (int(np.abs(matrix).max(initial=0)) + 1)) ** 2 >= SAFE:
                matrix = matrix.astype(object)
            deviation = ((count * matrix - rest) ** 2).sum(1).tolist()
            flat = pa.array(whitened.reshape(-1), mask=np.tile(~usable, len(whitened)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(whitened) + 1) * scaled.shape[1], pa.int32()), flat)],
                [*names, "deviation", "whitened"])

    kinds = dict(vectors.dtypes)
    schema = ", ".join([*[f"`{n}` {kinds[n]}" for n in names], "deviation bigint, whitened array<double>"])
    return vectors.select(*names, "x").mapInArrow(run, schema)


def identity_error(whitened: DataFrame, fitted: Whitening) -> float | None:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity; null without usable components."""
    usable = [int(k) for k in np.flatnonzero(fitted.usable)]
    if not usable or not fitted.count:
        return None
    pairs = [(a, b) for a in usable for b in usable if a <= b]
    found = whitened.agg(*[F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs]).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(found, pairs))


def whiten(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> tuple[DataFrame, Whitening]:
    """``vec_id, deviation, whitened`` of every usable row of ``df`` (a written table), and what was fitted.

    Rows with a null vector or with null or non-finite components go, see
    ``integer_vectors``, which also says what becomes of odd lengths and of huge
    components. Null and repeated ids and repeated rows are rows like any other,
    and other columns are ignored, whatever their names. There are at most as
    many components as dimensions. An empty table gives no rows.
    """
    vectors = integer_vectors(df, {"vec_id": dict(df.dtypes)["vec_id"]}, vector)
    fitted = fit_whitening(vectors, components)
    return stored(whiten_vectors(vectors, fitted), "whitened"), fitted


@query()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of all usable rows of ``embeddings``."""
    rows, fitted = whiten(load(spark, sf_dir, "embeddings"))
    error = identity_error(rows, fitted)
    explained = [float(v / fitted.trace) if fitted.trace else 0.0 for v in fitted.variances]
    shares = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.count).cast("bigint").alias("n"), "deviation",
        "whitened", shares[F.col("at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
