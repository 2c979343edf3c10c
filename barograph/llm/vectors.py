"""Vectors of a table as integer rows, and numpy blocks of them inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import ship_package, stored

SCALE = 1024
#: Components of one block of rows.
BLOCK = 1 << 19


def largest(size: int) -> int:
    """Largest integer component for which squared distances of vectors of this size fit in 64 bits."""
    return min(isqrt((1 << 61) // max(size, 1)), (1 << 31) - 1)


def integer_parts(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the rows whose vectors are whole and finite, and floor(scale * component) of these."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(sizes)
    whole = (bad[ends] == bad[ends - sizes]) & column.is_valid().to_numpy(zero_copy_only=False)
    bounds = np.repeat([largest(int(s)) for s in sizes[whole]], sizes[whole]).astype(np.float64)
    inside = values[np.repeat(whole, sizes)]
    with np.errstate(over="ignore"):
        integers = np.clip(np.floor(inside * scale), -bounds, bounds).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes[whole])]).astype(np.int32)
    return np.flatnonzero(whole), pa.ListArray.from_arrays(pa.array(offsets), pa.array(integers))


def integer_vectors(df: DataFrame, keep: dict[str, str], vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Written table of ``keep``'s columns (name to type) and ``x array<int>`` = floor(scale * component).

    Rows whose vector is null or holds null or non-finite components go. The
    table's dimension is the commonest length (the least of equally common
    ones); vectors of another length and empty ones cannot be compared with the
    others and go too. Components beyond ``largest`` (over 100 000 before
    scaling at 64 dimensions) are clipped to it. The integers are a third of the
    size of the floats, so later passes read these.
    """
    ship_package(df.sparkSession)
    names = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 1 << 14
            for part in (batch.slice(at, step) for at in range(0, batch.num_rows, step)):
                rows, x = integer_parts(part.column(len(names)), scale)
                yield pa.RecordBatch.from_arrays([*[c.take(pa.array(rows)) for c in part.columns[:-1]], x], [*names, "x"])

    schema = ", ".join([*[f"`{n}` {kind}" for n, kind in keep.items()], "x array<int>"])
    found = stored(df.select(*[F.col(n).cast(kind).alias(n) for n, kind in keep.items()], F.col(vector).alias("x"))
                   .mapInArrow(run, schema), "vectors")
    lengths = found.groupBy(F.size("x").alias("size")).count().where("size > 0")
    first = lengths.orderBy(F.col("count").desc(), "size").first()
    size = first["size"] if first else 0
    kept = found.where(F.size("x") == size)
    kept.dimension = size
    return kept


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size with the matrix (int64) of their last column, vectors of one length."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.num_columns - 1)
        matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        step = max(1, BLOCK // max(1, matrix.shape[1]))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step), matrix[at:at + step].astype(np.int64)
