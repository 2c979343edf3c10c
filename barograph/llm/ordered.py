"""Rows in one global order, dealt out in ranges of about equal size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes of one range and the most ranges; beyond, ranges grow.
RANGE_BYTES = 16 << 20
MOST_RANGES = 5_000
BLOCK = 64  # bounds searched at a time


def range_bounds(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> list[int]:
    """Upper bounds of all ranges of ``doc_id`` but the last, from one pass of bounded sketches."""
    total, low, high = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id"), F.max("doc_id")).first()
    count = max(1, min(MOST_RANGES, -(-(total or 0) // range_bytes)))
    if count == 1 or low == high:
        return []
    shares = [k / count for k in range(1, count)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 40 * count)).first()[0]
    return sorted(set(found) - {high})


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of the range of ``doc_id``; a null id is in the first.

    The bounds are literals, searched in two steps: whole blocks, then one block.
    """
    if not bounds:
        return F.lit(0)
    literal = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    below = lambda values: F.size(F.filter(values, lambda b: b < doc_id))
    ends = bounds[BLOCK - 1::BLOCK]
    block = below(literal(ends)) if ends else F.lit(0)
    within = below(F.slice(literal(bounds), block * BLOCK + 1, BLOCK))
    return F.when(doc_id.isNull(), 0).otherwise(block * BLOCK + within)
