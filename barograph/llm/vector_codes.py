"""Codes of vectors: the nearest entry of a codebook for every part of a vector.

The nearest entry is found by equal-average search. A codebook's entries are
sorted by component sum. The squared gap between the sums of a part and of an
entry, over the number of components, is at most their squared distance. So the
search starts at the part's own sum and goes outward on both sides, until on
each side that bound strictly exceeds the best distance so far: an entry beyond
can neither be nearer nor as near.

Codebooks are learnt from all vectors in a fixed number of rounds. A task adds
up its parts by entry, so one row for each entry and task is shuffled, and the
driver holds no more than the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import load, query, stored
from barograph.llm.vectors import SCALE, blocks, integer_vectors

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Distinct labels up to which their sums are broadcast; beyond, they are joined by shuffle.
BROADCAST_LABELS = 50_000


@dataclass(frozen=True)
class Codebooks:
    """Integer entries, an array of parts by entries by components; ``dimension`` leaves out zeros added at the end."""

    entries: np.ndarray
    dimension: int

    @property
    def text(self) -> str:
        """All components by part, entry and position."""
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def nearest(values: np.ndarray, entries: np.ndarray, block: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lowest of equally near ones, and the squared distance.

    Goes outward by blocks of entries, so that the distances of many rows to a
    block are one product of matrices.
    """
    size, width = entries.shape
    reach = int(max(np.abs(values).max(initial=0), np.abs(entries).max(initial=0)))
    # Whole numbers are exact in floats up to 2^53; beyond, Python's integers.
    kind = np.float64 if 4 * width * reach ** 2 * max(size, width) < 1 << 53 else object
    order = np.argsort(entries.sum(1), kind="stable")
    values, entries = values.astype(kind), entries[order].astype(kind)
    own, ladder = values.sum(1), entries.sum(1)
    own_squares, squares = (values * values).sum(1), (entries * entries).sum(1)

    def ranked(rows: np.ndarray, low: int, high: int) -> np.ndarray:
        """Least of distance * size + index."""
        distance = own_squares[rows, None] - 2 * (values[rows] @ entries[low:high].T) + squares[low:high]
        return (distance * size + order[low:high]).min(1)

    first = np.minimum(np.searchsorted(ladder, own), size - 1) // block
    best = np.empty(len(values), kind)
    for home in np.unique(first):
        mine = np.flatnonzero(first == home)
        best[mine] = ranked(mine, home * block, min((home + 1) * block, size))
        for way in (1, -1):
            rows, at = mine, home + way
            while len(rows) and 0 <= at * block < size:
                low, high = at * block, min((at + 1) * block, size)
                gap = ladder[low if way > 0 else high - 1] - own[rows]
                rows = rows[(gap * gap <= width * (best[rows] // size)).astype(bool)]
                if len(rows):
                    best[rows] = np.minimum(best[rows], ranked(rows, low, high))
                at += way
    distance = best // size
    return (best % size).astype(np.int64), distance if kind is object else distance.astype(np.int64)


def _parted(matrix: np.ndarray, parts: int) -> np.ndarray:
    """Rows by parts by components; zeros fill up the last part."""
    width = -(-matrix.shape[1] // parts)
    wide = np.pad(matrix, ((0, 0), (0, parts * width - matrix.shape[1])))
    return wide.reshape(len(matrix), parts, width)


def _sums(vectors: DataFrame, entries: np.ndarray) -> DataFrame:
    """Count and component sums of the parts nearest to each entry, one row for each task."""
    parts, size, width = entries.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, size), np.int64)
        totals = np.zeros((parts, size, width), np.int64)
        for _, matrix in blocks(batches):
            values = _parted(matrix, parts)
            for part in range(parts):
                which, _ = nearest(values[:, part], entries[part])
                order = np.argsort(which, kind="stable")
                used, first = np.unique(which[order], return_index=True)
                totals[part, used] += np.add.reduceat(values[order, part], first, axis=0)
                counts[part] += np.bincount(which, minlength=size)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()),
                                      pa.array(totals[part, entry].reshape(-1)))], ["part", "entry", "n", "total"])

    found = vectors.select("x").mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``vectors`` (``vec_id``, ``x`` from ``integer_vectors``).

    An entry starts as the part of one of the vectors with the smallest ids
    (null ids last, equal ids by vector; all rows where there are fewer). Each
    round replaces an entry by the floors of the means of the parts nearest to
    it; an entry that no part is nearest to stays.
    """
    first = vectors.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64), 0)
    start = np.array([row["x"] for row in first], np.int64)
    books = np.ascontiguousarray(_parted(start, parts).transpose(1, 0, 2))
    for _ in range(rounds):
        books = books.copy()
        for row in _sums(vectors, books).collect():
            books[row["part"], row["entry"]] = [total // row["n"] for total in row["total"]]
    return Codebooks(books, start.shape[1])


def encode_vectors(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """All columns of ``vectors`` but ``x``, with ``codes array<int>`` by part and ``error``, the squared distance."""
    names = [c for c in vectors.columns if c != "x"]
    parts = len(books.entries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, matrix in blocks(batches):
            values = _parted(matrix, parts)
            found = [nearest(values[:, part], books.entries[part]) for part in range(parts)]
            codes = np.stack([which for which, _ in found], 1)
            error = sum(distance.astype(np.int64) for _, distance in found)
            offsets = pa.array(np.arange(len(codes) + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1), pa.int32())),
                 pa.array(error)], [*names, "codes", "error"])

    kinds = dict(vectors.dtypes)
    schema = ", ".join([*[f"`{n}` {kinds[n]}" for n in names], "codes array<int>", "error bigint"])
    return vectors.select(*names, "x").mapInArrow(run, schema)


def decode_vectors(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``coded`` with ``vector array<double>``, the middle of the entries' steps, over the scale."""
    entries = books.entries.tolist()
    table = F.array(*[F.array(*[F.array(*[F.lit(v) for v in entry]) for entry in part]) for part in entries])
    flat = F.flatten(F.transform("codes", lambda code, part: table[part][code]))
    return coded.withColumn("vector", F.transform(F.slice(flat, 1, books.dimension), lambda v: (v + 0.5) / scale))


def compress_vectors(df: DataFrame, label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
                     rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, codes, error, label_error`` of every usable row of ``df``, and the codebooks.

    Rows with a null vector or with null or non-finite components go, see
    ``integer_vectors``, which also says what becomes of odd lengths and of huge
    components. Null and repeated ids and repeated rows are rows like any other;
    null labels are one label. Dimensions that ``parts`` does not divide are
    filled up with zeros. Other columns are ignored, whatever their names. An
    empty table gives no rows and empty codebooks. Label sums are broadcast up
    to ``BROADCAST_LABELS`` labels; of more, hot ones are split by Spark's skew
    join. A sum beyond 64 bits is null.
    """
    kinds = dict(df.dtypes)
    narrow = df.select(F.col("vec_id"), F.col(label).alias("label"), F.col("embedding"))
    vectors = integer_vectors(narrow, {"vec_id": kinds["vec_id"], "label": kinds[label]})
    books = fit_codebooks(vectors, parts, entries, rounds)
    coded = stored(encode_vectors(vectors, books), "codes")
    sums = stored(coded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(
        F.col("label").alias("of_label"), F.expr("try_cast(total AS bigint)").alias("label_error")), "label-errors")
    few = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return coded.join(few, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label"), books


def _rounds_sql() -> str:
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS (SELECT n, part, min(d) AS d, arg_min(entry, d * {ENTRIES} + entry) AS entry FROM (
    SELECT n, part, entry, CAST(list_inner_product(p, p) - 2 * list_inner_product(p, e) + list_inner_product(e, e)
      AS BIGINT) AS d FROM parts JOIN book{k} USING (part)) GROUP BY n, part)""")
        if k < ROUNDS:
            steps.append(f"""mean{k} AS (SELECT part, entry, list(c ORDER BY i) AS e FROM (
    SELECT part, entry, i, floor(sum(p[i]) / count(*)) AS c FROM near{k} JOIN parts USING (n, part),
      (SELECT unnest(range(1, 17)) AS i) GROUP BY part, entry, i) GROUP BY part, entry)""")
            steps.append(f"""book{k + 1} AS (SELECT part, entry, coalesce(m.e, b.e) AS e
    FROM book{k} b LEFT JOIN mean{k} m USING (part, entry))""")
    return ",\n  ".join(steps)


@query(f"""WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
      list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS (SELECT n, part, v[16 * part + 1 : 16 * part + 16] AS p
    FROM kept, (SELECT unnest(range({PARTS})) AS part)),
  book0 AS (SELECT part, n - 1 AS entry, p AS e FROM parts WHERE n <= {ENTRIES}),
  {_rounds_sql()},
  coded AS (SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY n),
  sha AS (SELECT sha256(string_agg(CAST(CAST(e[i] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS h
    FROM book{ROUNDS}, (SELECT unnest(range(1, 17)) AS i))
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    h AS codebooks_sha256 FROM coded JOIN kept USING (n), sha""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all usable rows of ``embeddings``; the digest covers the final codebooks."""
    coded, books = compress_vectors(load(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error",
                        F.lit(hashlib.sha256(books.text.encode()).hexdigest()).alias("codebooks_sha256"))
