"""Registry, loading and scratch tables shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from barograph.session import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, as it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='barograph-')}/barograph", "zip",
                                   package.parent, package.name)
        context.addPyFile(made)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than the reading task.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def upper_to_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_and_text(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that others cannot clash."""
    return df.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def row_key(docs: DataFrame) -> Column:
    """Name of a row of ``docs`` by its ``doc_id`` and ``text``, null for neither.

    Keys are in the order of the ids, null ids last; only rows equal in both share one.
    """
    name = F.col("doc_id")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        name = F.lpad(F.hex(name.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.when(F.col("doc_id").isNull(), "1").otherwise(F.concat(F.lit("0"), name.cast("string"))),
                    F.lit("\u0001"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))


def per_batch(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over slices of bounded size.

    ``function`` takes a record batch of at most about a megabyte of text (one
    longer text comes alone) and returns a dict of columns or None.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = function(part)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` whose texts have at most ``limit`` bytes together."""
    import numpy as np

    if batch.num_rows == 0:
        return
    at = batch.schema.get_field_index("text")
    lengths = np.zeros(batch.num_rows, np.int64)
    if at >= 0:
        import pyarrow.compute as pc
        lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = int(np.searchsorted(ends, done + limit, side="right"))
        last = min(max(last, first + 1), first + 4096, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
