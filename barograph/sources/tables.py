"""Parquet tables, small CSV result tables and samples."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.split import hash_bucket, key_hash
from barograph.session import materialize

PARTITION_KEYS = ("year", "month")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet data set with its partition columns."""
    return spark.read.parquet(path)


def read_partition(spark: SparkSession, path: str, **keys: int) -> DataFrame:
    """Rows of one partition; the filter prunes the folders Spark reads."""
    df = read_table(spark, path)
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    return df


def cluster(df: DataFrame, keys=PARTITION_KEYS) -> DataFrame:
    """Bring rows of a partition together before a partitioned write.

    Adaptive execution splits a partition that outgrows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges small ones, so
    neither a large month nor many small files become a problem.
    """
    return df.hint("rebalance", *[F.col(key) for key in keys])


def write_partitioned(df: DataFrame, path: str, keys=PARTITION_KEYS, clustered: bool = True) -> None:
    """Overwrite a data set partitioned by ``keys``."""
    table = cluster(df, keys) if clustered else df
    table.write.mode("overwrite").partitionBy(*keys).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, keys=PARTITION_KEYS, rows_per_file: int | None = None
) -> None:
    """Write the partitions ``df`` has and leave all others as they are.

    One job for all partitions; a rerun gives the same table.
    """
    writer = cluster(df, keys).write.mode("overwrite").partitionBy(*keys)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_bounded(df: DataFrame, path: str, files: int, keys=()) -> None:
    """Overwrite with at most ``files`` writing tasks; choose them by the table's size.

    ``repartition`` keeps the work before the write parallel; ``coalesce`` would
    run it in ``files`` tasks.
    """
    writer = df.repartition(files).write.mode("overwrite")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned data set."""
    df.write.mode("overwrite").parquet(path)


def write_result(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Overwrite a small result table as CSV with a header."""
    table = df.coalesce(1) if single_file else df
    table.write.mode("overwrite").csv(path, header=True)


def read_result(spark: SparkSession, path: str) -> DataFrame | None:
    """CSV result table with inferred types, None when the path does not exist."""
    try:
        return spark.read.csv(path, header=True, inferSchema=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


#: Parts of the hash range a sample by key is taken from.
SAMPLE_PARTS = 1_000_000


def key_sample(df: DataFrame, rows: int, keys: list[str], total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of ``keys``: the same in every run.

    A filter, so nothing is shuffled and no task gathers the sample.
    """
    if rows >= total:
        return df
    return df.where(hash_bucket(df, keys, SAMPLE_PARTS, salt="sample") < rows * SAMPLE_PARTS // total)


#: Rows of equal hash prefix that one task may sort; more are told apart by further digits.
SORTED_ROWS = 10_000
DIGITS = 4  # hexadecimal digits a histogram looks at


def exact_sample(df: DataFrame, rows: int, keys: list[str]) -> DataFrame:
    """Exactly ``rows`` rows of ``df`` (all, if it has no more): those whose keys have the smallest hashes.

    A histogram of hash prefixes, 65 536 counts at most, tells which prefix the
    last row has. Rows below it are in the sample, rows above are not, and of
    those that share it some ten thousand are sorted; of more, a histogram of
    the next digits goes on. The sample itself is a filter over ``df``: nothing
    is gathered in a task. Of rows with equal keys that do not all fit, those
    first in their partitions are taken, in one fixed way.
    """
    if rows <= 0:
        return df.limit(0)
    hashed = df.select(key_hash(df, keys, "sample").alias("hash"))
    prefix, missing = "", rows
    while True:
        inside = hashed.where(F.col("hash").startswith(prefix)) if prefix else hashed
        digits = len(prefix) + DIGITS
        counts = sorted((row[0], row[1]) for row in inside.groupBy(F.substring("hash", 1, digits)).count().collect())
        for found, count in counts:
            if count >= missing:
                break
            missing -= count
        else:
            return df  # all rows do not fill the sample
        prefix = found
        if count == missing:
            return _below(df, keys, prefix, whole=True)
        if count <= SORTED_ROWS or digits == 32:
            break
    if digits == 32:
        last, before = prefix, 0
    else:
        tied = [row[0] for row in hashed.where(F.col("hash").startswith(prefix)).orderBy("hash").limit(missing + 1).collect()]
        last = tied[missing - 1]
        if last != tied[missing]:
            return _below(df, keys, last, whole=True)
        before = tied.index(last)
    equal = df.where(key_hash(df, keys, "sample") == last)
    return _below(df, keys, last, whole=False).unionByName(_first_rows(equal, missing - before))


def _below(df: DataFrame, keys: list[str], last: str, whole: bool) -> DataFrame:
    """Rows whose hash comes before ``last``, and, if ``whole``, those that begin with it."""
    start = F.substring(key_hash(df, keys, "sample"), 1, len(last))
    return df.where(start <= last if whole else start < last)


def _first_rows(df: DataFrame, rows: int) -> DataFrame:
    """``rows`` rows of ``df``, from its partitions in order, without bringing them together.

    Written out first, so that partitions and the order in them stay as they are.
    """
    place = F.monotonically_increasing_id()
    placed = materialize(df.withColumn("_place", place))
    partition = F.shiftright("_place", 33)
    counts = sorted((row[0], row[1]) for row in placed.groupBy(partition).count().collect())
    shares, left = {}, rows
    for number, count in counts:
        shares[number] = min(count, left)
        left -= shares[number]
    full = [number for number, count in counts if shares[number] == count]
    cut = [number for number, count in counts if 0 < shares[number] < count]
    chosen = (partition <= max(full)) if full else F.lit(False)
    for number in cut:  # one at most
        chosen = chosen | ((partition == number) & (F.col("_place").bitwiseAND((1 << 33) - 1) < shares[number]))
    return placed.where(chosen).drop("_place")


def write_sample(
    df: DataFrame, path: str, rows: int, order_by: list[str] | None = None, kind: str = "parquet",
    keys: list[str] | None = None,
) -> None:
    """Overwrite a sample: the first ``rows`` rows by ``order_by``, or as many by a hash of ``keys``.

    The ordered form is meant for a few thousand rows, the other for any number.
    """
    if (order_by is None) == (keys is None):
        raise ValueError("write_sample needs either order_by or keys")
    sample = exact_sample(df, rows, keys) if keys is not None else df.orderBy(*order_by).limit(rows)
    writer = sample.write.mode("overwrite")
    if kind == "csv":
        writer.csv(path, header=True)
    else:
        writer.parquet(path)
