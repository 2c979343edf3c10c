"""Cleaning of a growing folder: only new and changed files are read, only their months are written again.

A ledger beside the clean table holds path, length and modification time of every
file read, with the months its rows fell in. A run compares it with a listing
that opens no file. The months to write are those of the new rows and those a
changed or removed file had before. Their other rows come from the clean table
itself, which keeps the file of each row, so no old file is read again.

The ledger is written last, as further rows of its own run. A run that breaks off
before leaves files that count as new, and the next one replaces their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.decode import PRECIPITATION_DEFAULT, decode_observations
from barograph.operators.derive import derive_features
from barograph.operators.quality import quality_filter
from barograph.plans.cleaning import RAW_COLUMNS
from barograph.session import materialize, scratch_path
from barograph.sources.raw import list_files, read_raw
from barograph.sources.tables import PARTITION_KEYS, read_table, replace_partitions, write_table

SOURCE = "source_file"
LEDGER = ("path string, file string, length bigint, modificationTime timestamp, "
          "months array<struct<year: int, month: int>>, run bigint")
#: Changed files up to which their paths are handed to the reader; of more, the folder is read and filtered by file.
LISTED_FILES = 10_000


@dataclass(frozen=True)
class IncrementalReport:
    """Files and months a run has worked on."""

    files_new: int
    files_changed: int
    files_gone: int
    months: int


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every file; a removed file has no length."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(path)
    last = rows.groupBy("path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "path"]), "run").alias("last"))
    return last.select("path", "last.*")


def file_changes(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are new, changed or gone since the ledger, with the months they had (``old_months``)."""
    known = ledger.where("length IS NOT NULL").select(
        F.col("path").alias("known"), F.col("file").alias("old_file"), F.col("length").alias("old_length"),
        F.col("modificationTime").alias("old_time"), F.col("months").alias("old_months"))
    both = listed.join(known, F.col("path") == F.col("known"), "full_outer")
    change = (F.when(F.col("known").isNull(), "new").when(F.col("path").isNull(), "gone")
              .when((F.col("length") != F.col("old_length")) | (F.col("modificationTime") != F.col("old_time")), "changed"))
    return both.withColumn("change", change).where("change IS NOT NULL").select(
        F.coalesce("path", "known").alias("path"), F.coalesce("file", "old_file").alias("file"),
        "length", "modificationTime", "old_months", "change")


def run_incremental_cleaning(
    spark: SparkSession, input_path: str, output_path: str, ledger_path: str,
    precipitation=PRECIPITATION_DEFAULT, exact_sentinel: bool = False, glob: str = "*.csv", listed_files: int = LISTED_FILES,
) -> IncrementalReport:
    """Bring the clean table below ``output_path`` up to date with the files below ``input_path``.

    The table is partitioned by year and month and has the column ``source_file``.
    """
    changes = materialize(file_changes(list_files(spark, input_path, glob), read_ledger(spark, ledger_path)))
    counts = {row["change"]: row["n"] for row in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return IncrementalReport(0, 0, 0, 0)
    staged = scratch_path(spark, "incremental")
    present = changes.where("change <> 'gone'").select("path", "file")
    if counts.get("new", 0) + counts.get("changed", 0):
        few = sum(counts.get(kind, 0) for kind in ("new", "changed")) <= listed_files
        paths = [row["path"] for row in present.collect()] if few else input_path
        raw = read_raw(spark, paths, glob=glob, columns=[*RAW_COLUMNS, *precipitation], source=SOURCE)
        if not few:
            raw = raw.join(present.select(F.col("file").alias(SOURCE)), SOURCE, "left_semi")
        rows = quality_filter(derive_features(decode_observations(raw, precipitation, exact_sentinel, keep=(SOURCE,))))
        write_table(rows, f"{staged}/new")
    elif not _exists(spark, output_path):
        raise ValueError(f"files are gone, but there is no table at {output_path}")
    new = read_table(spark, f"{staged}/new") if _exists(spark, f"{staged}/new") else None
    per_file = [] if new is None else [new.groupBy(SOURCE).agg(F.collect_set(F.struct(*PARTITION_KEYS)).alias("months"))]
    months = _touched_months(changes, new)
    touched = [tuple(row) for row in months.collect()]  # a few for each year
    old = _kept_rows(spark, output_path, changes, months)
    parts = [part for part in (old, new) if part is not None]
    if parts:
        whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        write_table(whole, f"{staged}/months")
        replacement = read_table(spark, f"{staged}/months")
        replace_partitions(replacement, output_path)
        left = {tuple(row) for row in replacement.select(*PARTITION_KEYS).distinct().collect()}
        _drop_months(spark, output_path, [month for month in touched if month not in left])
    entries = changes.select("path", "file", "length", "modificationTime")
    found = per_file[0] if per_file else spark.createDataFrame([], f"{SOURCE} string, months array<struct<year: int, month: int>>")
    run = (read_ledger(spark, ledger_path).agg(F.max("run")).first()[0] or 0) + 1
    entries.join(found.withColumnRenamed(SOURCE, "file"), "file", "left").select(
        "path", "file", "length", "modificationTime",
        F.coalesce("months", F.array().cast("array<struct<year: int, month: int>>")).alias("months"),
        F.lit(run).cast("bigint").alias("run")).write.mode("append").parquet(ledger_path)
    return IncrementalReport(counts.get("new", 0), counts.get("changed", 0), counts.get("gone", 0), len(touched))


def _touched_months(changes: DataFrame, new: DataFrame | None) -> DataFrame:
    before = changes.where("old_months IS NOT NULL").select(F.inline("old_months"))
    months = before if new is None else before.union(new.select(*PARTITION_KEYS))
    return months.distinct()


def _kept_rows(spark: SparkSession, output_path: str, changes: DataFrame, months: DataFrame) -> DataFrame | None:
    """Rows of the touched months in the table whose file has not changed; other months' folders are not read."""
    if not _exists(spark, output_path):
        return None
    wanted = [tuple(row) for row in months.collect()]
    if not wanted:
        return None
    # NULL keys are a partition, too.
    inside = None
    for values in wanted:
        same = F.lit(True)
        for name, value in zip(PARTITION_KEYS, values):
            same = same & F.col(name).eqNullSafe(F.lit(value))
        inside = same if inside is None else inside | same
    table = read_table(spark, output_path).where(inside)
    return table.join(changes.select(F.col("file").alias(SOURCE)), SOURCE, "left_anti")


def _drop_months(spark: SparkSession, output_path: str, months: list[tuple]) -> None:
    """Remove the folders of months that have no row any more."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for values in months:
        folder = "/".join(f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
                          for name, value in zip(PARTITION_KEYS, values))
        at = jvm.org.apache.hadoop.fs.Path(f"{output_path}/{folder}")
        at.getFileSystem(configuration).delete(at, True)
