"""Session settings and explicit execution controls."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. A value the caller has set always wins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods above 8000 bytes. A wide decoding
    # projection in one generated method would run interpreted, several times
    # slower than the same expressions split over smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_scratch: list[str] = []


def build_session(app_name: str = "barograph", **overrides: str) -> SparkSession:
    """Session with adaptive execution on and timestamps read as UTC.

    Keyword names use ``__`` for ``.``: ``spark__sql__shuffle__partitions="64"``.
    """
    settings = dict(SESSION_DEFAULTS)
    settings.update({key.replace("__", "."): value for key, value in overrides.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session defaults to a session built elsewhere, where it has none of its own."""
    own = spark.conf.getAll
    for key, value in SESSION_DEFAULTS.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="barograph-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path for an intermediate table, below the shared folder."""
    path = f"{shared_folder(spark)}/barograph/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables made so far; returns how many there were.

    For the end of a job, when no table that reads them is needed any more.
    """
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = len(_scratch)
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(configuration).delete(path, True)
    return count


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for several passes and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Explicit repartition; ``None`` or 0 keeps the partitioning as it is."""
    return df.repartition(partitions, *keys) if partitions else df


def materialize(df: DataFrame) -> DataFrame:
    """Eager checkpoint in the shared folder: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
