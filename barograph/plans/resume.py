"""Jobs of several stages that go on where they broke off.

A stage's table lies under a name made of a hash of the stage, its parameters and
everything before it: the files of the inputs and the stages it follows. Spark
commits a written table by its ``_SUCCESS`` file, so a table is there whole or
not at all. A rerun with the same inputs and parameters reads the finished
stages; a change of either changes the names from there on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.session import shared_folder


def fingerprint(spark: SparkSession, path: str, glob: str = "*") -> str:
    """Hash over path, length and modification time of the files below ``path``; none is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    found = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")),
                      F.sum("length")).first()
    return hashlib.sha256(json.dumps([path, *map(str, found)]).encode()).hexdigest()


class Stages:
    """Tables of one job below ``folder`` (a folder of the shared one unless given)."""

    def __init__(self, spark: SparkSession, job: str, *inputs: str, folder: str | None = None) -> None:
        self.spark, self.job = spark, job
        self.folder = folder or f"{shared_folder(spark)}/barograph-stages"
        self.state = hashlib.sha256(json.dumps([job, *[fingerprint(spark, path) for path in inputs]]).encode()).hexdigest()
        self.ran: list[str] = []
        self.paths: list[str] = []

    def table(self, name: str, build: Callable[[], DataFrame], **parameters) -> DataFrame:
        """The stage's table: read if it was finished before, else built and written.

        ``parameters`` are those that ``build`` depends on besides the inputs
        and the stages before.
        """
        said = json.dumps([self.state, name, sorted(parameters.items())], default=repr)
        self.state = hashlib.sha256(said.encode()).hexdigest()
        path = f"{self.folder}/{self.job}/{name}-{self.state[:32]}"
        if not self._has(f"{path}/_SUCCESS"):
            build().write.mode("overwrite").parquet(path)
            self.ran.append(name)
        self.paths.append(path)
        return self.spark.read.parquet(path)

    def _has(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def clear(self) -> None:
        """Delete the tables of the stages asked for, when the job's result is safe."""
        jvm, configuration = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(configuration).delete(at, True)
