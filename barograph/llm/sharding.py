"""Minimax contiguous sharding of documents, equal texts together.

The atomic groups are runs of a fixed text-hash order: all rows whose text hash
falls into one of ``buckets`` classes, so equal texts are never parted. Their
sizes, a list of fixed length, are cut into contiguous shards at the smallest
capacity that suffices. Groups above an even share come first in the order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm.common import id_and_text, load, query

SHARDS = 24
BUCKETS = 16_384
#: Parts of a bucket that are numbered apart, so that one hot text is not one task.
PARTS = 8


def cuts_within(prefix: np.ndarray, shards: int, capacity: int) -> list[int] | None:
    """Greedy cuts with at most ``capacity`` in each shard, or None if they do not suffice."""
    cuts = [0]
    for _ in range(shards):
        if cuts[-1] == len(prefix) - 1:
            break
        reach = int(np.searchsorted(prefix, prefix[cuts[-1]] + capacity, side="right")) - 1
        if reach == cuts[-1]:
            return None
        cuts.append(reach)
    return cuts if cuts[-1] == len(prefix) - 1 else None


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """Smallest capacity for which ``shards`` contiguous shards hold all ``sizes``."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    low, high = max(int(sizes.max(initial=0)), -(-int(prefix[-1]) // shards)), int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        if cuts_within(prefix, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


def minimax_shards(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each atomic group.

    A group larger than an even share of what is left stands alone; the others
    are cut in their order at their own smallest capacity.
    """
    shard = np.zeros(len(sizes), np.int64)
    rest = np.argsort(-sizes, kind="stable")
    alone = 0
    left = int(sizes.sum())
    while alone < min(shards - 1, len(rest)) and sizes[rest[alone]] * (shards - alone) > left:
        shard[rest[alone]] = alone
        left -= int(sizes[rest[alone]])
        alone += 1
    others = np.sort(rest[alone:])
    own = sizes[others]
    prefix = np.concatenate([[0], np.cumsum(own)])
    cuts = cuts_within(prefix, shards - alone, smallest_capacity(own, shards - alone))
    shard[others] = alone + np.searchsorted(np.array(cuts[1:]), np.arange(len(others)), side="right")
    return shard


def assign_shards(docs: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS, carried: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    The column named ``carried`` comes along, if there is one.

    A row's size is its UTF-8 bytes plus 8; a null text counts as empty. Equal
    texts, and repeated rows, share a shard. Slots number the rows of a shard
    without gaps. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    along = [carried] if carried else []
    rows = docs.select(
        *along, "doc_id", (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(buckets)).alias("bucket"),
        F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(PARTS)).alias("part"))
    # At most buckets * PARTS rows, whatever the input.
    sums = rows.groupBy("bucket", "part").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")).toArrow().to_pandas()
    sums = sums.sort_values(["bucket", "part"], ignore_index=True)
    if len(sums) == 0:
        sums["shard"] = sums["before"] = np.zeros(0, np.int64)
    else:
        sizes = sums.groupby("bucket")["bytes"].sum()
        of_bucket = dict(zip(sizes.index, minimax_shards(sizes.to_numpy(np.int64), shards)))
        sums["shard"] = sums["bucket"].map(of_bucket)
        sums["before"] = sums.groupby("shard")["n"].cumsum() - sums["n"]
    plan = spark.createDataFrame(
        pa.table({name: pa.array(sums[name].astype("int64")) for name in ("bucket", "part", "shard", "before")}))
    order = Window.partitionBy("bucket", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("rank", F.row_number().over(order))
            .join(F.broadcast(plan), ["bucket", "part"])
            .select(*along, "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("before") + F.col("rank") - 1).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all rows and columns of ``docs`` in one folder per shard, with their slots."""
    columns = docs.drop("shard", "slot").columns
    rows = docs.select("doc_id", "text", F.struct(*columns).alias("row"))
    placed = assign_shards(rows, shards, carried="row")
    placed.select("row.*", "slot", "shard").write.partitionBy("shard").parquet(path)


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(id_and_text(load(spark, sf_dir, "documents")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
