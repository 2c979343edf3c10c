"""Order MinHash fingerprints: sensitive to edits that move text.

A text's k-mers are numbered by occurrence, so that repeats count. Each of the
sketches selects the smallest few in its own order, keeps them in text order and
hashes the tuple. The orders are rotations of one hash: sketch ``i`` starts at
``i / SKETCHES`` of the hash range and goes around, so one sort serves all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm import textbytes as tb
from barograph.llm.common import id_and_text, load, query, ship_package, slices, stored
from barograph.llm.ordered import range_bounds, range_of

K = 10
TUPLE = 2
SKETCHES = 64
_SALT = np.uint64(0xD1B54A32D192ED03)
_STARTS = (np.arange(SKETCHES, dtype=np.uint64) << np.uint64(64 - 6))


def sketch(text: str) -> np.ndarray:
    """One 32-bit tuple hash per sketch; none for an empty text.

    A text shorter than its k-mers is a single one.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint32)
    values = tb.mixed(codes.astype(np.uint64) + _SALT)
    up, down = tb.powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[:n], out=sums[1:])
    k = min(K, n)
    count = n - k + 1
    kmers = tb.mixed((sums[k:] - sums[:count]) * down[:count])
    place_bits = np.uint64(max(1, count.bit_length()))
    places = np.arange(count, dtype=np.uint64)
    keys = np.sort(((kmers >> place_bits) << place_bits) | places)
    high = keys >> place_bits
    place = keys & ((np.uint64(1) << place_bits) - np.uint64(1))
    again = np.zeros(count, bool)
    again[1:] = high[1:] == high[:-1]
    if again.any():  # the second and later occurrences get hashes of their own
        first = np.maximum.accumulate(np.where(again, 0, np.arange(count)))
        at = np.flatnonzero(again)
        number = (at - first[at]).astype(np.uint64)
        moved = tb.mixed(kmers[place[at]] + number * _SALT)
        keys[at] = ((moved >> place_bits) << place_bits) | place[at]
        keys.sort()
        place = keys & ((np.uint64(1) << place_bits) - np.uint64(1))
    chosen = np.searchsorted(keys, _STARTS)[:, None] + np.arange(TUPLE)
    chosen = np.sort(place[chosen % count].astype(np.int64), axis=1)
    total = kmers[chosen[:, 0]]
    for j in range(1, TUPLE):
        total = tb.mixed(total * _SALT + kmers[chosen[:, j]])
    return (total >> np.uint64(32)).astype("<u4")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal sketches; two empty texts are alike, an empty and another are not."""
    if len(x) == 0 or len(y) == 0:
        return float(len(x) == len(y))
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the following text."""
    part = len(text) // 3
    return text[:len(text) - part] + following[:part]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, with their likenesses.

    The next document follows in descending ``doc_id``, rows with equal ids in
    the order of their texts, null ids last; after the last comes the first. A
    null text is empty and has the empty fingerprint; texts of any length are
    fingerprinted whole. Other columns are ignored, whatever their names. A
    table of one row is its own next document; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lowest = F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce(F.col("doc_id").cast("bigint"), lowest).alias("key"))
    bounds = range_bounds(docs)
    rows = keyed.withColumn("range", range_of(F.col("key"), bounds))
    # The first row of each range; there are no more than MOST_RANGES ranges.
    tops = rows.groupBy("range").agg(F.max("key").alias("key")).collect()
    present = sorted(top["range"] for top in tops)
    if not present:
        return spark.createDataFrame([], RESULT.format(id=docs.schema["doc_id"].dataType.simpleString()))
    follower = {present[i]: present[i - 1] for i in range(len(present))}  # the lowest is followed by the highest
    heads = stored(rows.join(F.broadcast(spark.createDataFrame(
        [(t["range"], t["key"]) for t in tops], "range int, key bigint")), ["range", "key"])
        .groupBy("range").agg(F.min("text").alias("text")), "range-heads")
    after = spark.createDataFrame([(b, a) for a, b in follower.items()], "range int, before int")
    tails = heads.join(F.broadcast(after), "range").select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", lowest.alias("key"),
        F.col("before").alias("range"), F.lit(1).alias("tail"))
    streams = (rows.withColumn("tail", F.lit(0)).unionByName(tails)
               .repartitionById(len(bounds) + 1, F.col("range"))
               .sortWithinPartitions("range", "tail", F.desc("key"), "text")
               .select("doc_id", "text", "tail"))
    schema = RESULT.format(id=docs.schema["doc_id"].dataType.simpleString())
    id_type = docs.schema["doc_id"].dataType
    return streams.mapInArrow(_stream(id_type), schema)


RESULT = ("doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _stream(id_type):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            for part in slices(batch):
                out: dict[str, list] = {name: [] for name in (
                    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    "near_edited", "near_next")}
                for doc_id, text, tail in zip(*(part.column(k).to_pylist() for k in range(3))):
                    own = sketch(text)
                    if waiting is not None:
                        before_id, before_text, before = waiting
                        changed = edited(before_text, text)
                        other = before if changed == before_text else sketch(changed)
                        values = (before_id, len(before_text),
                                  hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                                  before.tobytes().hex(), other.tobytes().hex(),
                                  likeness(before, other), likeness(before, own))
                        for name, value in zip(out, values):
                            out[name].append(value)
                    waiting = None if tail else (doc_id, text, own)
                if out["doc_id"]:
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(out["doc_id"], arrow_id), "n_chars": pa.array(out["n_chars"], pa.int64()),
                         **{name: pa.array(out[name], pa.string()) for name in (
                             "edited_sha256", "fingerprint", "edited_fingerprint")},
                         **{name: pa.array(out[name], pa.float64()) for name in ("near_edited", "near_next")}})

    return run


@query()
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(id_and_text(load(spark, sf_dir, "documents")))
