"""Token-id files of patched frame-of-reference blocks.

A file holds segments of whole documents. In a segment the ids stand in blocks
of 512: the block's minimum is subtracted, the low bits are packed at the width
that the chosen percentile of the block needs, and ids above it keep their high
bits in an exception list. The percentile is the one of a few that makes the
block smallest. The index holds the start of each block, so that one block can
be decoded alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm.common import id_and_text, load, query, ship_package, slices
from barograph.llm.ordered import range_bounds, range_of
from barograph.llm.token_ids import default_vocabulary, encoder
from barograph.session import scratch_path

BLOCK = 512
#: Ids after which a segment is closed; a longer document has one of its own.
SEGMENT_IDS = 1 << 18
PERCENTILES = (75, 90, 95, 99, 100)
END_ID = 0
MAGIC = 0x31524650
FILE_SCHEMA = ("range int, segment int, first_id bigint, doc_ids array<bigint>, lengths array<bigint>, "
               "payload binary")


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> bytes:
    """Low ``width`` bits of each value of full blocks, least significant bit first."""
    raw = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :(width + 7) // 8]
    bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def _unpack(data: np.ndarray, count: int, width: int) -> np.ndarray:
    bits = np.unpackbits(data, count=count * width, bitorder="little").reshape(count, width)
    raw = np.zeros((count, 4), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    raw[:, :packed.shape[1]] = packed
    return raw.view("<u4").reshape(-1)


def encode_segment(ids: np.ndarray) -> bytes:
    """The ids of one segment (below 2**32) as patched frames with a block index."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = ids[-1]
    frames = padded.reshape(blocks, BLOCK)
    low = frames.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = frames - low[:, None]
    lengths = np.sort(_bit_lengths(rest), axis=1)
    widths = np.zeros(blocks, np.int64)
    if blocks:
        at = [max(0, -(-BLOCK * p // 100) - 1) for p in PERCENTILES]
        candidates = lengths[:, at]
        over = (lengths[:, None, :] > candidates[:, :, None]).sum(axis=2)
        cost = candidates * BLOCK + over * 48
        widths = candidates[np.arange(blocks), cost.argmin(axis=1)]
    shifted = (rest >> widths[:, None].astype(np.uint32)).astype(np.uint32)
    shifted[widths >= 32] = 0
    where, place = np.nonzero(shifted)
    counts = np.bincount(where, minlength=blocks)
    sizes = widths * (BLOCK // 8)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u4")
    body = np.zeros(int(starts[-1]), np.uint8)
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        packed = np.frombuffer(_pack(rest[own].reshape(-1), int(width)), np.uint8).reshape(len(own), -1)
        body[starts[own][:, None] + np.arange(packed.shape[1])] = packed
    return b"".join([
        np.array([MAGIC, n, blocks, len(where)], "<u4").tobytes(), starts.tobytes(),
        np.concatenate([[0], np.cumsum(counts)]).astype("<u4").tobytes(), low.astype("<u4").tobytes(),
        widths.astype(np.uint8).tobytes(), body.tobytes(),
        place.astype("<u2").tobytes(), shifted[where, place].astype("<u4").tobytes()])


class Segment:
    """Reader of one segment; ``ids()`` gives all ids, ``block(k)`` those of one block."""

    def __init__(self, payload: bytes) -> None:
        magic, self.n, self.blocks, patched = np.frombuffer(payload, "<u4", 4).tolist()
        if magic != MAGIC:
            raise ValueError("not a segment of patched frames")
        at = 16
        sizes = (("starts", "<u4", self.blocks + 1), ("exceptions", "<u4", self.blocks + 1),
                 ("low", "<u4", self.blocks), ("widths", "u1", self.blocks))
        for name, kind, count in sizes:
            values = np.frombuffer(payload, kind, count, at)
            setattr(self, name, values)
            at += values.nbytes
        self.body = np.frombuffer(payload, np.uint8, int(self.starts[-1]), at)
        at += self.body.nbytes
        self.place = np.frombuffer(payload, "<u2", patched, at)
        self.high = np.frombuffer(payload, "<u4", patched, at + self.place.nbytes)

    def _decode(self, own: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), BLOCK), np.uint32)
        for width in np.unique(self.widths[own]):
            of = np.flatnonzero(self.widths[own] == width)
            if width:
                size = int(width) * (BLOCK // 8)
                data = self.body[self.starts[own[of]].astype(np.int64)[:, None] + np.arange(size)]
                out[of] = _unpack(data.reshape(-1), len(of) * BLOCK, int(width)).reshape(len(of), BLOCK)
        first, last = self.exceptions[own].astype(np.int64), self.exceptions[own + 1].astype(np.int64)
        which = np.repeat(np.arange(len(own)), last - first)
        at = np.concatenate([np.arange(a, b) for a, b in zip(first, last)]) if len(which) else np.zeros(0, int)
        out[which, self.place[at]] += self.high[at] << self.widths[own][which].astype(np.uint32)
        return out + self.low[own][:, None]

    def ids(self) -> np.ndarray:
        return self._decode(np.arange(self.blocks)).reshape(-1)[:self.n]

    def block(self, number: int) -> np.ndarray:
        return self._decode(np.array([number])).reshape(-1)[:max(0, self.n - number * BLOCK)][:BLOCK]


def write_token_files(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Encode all texts, each followed by the end id, into files in ascending ``doc_id`` order.

    A null or empty text has the end id alone. Rows with equal ids stay, in the
    order of their texts; null ids come first. A text of any length is encoded
    whole, other columns are ignored, and an empty table writes no segment.
    """
    ship_package(docs.sparkSession)
    bounds = range_bounds(docs)
    ordered = (docs.select(F.col("doc_id").cast("bigint"), "text", range_of(F.col("doc_id"), bounds).alias("range"))
               .repartitionById(len(bounds) + 1, F.col("range"))
               .sortWithinPartitions("doc_id", "text").drop("range"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        number, first = 0, 0
        doc_ids: list = []
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            ids = np.concatenate(texts)
            return pa.RecordBatch.from_pydict({
                "range": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "segment": pa.array([number], pa.int32()), "first_id": pa.array([first], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([[len(x) for x in texts]], pa.list_(pa.int64())),
                "payload": pa.array([encode_segment(ids)], pa.binary())})

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encode(text).astype(np.uint32), np.uint32(END_ID))
                    if texts and held + len(ids) > SEGMENT_IDS:
                        yield flush()
                        number, first = number + 1, first + held
                        doc_ids, texts, held = [], [], 0
                    doc_ids.append(doc_id)
                    texts.append(ids)
                    held += len(ids)
        if texts:
            yield flush()

    ordered.mapInArrow(write, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    ship_package(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = (files.select("range", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n"))
              .groupBy("range").agg(F.sum("n").alias("n")))
    # One row per range, of which there are no more than MOST_RANGES.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, lengths = batch.column(2)[row].values, batch.column(3)[row].values.to_numpy()
                ids = Segment(batch.column(4)[row].as_py()).ids().astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": doc_ids, "range": pa.array(np.full(len(ends), batch.column(0)[row].as_py()), pa.int32()),
                    "start": pa.array(starts + batch.column(1)[row].as_py(), pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    rows = files.select("range", "first_id", "doc_ids", "lengths", "payload").mapInArrow(
        read, "doc_id bigint, range int, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(F.broadcast(bases), "range").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


@query()
def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(id_and_text(load(spark, sf_dir, "documents")), path, default_vocabulary())
    return read_token_files(spark, path)
