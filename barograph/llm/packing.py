"""Best-fit packing of documents into sequences of a fixed number of tokens.

Each task packs online with a bounded number of open sequences, kept in a bitset
keyed by free space: the smallest sufficient space is the lowest set bit at or
above the length. When too many are open, the fullest closes. Arrivals come in
blocks of bounded size, longest first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import id_and_text, load, per_batch, query
from barograph.llm.token_ids import CACHE_SIZE, default_vocabulary, encoder

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 8_192
ARRIVALS = 16_384
PIECES = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
PLACED = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, sequence_id bigint, offset bigint"


class OpenBins:
    """Open sequences by free space."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most, self.count = size, most, 0
        self.bits, self.by_space = 0, [[] for _ in range(size + 1)]
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """Number of the sequence that takes a piece, and the offset in it."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            number, space = self.opened, self.size
            self.opened += 1
        left = space - length
        if left:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # closes the fullest
            self.by_space[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        number = self.by_space[space].pop()
        if not self.by_space[space]:
            self.bits &= ~(1 << space)
        self.count -= 1
        return number


def piece_bounds(length: int, size: int) -> list[int]:
    """Starts of a document's pieces and its end: only the first may be shorter."""
    first = length % size
    return ([0] if first else []) + list(range(first, length + 1, size))


def document_pieces(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, keep_ids: bool = False,
                    remember: int = CACHE_SIZE) -> DataFrame:
    """Token pieces of every text, each text followed by the end id."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batch):
        encode = encoder(vocabulary, remember).encode
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = np.append(encode(text).astype("<u4"), np.uint32(END_ID)).tobytes()
            bounds = piece_bounds(len(raw) // 4, size)
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                own = raw[4 * a:4 * b]
                for name, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(own), own if keep_ids else None)):
                    out[name].append(value)
        return out

    return per_batch(docs.select("doc_id", "text"), cut, PIECES.format(id=id_type))


def pack_documents(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, open_bins: int = OPEN_BINS,
                   arrivals: int = ARRIVALS, keep_ids: bool = False, remember: int = CACHE_SIZE) -> DataFrame:
    """Place of every piece: ``sequence_id`` and ``offset``; ``ids`` too if kept.

    ``remember`` bounds the pieces of text whose ids a worker keeps, which costs memory and saves time.

    Null and empty texts are the end id alone. Repeated rows are packed as often
    as they occur. Pieces are dealt out by a hash of id, number and row, so no
    source, null id or group of copies is one task. Texts of any length are cut
    whole, other columns are ignored, and an empty table gives an empty result.
    """
    schema = PLACED.format(id=docs.schema["doc_id"].dataType.simpleString())
    pieces = document_pieces(docs, vocabulary, size, keep_ids, remember)
    row = F.monotonically_increasing_id()
    dealt = (pieces.withColumn("key", F.xxhash64("doc_id", "piece", "ids_crc32", row)).repartition("key")
             .sortWithinPartitions("key", "doc_id", "piece", "ids_crc32").drop("key"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 36
        for rows in _blocks(batches, arrivals):
            length = rows.column("length").to_numpy()
            placed = np.zeros((len(length), 2), np.int64)
            for i in np.argsort(-length, kind="stable").tolist():
                placed[i] = bins.place(int(length[i]))
            yield from (rows.append_column("sequence_id", pa.array(placed[:, 0] + base))
                        .append_column("offset", pa.array(placed[:, 1])).to_batches())

    placed = dealt.mapInArrow(pack, schema)
    return placed if keep_ids else placed.drop("ids")


def _blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows, the last of fewer."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(id_and_text(load(spark, sf_dir, "documents")), default_vocabulary())
