"""Removal of repeated strings of 100 bytes by sharded suffix arrays.

Every string of 100 bytes has an anchor: the k-gram in it with the smallest hash,
the leftmost on ties. Equal strings have equal anchors at the same place, so only
runs of strings with a common anchor need comparing. Runs with the same bytes
repeat each other as a whole; where an anchor has runs with different bytes,
their texts are sorted: shards build a suffix array each, by Larsson-Sadakane
refinement, common prefixes by Kasai's rule give the repeated strings, and what
one shard has seen of an anchor is merged into the next by binary search. Anchors
with very many different runs go by the hashes of their strings instead, so that
only equal strings meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm import textbytes as tb
from barograph.llm.common import id_and_text, load, per_batch, query, slices, stored

LENGTH = 100
GRAM = 24
#: Bytes of one suffix array.
SHARD_BYTES = 1 << 20
PLACE_BITS = np.uint64(24)
#: A run is stored as its first start and the number of further starts, which the anchor bounds.
SPAN = 128
#: Different runs of an anchor up to which their texts are sorted together: at most 32 MB of strings.
HOT_RUNS = 4096
#: Byte values of a second string hash.
_OTHER_VALUES = tb.mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash sums, k-gram hashes, and the anchor of the string at every start."""
    sums = tb.prefix_sums(data)
    n = len(data) - GRAM + 1
    _, down = tb.powers(len(data) + 2)
    grams = tb.mixed((sums[GRAM:] - sums[:n]) * down[:n])
    least = ((grams >> PLACE_BITS) << PLACE_BITS) | np.arange(n, dtype=np.uint64)
    width, step = length - GRAM + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    return sums, grams, (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)


def anchor_runs(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """Runs of string starts with one anchor: anchor hash, run hash, text, first and last start."""
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 5
    sums, grams, anchor = _anchors(data, length)
    start = np.arange(len(anchor))
    text = np.searchsorted(bounds, start, side="right") - 1
    inside = start + length <= bounds[text + 1]
    start, anchor, text = start[inside], anchor[inside], text[inside]
    if not len(start):
        return [np.zeros(0, np.int64)] * 5
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    low, high = start[new], start[np.append(np.flatnonzero(new)[1:], len(start)) - 1]
    anchor, text = anchor[new], text[new]
    run = run_hashes(sums, low, high + length, anchor - low)
    return grams[anchor].view(np.int64), run, text, low - bounds[text], high - bounds[text]


def run_hashes(sums: np.ndarray, low: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
    return tb.mixed(tb.span_hashes(sums, low, end) + place.astype(np.uint64)).view(np.int64)


def _pieces(data: np.ndarray, bounds: np.ndarray, length: int):
    """The slice as a whole, or overlapping parts of a text too long for one pass."""
    most = (1 << int(PLACE_BITS)) - length
    if len(data) <= most:
        yield data, bounds, 0
        return
    for at in range(0, len(data), most):  # a text this long comes alone
        part = data[at:at + most + length - 1]
        yield part, np.array([0, len(part)]), at


def run_table(docs: DataFrame, length: int) -> DataFrame:
    """``anchor, run, doc_id, place, again`` of every run; ``place`` is first start * 128 + further starts.

    ``again`` marks runs that an earlier one in the same batch repeats as a
    whole, so that a hot string's copies need not meet in one task.
    """
    def find(batch):
        data, bounds = tb.buffer_of(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        out = [[], [], [], []]
        for part, edges, at in _pieces(data, bounds, length):
            anchor, run, text, low, high = anchor_runs(part, edges, length)
            if at:  # starts at the seam belong to the part before
                low, high = low + at, high + at
            for values, own in zip(out, (anchor, run, ids[text] if len(text) else text, low * SPAN + (high - low))):
                values.append(np.asarray(own, np.int64))
        found = dict(zip(("anchor", "run", "doc_id", "place"), map(np.concatenate, out)))
        order = np.lexsort([found[name] for name in ("place", "doc_id", "run", "anchor")])
        same = np.zeros(len(order), bool)
        if len(order):
            anchor, run, doc_id, place = (found[name][order] for name in found)
            group = np.ones(len(order), bool)
            group[1:] = (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])
            head = np.flatnonzero(group)[np.cumsum(group) - 1]
            same[order] = (doc_id != doc_id[head]) | (place != place[head])
        return {**found, "again": same}

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint"), "text")
    return per_batch(named, find, "anchor bigint, run bigint, doc_id bigint, place bigint, again boolean")


def sorted_runs(runs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Runs that repeat an earlier one as a whole, and first runs of anchors that have several.

    ``hot`` marks the runs of anchors with more than ``hot_runs`` first runs.
    """
    same = Window.partitionBy("key", "anchor", "run").orderBy("doc_id", "place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    all_runs = Window.partitionBy("key", "anchor")
    first = F.first(F.struct("doc_id", "place")).over(same)
    # Settled runs go anywhere, the others meet by their anchor.
    kept = (runs.withColumn("key", F.when(F.col("again"), F.xxhash64("doc_id", "place")).otherwise(F.col("anchor")))
            .repartition("key")
            .withColumn("again", F.col("again") | (first != F.struct("doc_id", "place")))
            .withColumns({"low": F.min("run").over(all_runs), "high": F.max("run").over(all_runs),
                          "hot": F.sum((~F.col("again")).cast("bigint")).over(all_runs) > hot_runs})
            .where("again OR low <> high"))
    return stored(kept.select("anchor", "run", "doc_id", "place", "again", "hot"), "string-runs")


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes, ranks, and ranks by the last power of two up to it.

    Starts from eight-byte keys; each round doubles the compared length and
    sorts only the groups that are not yet settled. Equal ranks mean equal
    bytes for suffixes that long; of the shorter ones those that end in zero
    bytes may be out of order.
    """
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    order = np.argsort(key, kind="stable")
    keys = key[order]
    head = np.ones(n, bool)
    head[1:] = keys[1:] != keys[:-1]
    rank = np.zeros(n + 1, np.int64)  # the end of the text ranks below all
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    reach, at_power = 8, None
    while reach < depth:
        if reach * 2 > depth:
            at_power = rank[:n].copy()
        ranks = rank[order]
        single = np.ones(n, bool)
        single[:-1] &= ranks[:-1] != ranks[1:]
        single[1:] &= ranks[1:] != ranks[:-1]
        open_at = np.flatnonzero(~single)
        if len(open_at):
            suffix = order[open_at]
            pair = rank[suffix] * (n + 2) + rank[np.minimum(suffix + reach, n)]
            by = np.argsort(pair, kind="stable")
            order[open_at] = suffix = suffix[by]
            pair = pair[by]
            head = np.ones(len(pair), bool)
            head[1:] = pair[1:] != pair[:-1]
            rank[suffix] = open_at[np.maximum.accumulate(np.where(head, np.arange(len(pair)), 0))] + 1
        reach *= 2
    return order, rank[:n], rank[:n].copy() if at_power is None else at_power


def common_prefixes(text: bytes, order: np.ndarray, near: np.ndarray, known: int, depth: int) -> np.ndarray:
    """Common prefix with the suffix before, by Kasai's rule, up to ``depth``.

    ``near`` marks places in the order whose suffix shares ``known`` bytes with
    the one before; the others count as 0. Going through the text, a suffix
    loses at most one byte of what the suffix before it had in common; as the
    order is settled for a bounded depth only, its neighbour may have less, so
    what is carried over is compared.
    """
    lcp = np.zeros(len(order), np.int64)
    at = np.flatnonzero(near)
    by = np.argsort(order[at], kind="stable")
    at = at[by]
    found, last, h = [], -2, known
    n = len(text)
    for i, j in zip(order[at].tolist(), order[at - 1].tolist()):
        h = max(h - 1, known) if i == last + 1 else known
        if h > known and text[i + known:i + h] != text[j + known:j + h]:
            h = known
        end = min(depth, n - i, n - j)
        if h < end and text[i + h:i + end] == text[j + h:j + end]:
            h = max(h, end)
        while h < end and text[i + h] == text[j + h]:
            h += 1
        found.append(h)
        last = i
    lcp[at] = found
    return lcp


def repeated_starts(contexts: list[bytes], length: int, seen: np.ndarray | None = None,
                    open_from: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """For each context the places whose string occurs earlier, and the strings of the last anchor.

    Contexts stand in the order of their occurrences. ``seen`` holds sorted
    strings of earlier shards for the first anchor; contexts from ``open_from``
    on have the last anchor, whose distinct strings are returned sorted.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = b"".join(contexts)
    data = np.frombuffer(text, np.uint8)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    is_start = np.arange(len(data)) + length <= ends[owner]
    order, _, at_power = suffix_array(data, length)
    order = order[is_start[order]]
    near = np.zeros(len(order), bool)
    near[1:] = at_power[order[1:]] == at_power[order[:-1]]
    group = np.cumsum(common_prefixes(text, order, near, 1 << (length.bit_length() - 1), length) < length)
    by = np.lexsort((order, group))
    suffix, group = order[by], group[by]
    first = np.ones(len(suffix), bool)
    first[1:] = group[1:] != group[:-1]
    again = np.zeros(len(data), bool)
    again[suffix[~first]] = True
    kept = suffix[first]
    if seen is not None and len(seen):
        strings = _strings(data, kept, length)
        where = np.minimum(np.searchsorted(seen, strings), len(seen) - 1)
        again[kept[seen[where] == strings]] = True
    tail = kept[(owner[kept] >= open_from)] if len(kept) else kept
    tail = tail[~again[tail]]
    opened = np.sort(_strings(data, tail, length))
    return [np.flatnonzero(again[a:b]) for a, b in zip(begins.tolist(), ends.tolist())], opened


def _strings(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Strings at ``starts``, each with a final byte so that none ends in a zero."""
    out = np.ones((len(starts), length + 1), np.uint8)
    out[:, :length] = data[starts[:, None] + np.arange(length)]
    return out.reshape(-1).view(f"S{length + 1}")


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc_id, text, runs`` of the texts with one of ``runs``."""
    lists = runs.groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "run", "place")).alias("runs"))  # as many as the text has anchors
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint"), "text")
    return named.join(lists, "doc_id").select("doc_id", "text", "runs")


def _contexts(part: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Anchor, id, first start and bytes of every run of the texts of a slice."""
    for row in range(part.num_rows):
        text = (part.column(1)[row].as_py() or "").encode()
        doc_id, runs = part.column(0)[row].as_py(), part.column(2)[row].values
        for anchor, place in zip(runs.field("anchor").to_pylist(), runs.field("place").to_pylist()):
            start = place // SPAN
            context = text[start:start + place % SPAN + length]
            if len(context) >= length:
                yield anchor, doc_id, start, context


def compared_runs(runs: DataFrame, docs: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``doc_id, low, high``: covered bytes found by comparing runs that share only their anchor."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: dict[str, list] = {"anchor": [], "doc_id": [], "start": [], "context": []}
                for found in _contexts(part, length):
                    for name, value in zip(out, found):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(out["anchor"], pa.int64()), "doc_id": pa.array(out["doc_id"], pa.int64()),
                    "start": pa.array(out["start"], pa.int64()), "context": pa.array(out["context"], pa.binary())})

    contexts = (_with_runs(docs, runs.where("NOT again AND NOT hot"))
                .mapInArrow(cut, "anchor bigint, doc_id bigint, start bigint, context binary").distinct()
                .repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, seen, seen_anchor = 0, None, None

        def shard():
            nonlocal seen, seen_anchor
            anchors = [row[0] for row in held]
            own = seen if anchors[0] == seen_anchor else None
            again, opened = repeated_starts([row[3] for row in held], length, own, anchors.index(anchors[-1]))
            if anchors[-1] == seen_anchor:  # the whole shard belongs to the open anchor
                opened = np.sort(np.concatenate([seen, opened]))
            seen, seen_anchor = opened, anchors[-1]
            rows = [(row[1], row[2] + a, row[2] + b + length)
                    for row, found in zip(held, again) for a, b in _ranges(found)]
            return pa.RecordBatch.from_pydict({
                name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(("doc_id", "low", "high"))})

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                size += len(row[3])
                if size >= shard_bytes:
                    yield shard()
                    held, size = [], 0
        if held:
            yield shard()

    return contexts.mapInArrow(merge, "doc_id bigint, low bigint, high bigint")


def settled_strings(ids: np.ndarray, starts: np.ndarray, contexts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """``one, two, doc_id, low, high, again``: strings of ``contexts`` with their two hashes.

    Strings that an earlier one here repeats are settled, as joined ranges with
    ``again``; so a hot string leaves one open row, however many copies there are.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    count = sizes - length + 1
    slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(sizes) - sizes, count) + slot
    doc_id, low = np.repeat(ids, count), np.repeat(starts, count) + slot
    one, two = (tb.span_hashes(tb.prefix_sums(data, values), at, at + length).view(np.int64)
                for values in (tb._VALUES, _OTHER_VALUES))
    order = np.lexsort((low, doc_id, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    again = np.zeros(len(order), bool)
    again[order] = (doc_id[order] != doc_id[head]) | (low[order] != low[head])
    by = np.flatnonzero(again)
    by = by[np.lexsort((low[by], doc_id[by]))]
    cut = np.ones(len(by), bool)
    cut[1:] = (doc_id[by[1:]] != doc_id[by[:-1]]) | (low[by[1:]] > low[by[:-1]] + 1)
    begin, end = by[cut], by[np.append(np.flatnonzero(cut)[1:], len(by)) - 1] if len(by) else by
    opened = np.flatnonzero(~again)
    return {"one": np.concatenate([one[opened], one[begin]]), "two": np.concatenate([two[opened], low[begin]]),
            "doc_id": np.concatenate([doc_id[opened], doc_id[begin]]),
            "low": np.concatenate([low[opened], low[begin]]),
            "high": np.concatenate([low[opened], low[end]]) + length,
            "again": np.arange(len(opened) + len(begin)) >= len(opened)}


def hashed_runs(runs: DataFrame, docs: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``doc_id, low, high``: covered bytes of hot anchors' runs, found by the hashes of their strings."""
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, starts, contexts, size = [], [], [], 0

        def settled():
            return pa.RecordBatch.from_pydict(settled_strings(
                np.array(ids, np.int64), np.array(starts, np.int64), contexts, length))

        for batch in batches:
            for part in slices(batch):
                for _, doc_id, start, context in _contexts(part, length):
                    ids.append(doc_id)
                    starts.append(start)
                    contexts.append(context)
                    size += len(context)
                    if size >= shard_bytes:
                        yield settled()
                        ids, starts, contexts, size = [], [], [], 0
        if contexts:
            yield settled()

    strings = _with_runs(docs, runs.where("NOT again AND hot")).mapInArrow(
        find, "one bigint, two bigint, doc_id bigint, low bigint, high bigint, again boolean")
    # Settled ranges go anywhere; of an open string a task has one row for each megabyte that holds it.
    same = Window.partitionBy("again", "one", "two", F.when(F.col("again"), F.col("doc_id"))).orderBy(
        "doc_id", "low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.struct("doc_id", "low")).over(same)
    return strings.withColumn("again", F.col("again") | (first != F.struct("doc_id", "low"))).where("again").select(
        "doc_id", "low", "high")


def _ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()))


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                   hot_runs: int = HOT_RUNS) -> DataFrame:
    """``doc_id, spans``: the maximal byte runs of each text that earlier strings cover."""
    runs = sorted_runs(run_table(docs, length), hot_runs)
    whole = runs.where("again").select(
        "doc_id", F.expr(f"place div {SPAN}").alias("low"),
        (F.expr(f"place div {SPAN}") + F.col("place") % SPAN + length).alias("high"))
    covered = whole.unionByName(compared_runs(runs, docs, length, shard_bytes))
    if not runs.where("NOT again AND hot").isEmpty():
        covered = covered.unionByName(hashed_runs(runs, docs, length, shard_bytes))
    return covered.groupBy("doc_id").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, text, own_id``: rows under numbers in the order of their ids, where ids are not numbers of their own.

    Where ids are unique and not null they are the numbers. Else pairs of id and
    text are numbered by id, null ids last, and MD5 of the text; rows equal in
    both share a number. Numbers come from narrow rows sorted over ranges, and
    the texts are shuffled once and written under them.
    """
    own = docs.select("doc_id", "text", F.col("doc_id").alias("own_id"))
    unsure = docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if unsure.isEmpty():
        return own
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    order = [F.col("own_id").asc_nulls_last(), F.col("digest")]
    pairs = docs.select(F.col("doc_id").alias("own_id"), digest.alias("digest")).distinct()
    numbers = stored(pairs.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("doc_id", F.monotonically_increasing_id()), "row-numbers")
    named = numbers.select(F.col("own_id").alias("_id"), F.col("digest").alias("_digest"), "doc_id")
    rows = own.drop("doc_id").withColumn("digest", digest)
    return stored(rows.join(named, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
                  .select("doc_id", "text", "own_id"), "numbered-rows")


def remove_repeated(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                    hot_runs: int = HOT_RUNS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row.

    ``kept`` holds the remaining bytes. Texts shorter than ``length`` bytes, null
    and empty ones lose nothing; texts of any length are judged whole. Rows with
    a null id come after all others. Rows with equal ids and different texts are
    documents of their own, in the order of their texts' MD5; rows equal in both
    are the same document and keep what they have in common. Other columns are
    ignored, whatever their names, and an empty table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType
    docs = _numbered(docs.select("doc_id", "text"))
    spans = repeated_spans(docs, length, shard_bytes, hot_runs)
    rows = docs.join(spans.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "doc_id", "left").select(
        F.col("own_id").alias("doc_id"), "text", "spans")

    def cut(batch):
        out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = (text or "").encode()
            merged: list[list[int]] = []
            for low, high in sorted((s["low"], min(s["high"], len(raw))) for s in spans or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                elif low < high:
                    merged.append([low, high])
            at, kept = 0, []
            for low, high in merged:
                kept.append(raw[at:low])
                at = high
            rest = b"".join([*kept, raw[at:]])
            for name, value in zip(out, (len(raw), len(raw) - len(rest), len(merged),
                                         hashlib.sha256(rest).hexdigest(), rest)):
                out[name].append(value)
        return {"doc_id": batch.column(0), **out}

    return per_batch(rows, cut, f"doc_id {id_type.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                "kept_sha256 string, kept binary")


@query()
def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(id_and_text(load(spark, sf_dir, "documents"))).drop("kept")
