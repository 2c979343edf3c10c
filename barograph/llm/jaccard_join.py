"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Texts with equal shingle sets form a class and are joined as one. Each class
orders its shingles by rarity, taken from counts over all texts in a sketch of
fixed size, and lists its prefix. Two classes above the threshold share a prefix
shingle; length, position and suffix bounds drop most candidates, and what is
left is verified on the texts.

A shingle's classes are never paired with each other all at once. In a round one
class of each shingle is tested against its others, and what turns out connected
needs no further test. A round with new classes follows, and the last round
pairs what is still in different components and within the bounds, each pair at
its first common shingle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm import textbytes as tb
from barograph.llm.common import discard, id_and_text, load, per_batch, query, slices, stored
from barograph.llm.components import components

WORDS = 5
PERCENT = 80
#: Cells of the rarity sketch: 4 MB as one byte each.
CELL_BITS = 22
SEGMENT_BITS = 16
SUFFIX_BINS = 64
#: Bits of the filter that picks the texts of candidate classes.
CLASS_BITS = 1 << 25
STAR_ROUNDS = 2
#: Shared shingles of a class that its rows carry, to tell whether two classes met before.
FIRSTS = 16


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    data, bounds = tb.buffer_of(column)
    start, end, first = tb.words(data, bounds, tb.SOLID)
    hashes = tb.span_hashes(tb.prefix_sums(data, tb.LOWER_VALUES), start, end)
    grams = tb.shingles(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            own = np.sort(grams[a:b - size + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        else:
            out.append(tb.shingles(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def class_of(grams: np.ndarray) -> int:
    """64-bit name of a shingle set."""
    with np.errstate(over="ignore"):
        total = tb.mixed(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(tb.mixed(np.array([total + np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


def needed_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection of sets of ``n`` and ``m`` shingles at the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def suffix_counts(grams: np.ndarray) -> bytes:
    """Shingles in each part of the hash range, at most 255 each."""
    counts = np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=SUFFIX_BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def set_classes(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, class, bins`` of every row; the class is null for an empty set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def describe(batch):
        sets = shingle_sets(batch.column(1), size)
        return {"doc_id": batch.column(0), "n": [len(s) for s in sets],
                "class": [class_of(s) if len(s) else None for s in sets],
                "bins": [suffix_counts(s) for s in sets]}

    return per_batch(docs, describe, f"doc_id {id_type}, n bigint, class bigint, bins binary")


def rarity_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """For each cell of the hash range, the logarithm of the number of shingles in it.

    Counts cover every text. Each task sends its counts by segment of the range,
    sparse where that is shorter; the sums come to the driver as 4 MB whatever
    the input.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch):
                grams = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(part.column(0), size)])
                at, n = np.unique((grams >> np.uint64(64 - CELL_BITS)).astype(np.int64), return_counts=True)
                cells[at] += n.astype(np.uint32)
        for segment, own in enumerate(np.minimum(cells, 65535).astype("<u2").reshape(-1, 1 << SEGMENT_BITS)):
            at = np.flatnonzero(own)
            if len(at):
                dense = 2 * len(at) > len(own)
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([segment], pa.int32()),
                    "at": pa.array([None if dense else at.astype("<u2").tobytes()], pa.binary()),
                    "n": pa.array([(own if dense else own[at]).tobytes()], pa.binary())})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                segment, at = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                total = sums.setdefault(segment, np.zeros(1 << SEGMENT_BITS, np.int64))
                n = np.frombuffer(batch.column(2)[row].as_py(), "<u2")
                if at is None:
                    total += n
                else:
                    total[np.frombuffer(at, "<u2")] += n
        for segment, total in sums.items():
            codes = np.minimum(np.ceil(4 * np.log2(total + 1.0)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()),
                                              "codes": pa.array([codes.tobytes()], pa.binary())})

    counted = docs.select("text").mapInArrow(count, "segment int, at binary, n binary")
    segments = 1 << (CELL_BITS - SEGMENT_BITS)
    summed = counted.repartitionById(segments, F.col("segment")).mapInArrow(add, "segment int, codes binary")
    sketch = np.zeros((segments, 1 << SEGMENT_BITS), np.uint8)
    for row in summed.collect():
        sketch[row.segment] = np.frombuffer(row.codes, np.uint8)
    return sketch.reshape(-1)


def prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``gram, class, n, place``: the rarest shingles of each class that a partner must share one of."""
    sketch = docs.sparkSession.sparkContext.broadcast(rarity_sketch(docs, size))

    def list_prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in one task are listed once
        for batch in batches:
            for part in slices(batch):
                grams, classes, sizes, places = [], [], [], []
                for own in shingle_sets(part.column(0), size):
                    n = len(own)
                    name = class_of(own) if n else None
                    if n == 0 or name in seen:
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(name)
                    length = n - -(-percent * n // 100) + 1
                    rarity = sketch.value[(own >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
                    key = (rarity << np.uint64(56)) | (own >> np.uint64(8))
                    best = np.argpartition(key, length - 1)[:length] if length < n else np.arange(n)
                    best = best[np.lexsort((own[best], key[best]))]
                    grams.append(own[best].view(np.int64))
                    classes.append(np.full(len(best), name))
                    sizes.append(np.full(len(best), n))
                    places.append(np.arange(len(best)))
                if grams:
                    yield pa.RecordBatch.from_pydict({
                        "gram": pa.array(np.concatenate(grams)), "class": pa.array(np.concatenate(classes)),
                        "n": pa.array(np.concatenate(sizes).astype(np.int32)),
                        "place": pa.array(np.concatenate(places).astype(np.int32))})

    return docs.select("text").mapInArrow(list_prefixes, "gram bigint, class bigint, n int, place int")


def shared_prefixes(listed: DataFrame) -> DataFrame:
    """Rows of ``listed`` whose shingle more than one class lists.

    ``rank`` counts the class's shared shingles before this one and ``shared``
    all of them.
    """
    listed = stored(listed, "prefixes")
    grams = listed.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    own = Window.partitionBy("class")
    rows = (listed.join(grams.where("low <> high").select("gram"), "gram")
            .repartition("class").dropDuplicates(["class", "place", "gram", "n"])
            .withColumns({"rank": F.row_number().over(own.orderBy("place")) - 1, "shared": F.count("*").over(own)}))
    found = stored(rows, "shared-prefixes")
    discard(listed)
    return found


def _with_earlier(state: DataFrame, shared: DataFrame) -> DataFrame:
    """``state`` with ``earlier``: the class's shared shingles before this one, of its first ``FIRSTS``."""
    open_classes = state.select("class").distinct()
    firsts = shared.where(F.col("rank") < FIRSTS).join(open_classes, "class", "left_semi").groupBy("class").agg(
        F.collect_list(F.struct("rank", "gram")).alias("firsts"))
    before = F.filter("firsts", lambda first: first["rank"] < F.col("rank"))
    return state.join(firsts, "class").withColumn("earlier", F.transform(before, lambda first: first["gram"])).drop("firsts")


def _may_link(percent: int, first_meeting: bool = False):
    """Length and position bounds for columns ``n, place, rank`` and the pivot's.

    Common shingles before this one stand in both prefixes, so they are among
    those before it that either class shares with any other. With
    ``first_meeting`` a pair counts only where no earlier common shingle is
    known: all prefixes have one order, so it was there at that shingle, too.
    Then only those beyond the first ``FIRSTS`` of either can be common.
    """
    n, m, i, j = F.col("n"), F.col("pivot.n"), F.col("place"), F.col("pivot.place")
    rank, other = F.col("rank"), F.col("pivot.rank")
    before, new = F.least(rank, other), F.lit(True)
    if first_meeting:
        new = ~F.arrays_overlap("earlier", "pivot.earlier")
        before = F.least(before, F.greatest(rank - FIRSTS, F.lit(0)) + F.greatest(other - FIRSTS, F.lit(0)))
    room = before + 1 + F.least(n - i - 1, m - j - 1)
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (room * (100 + percent) >= (n + m) * percent) & new)


def _ordered_pairs(candidates: DataFrame, percent: int, first_meeting: bool = False) -> DataFrame:
    own = F.struct(F.col("class").alias("class"), F.col("n").alias("n"))
    other = F.struct(F.col("pivot.class").alias("class"), F.col("pivot.n").alias("n"))
    return (candidates.where(_may_link(percent, first_meeting))
            .select(F.least(own, other).alias("x"), F.greatest(own, other).alias("y"))
            .select(F.col("x.class").alias("a"), F.col("x.n").alias("n_a"),
                    F.col("y.class").alias("b"), F.col("y.n").alias("n_b")).distinct())


def _suffix_filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Drop pairs whose shingle counts differ by more than the threshold allows.

    Over any division of the hash range the count differences sum to at most
    the size of the symmetric difference.
    """
    bins = classes.select("class", "bins")
    wide = (pairs.join(bins.toDF("a", "bins_a"), "a").join(bins.toDF("b", "bins_b"), "b")
            .select("a", "b", "n_a", "n_b", "bins_a", "bins_b"))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SUFFIX_BINS)
                      .astype(np.int16) for k in (4, 5)]
            n, m = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
            apart = np.abs(counts[0] - counts[1]).sum(axis=1)
            fits = apart <= n + m - 2 * needed_overlap(n, m, percent)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return wide.mapInArrow(keep, "a bigint, b bigint")


def class_bitmap(named: DataFrame) -> np.ndarray:
    """One bit per name, modulo ``CLASS_BITS``: 4 MB whatever the input.

    Only spares texts a shuffle; a set bit of another class is sorted out by a join.
    """
    place = F.pmod(F.col("class"), F.lit(CLASS_BITS)) + 1
    buckets = named.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(CLASS_BITS // 8, np.uint8)
    for row in buckets:
        own = np.frombuffer(row.bits, np.uint8)
        bits[(row.bucket - 1) * 4096:(row.bucket - 1) * 4096 + len(own)] = own
    return bits


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs ``u, v`` of classes whose shingle sets reach the threshold."""
    named = stored(pairs.select("a").union(pairs.select("b")).distinct().toDF("class"), "candidate-classes")
    wanted = docs.sparkSession.sparkContext.broadcast(class_bitmap(named))

    def candidates(batch):
        sets = shingle_sets(batch.column(0), size)
        names = np.array([class_of(s) if len(s) else 0 for s in sets], np.int64)
        bit = names % CLASS_BITS
        kept = (wanted.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        kept &= np.array([len(s) > 0 for s in sets], bool)
        return {"class": names[kept], "text": batch.column(0).filter(pa.array(kept))} if kept.any() else None

    texts = stored(per_batch(docs.select("text"), candidates, "class bigint, text string")
                   .join(named, "class", "left_semi").dropDuplicates(["class"]), "candidate-texts")
    wide = (pairs.join(texts.toDF("a", "text"), "a").join(texts.toDF("b", "other"), "b")
            .select("a", "b", "text", "other"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                links = []
                for x, y in zip(shingle_sets(part.column(2), size), shingle_sets(part.column(3), size)):
                    common = len(x) + len(y) - len(np.union1d(x, y))
                    links.append(100 * common >= percent * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["u", "v"]).filter(pa.array(links))

    return wide.mapInArrow(verify, "u bigint, v bigint")


def linked_classes(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """``class, root`` of every class with a link to another one."""
    shared = shared_prefixes(prefixes(docs, size, percent))
    classes = stored(members.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("bins").alias("bins")), "classes")
    tested = links = labels = None
    row = ("class", "n", "place", "rank", "root")
    for turn in range(STAR_ROUNDS + 1):
        if labels is not None:
            state = shared.join(labels.select(F.col("node").alias("class"), "root"), "class", "left").withColumn(
                "root", F.coalesce("root", "class"))
        else:
            state = shared.withColumn("root", F.col("class"))
        # The pivot of a shingle is the class that shares most: edits only take away from it.
        pivot = F.max(F.struct("shared", *row)).alias("pivot")
        groups = state.groupBy("gram").agg(pivot, F.min("root").alias("low"), F.max("root").alias("high"))
        # Shingles whose classes are all connected have nothing left to test.
        state = stored(state.join(groups.where("low <> high").select("gram", "pivot"), "gram"), "open-prefixes")
        if turn == 0:
            candidates = state
        elif turn < STAR_ROUNDS:
            # Next pivots come from outside the first one's component.
            next_pivots = state.where("root <> pivot.root").groupBy("gram").agg(pivot)
            candidates = state.drop("pivot").join(next_pivots, "gram")
        else:
            state = stored(_with_earlier(state, shared), "last-prefixes")
            outside = state.where("root <> pivot.root").select("gram", F.struct(*row, "earlier").alias("pivot"))
            inside = state.withColumn("at_pivot", F.expr("root = pivot.root")).drop("pivot")
            # Of two classes outside the pivot's component each would meet the other.
            candidates = inside.join(outside, "gram").where("at_pivot OR class < pivot.class")
        pairs = _ordered_pairs(candidates.where("root <> pivot.root"), percent, turn == STAR_ROUNDS)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        discard(state)
        if pairs.isEmpty():
            continue
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        left = stored(_suffix_filtered(pairs, classes, percent), "pairs-to-verify")
        found = stored(_verified(left, docs, size, percent), "verified")
        links = found if links is None else links.union(found)
        labels = stored(components(links), "labels")
    if labels is None:
        return docs.sparkSession.createDataFrame([], "class bigint, root bigint")
    return labels.withColumnRenamed("node", "class")


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words end at ASCII white space, A-Z are lower-cased. The component is named
    by its smallest ``doc_id``. A null text, or one without words, has an empty
    set and is linked with nothing. Rows with equal texts are always connected.
    A null id names no component of its own: its row takes the smallest id of
    its component, or null where there is none.
    """
    members = stored(set_classes(docs, size), "shingle-classes")
    labels = linked_classes(docs, members, size, percent)
    own = members.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("smallest"))
    named = own.join(labels, "class", "left").withColumn("root", F.coalesce("root", "class"))
    per_root = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = named.join(per_root, "root").select("class", "component_id")
    empty = members.where("class IS NULL").select("doc_id", F.col("n").alias("n_shingles"),
                                                  F.col("doc_id").alias("component_id"))
    return members.join(named, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(empty)


@query(sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(list_slice(w, i + 1, i + 4)) AS g
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 0) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT g, count(*) AS df FROM s GROUP BY g HAVING count(*) > 1),
p AS (SELECT doc_id, g, n FROM s JOIN n USING (doc_id) LEFT JOIN rare USING (g)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(df, 1), g) <= n - ceil(n * 85 / 100.0) + 1),
c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y
  ON x.g = y.g AND x.doc_id < y.doc_id AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 85),
o AS (SELECT a, b, any_value(na) AS na, any_value(nb) AS nb, count(*) AS k
  FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b),
e AS (SELECT a, b FROM o WHERE 100 * k >= 85 * (na + nb - k)),
e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e2.b FROM r JOIN e2 ON r.seen = e2.a),
m AS (SELECT node AS doc_id, min(seen) AS component_id FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)
""")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(id_and_text(load(spark, sf_dir, "documents")), size=4, percent=85)
