"""Benchmark decontamination by a prefix-filtered containment join.

The windows of the items are sets of three-word shingles. A text that contains
a window contains all its shingles, so one necessary prefix token is enough to
find it: the window's rarest shingle, by its document frequency over all texts.
Texts are joined on these tokens; length and position bounds drop matches that
leave no room for the window, and the rest is compared word by word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm import textbytes as tb
from barograph.llm.common import id_and_text, load, per_batch, query, row_key, stored

WINDOW = 10
SHINGLE = 3
#: Windows of one pass over the texts; about 40 MB in a task.
BLOCK_WINDOWS = 200_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STATE = "doc_id {id}, text string, n_words bigint, items array<string>, spans array<struct<start:int,stop:int>>"


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every run of ``size`` words of an item; an item of fewer words is one run.

    Items without words have none. A null ``item_id`` counts as the id ``null``.
    """
    tokens = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        F.expr("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               f"'abcdefghijklmnopqrstuvwxyz'), r'{WORD}', 0)").alias("tokens")
    ).where("size(tokens) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - size, F.lit(0)))
    return (tokens.select("item_id", "tokens", F.explode(starts).alias("start"))
            .select(F.slice("tokens", F.col("start") + 1, size).alias("words"), "item_id")
            .groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))


class WindowIndex:
    """One block of windows as arrays: tokens, and for each its windows."""

    def __init__(self, rows: list) -> None:
        self.texts = [" ".join(row.words).encode() for row in rows]
        self.items = [list(row.item_ids) for row in rows]
        self.sizes = np.array([len(row.words) for row in rows], np.int64)
        self.shingle_sizes = sorted({min(SHINGLE, n) for n in self.sizes.tolist()})
        self.grams = [self._grams(text) for text in self.texts]

    @staticmethod
    def _grams(text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        start, end, _ = tb.words(data, np.array([0, len(data)]), tb.ALNUM)
        hashes = tb.span_hashes(tb.prefix_sums(data, tb.LOWER_VALUES), start, end)
        return tb.shingles(hashes, min(SHINGLE, len(hashes)))

    def all_grams(self) -> np.ndarray:
        return np.unique(np.concatenate(self.grams))

    def choose(self, frequency: dict[int, int]) -> "WindowIndex":
        """Keep the rarest shingle of each window and its place in the window."""
        token, place = [], []
        for grams in self.grams:
            keys = [(frequency.get(int(g), 0), int(g)) for g in grams]
            best = min(range(len(keys)), key=keys.__getitem__)
            token.append(keys[best][1])
            place.append(best)
        order = np.argsort(np.array(token, np.uint64), kind="stable")
        sorted_tokens = np.array(token, np.uint64)[order]
        self.members = tb.Members(sorted_tokens)
        self.window_of = order
        self.place = np.array(place, np.int64)
        self.first = np.searchsorted(sorted_tokens, self.members.values)
        self.count = np.diff(np.append(self.first, len(order)))
        del self.grams
        return self


def _hashed(batch):
    data, bounds = tb.buffer_of(batch.column(batch.schema.get_field_index("text")))
    start, end, first = tb.words(data, bounds, tb.ALNUM)
    hashes = tb.span_hashes(tb.prefix_sums(data, tb.LOWER_VALUES), start, end)
    return data, start, end, first, hashes


def _split_free(first: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text of the word numbers ``at``, and whether ``size`` words stay inside it."""
    doc = np.searchsorted(first, at, side="right") - 1
    return doc, at + size <= first[doc + 1]


def gram_frequency(docs: DataFrame, grams: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """Number of texts with each of the given shingles, over all texts."""
    members = tb.Members(grams)

    def count(batch):
        _, _, _, first, hashes = _hashed(batch)
        seen = []
        for size in sizes:
            at, which = members.find(tb.shingles(hashes, size))
            doc, inside = _split_free(first, at, size)
            seen.append(doc[inside] * len(members.values) + which[inside])
        pairs = np.unique(np.concatenate(seen)) % len(members.values)
        found, n = np.unique(pairs, return_counts=True)
        return {"gram": members.values[found].view(np.int64), "n": n} if len(found) else None

    counted = per_batch(docs.select("text"), count, "gram bigint, n bigint")
    rows = counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()  # no more than the block has
    return {row.gram & 0xFFFFFFFFFFFFFFFF: row.n for row in rows}


def find_windows(docs: DataFrame, items: DataFrame, size: int = WINDOW,
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Windows of ``items`` in each text of ``docs``.

    Returns ``doc_id, n_words, items, spans``: the sorted ids of items with an
    occurring window, and the disjoint runs of hit words as word numbers. Null
    and empty texts have no words and no hits; every row gives one row, also
    rows with equal ids. With no items nothing is hit. Items in blocks of
    ``block_windows`` windows are looked up one block after the other.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = STATE.format(id=id_type)
    windows = stored(item_windows(items, size), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    state = docs.select(
        "doc_id", "text", F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("array<struct<start:int,stop:int>>").alias("spans"))
    for block in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        index = None
        if rows:
            index = WindowIndex(rows)
            frequency = gram_frequency(docs, index.all_grams(), index.shingle_sizes)
            index.choose(frequency)
        last = block == blocks - 1
        state = per_batch(state, _finder(spark, index, keep_text=not last), schema)
        if not last:
            state = stored(state, "windows-found")
    return state.drop("text")


def _finder(spark: SparkSession, index: WindowIndex | None, keep_text: bool):
    shared = spark.sparkContext.broadcast(index)

    def find(batch):
        index = shared.value
        data, start, end, first, hashes = _hashed(batch)
        items = [set(x or ()) for x in batch.column(3).to_pylist()]
        spans = [[(s["start"], s["stop"]) for s in x or ()] for x in batch.column(4).to_pylist()]
        if index is not None:
            _search(index, data, start, end, first, hashes, items, spans)
        return {
            "doc_id": batch.column(0),
            "text": batch.column(1) if keep_text else [None] * batch.num_rows,
            "n_words": np.diff(first),
            "items": [sorted(x) for x in items],
            "spans": [[{"start": a, "stop": b} for a, b in _merged(x)] for x in spans],
        }

    return find


def _search(index, data, start, end, first, hashes, items, spans) -> None:
    for size in index.shingle_sizes:
        at, which = index.members.find(tb.shingles(hashes, size))
        if not len(at):
            continue
        repeat = index.count[which]
        slot = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        window = index.window_of[np.repeat(index.first[which], repeat) + slot]
        token_at = np.repeat(at, repeat)
        begin = token_at - index.place[window]
        doc = np.searchsorted(first, token_at, side="right") - 1
        fits = ((np.minimum(index.sizes[window], SHINGLE) == size) & (begin >= first[doc])
                & (begin + index.sizes[window] <= first[doc + 1]))
        last, joined, word_at = -1, b"", None
        for d, w, b in zip(doc[fits].tolist(), window[fits].tolist(), begin[fits].tolist()):
            if d != last:
                own = slice(first[d], first[d + 1])
                last, joined, word_at = d, *_joined(data, start[own], end[own])
            low = b - first[d]
            text = index.texts[w]
            if joined[word_at[low]:word_at[low] + len(text) + 1] == text + b" ":
                items[d].update(index.items[w])
                spans[d].append((int(low), int(low + index.sizes[w])))


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, list[int]]:
    """Lower-cased words, each followed by a space, and where each begins."""
    low = tb.LOWER[data[start[0]:end[-1]]].tobytes()
    base = start[0]
    words = [low[a:b] for a, b in zip((start - base).tolist(), (end - base).tolist())]
    begins = np.cumsum(end - start + 1) - (end - start + 1)
    return b" ".join(words) + b" ", begins.tolist()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` without any window of ``items``; all columns stay.

    Each row is decided by its own text, also where ids are null or repeated.
    Null and empty texts stay, texts of any length are searched whole, and an
    empty table, of documents or of items, takes nothing away.
    """
    keyed = docs.select(row_key(docs).alias("doc_id"), "text")
    hit = find_windows(keyed, items).where("size(items) > 0").select(F.col("doc_id").alias("_row_key")).distinct()
    return docs.join(stored(hit, "contaminated"), row_key(docs) == F.col("_row_key"), "left_anti")


@query(sql=r"""
WITH toks AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, list_slice(w, i + 1, i + 10) AS g
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM toks WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
dt AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
dw AS (SELECT doc_id, n, i, list_slice(w, i + 1, i + n) AS g
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM dt, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dt LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_windows(id_and_text(load(spark, sf_dir, "documents")), load(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
