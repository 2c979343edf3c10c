import hashlib
import random

import pytest

from barograph.llm import repeated_strings as rs
from barograph.llm.common import id_and_text
from tests.llm.fixtures import awkward, empty, prose


def brute(docs, length=100):
    docs = sorted((d, (t or "").encode()) for d, t in docs)
    first, out = {}, {}
    for d, t in docs:
        for s in range(len(t) - length + 1):
            first.setdefault(t[s:s + length], (d, s))
    for d, t in docs:
        cover = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if first[t[s:s + length]] < (d, s):
                cover[s:s + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, cover) if not c)
        spans = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out[d] = (len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def documents():
    rng = random.Random(3)
    base = [prose(k, 60) for k in range(12)]
    docs = [(k, t) for k, t in enumerate(base, 100)]
    passage = prose(99, 40)
    docs += [(200 + k, prose(200 + k, rng.randrange(0, 30)) + passage + prose(300 + k, 20)) for k in range(30)]
    docs += [(300, "a" * 700), (301, "b" + "a" * 150), (302, base[0] + base[0]), (303, base[1][:99]),
             (304, base[1][:100]), (305, base[2][13:250] + "é" * 80), (306, "é" * 120), (307, ("xyz " * 90))]
    return docs


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2_000])
def test_equals_brute_force(spark, shard_bytes):
    docs = documents()
    df = awkward(spark, docs).where("doc_id IS NOT NULL AND doc_id <> 7").dropDuplicates(["doc_id"])
    found = rs.remove_repeated(id_and_text(df), shard_bytes=shard_bytes).collect()
    wanted = brute([(r.doc_id, r.text) for r in df.collect()])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == wanted
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_awkward_rows(spark):
    text = prose(1, 50)
    df = awkward(spark, [(20, text), (20, text), (None, text), (21, text)])
    found = rs.remove_repeated(id_and_text(df)).collect()
    assert len(found) == 14
    removed = {(r.doc_id, r.n_removed) for r in found if r.n_removed}
    assert removed == {(21, len(text)), (None, len(text))}  # the row without an id is the last
    assert rs.remove_repeated(id_and_text(empty(spark))).count() == 0


def test_rows_with_equal_and_null_ids_are_judged_one_by_one(spark):
    passage, own = prose(1, 50), prose(2, 60)
    rows = [(0, passage), (1, passage + " tail"), (1, own), (1, own), (2, own + passage), (None, passage), (None, prose(3, 60)),
            (None, prose(3, 60)), (None, None), (3, "")]
    found = rs.remove_repeated(id_and_text(awkward(spark, rows))).collect()
    order = lambda r: (r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest() if r.text is not None else "")
    table = awkward(spark, rows).select("doc_id", "text").collect()
    numbers = {key: k for k, key in enumerate(sorted({order(r) for r in table}))}
    wanted = brute({(numbers[order(r)], r.text) for r in table if r.doc_id != 7})
    mine = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found if r.doc_id != 7)
    assert mine == sorted((str(r.doc_id), *wanted[numbers[order(r)]]) for r in table if r.doc_id != 7)
    assert sum(r.n_removed == 0 for r in found if r.doc_id == 1) >= 2


def test_suffix_array_and_common_prefixes():
    import numpy as np
    text = (b"banana bandana " * 30 + b"banana" * 40)
    order, _, at_64 = rs.suffix_array(np.frombuffer(text, np.uint8), 100)
    assert all(text[a:a + 100] <= text[b:b + 100] for a, b in zip(order, order[1:]))
    near = np.zeros(len(order), bool)
    near[1:] = at_64[order[1:]] == at_64[order[:-1]]
    lcp = rs.common_prefixes(text, order, near, 64, 100)
    for k in np.flatnonzero(near):
        i, j, h = order[k], order[k - 1], 0
        while h < 100 and max(i, j) + h < len(text) and text[i + h] == text[j + h]:
            h += 1
        assert lcp[k] == h


@pytest.mark.parametrize("hot_runs, shard_bytes", [(0, 1 << 20), (4, 900), (4, 1 << 20)])
def test_hot_anchors_go_by_string_and_equal_brute_force(spark, hot_runs, shard_bytes):
    docs = documents()
    df = awkward(spark, docs).where("doc_id IS NOT NULL AND doc_id <> 7").dropDuplicates(["doc_id"])
    found = rs.remove_repeated(id_and_text(df), shard_bytes=shard_bytes, hot_runs=hot_runs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(
        [(r.doc_id, r.text) for r in df.collect()])


def test_no_anchor_brings_more_runs_than_the_bound_to_one_comparison(spark):
    passage = prose(99, 40)
    rows = [(k, prose(k, 20) + passage + prose(1000 + k, 20)) for k in range(200)]
    df = id_and_text(awkward(spark, [*rows, rows[0]]).where("doc_id >= 10"))
    runs = rs.sorted_runs(rs.run_table(df, 100), 50)
    met = runs.where("NOT again AND NOT hot").groupBy("anchor").count()
    assert runs.where("NOT again AND hot").count() > 300 and (met.agg({"count": "max"}).first()[0] or 0) <= 50
    strings = rs.hashed_runs(runs, df, 100, 1 << 20)
    assert strings.count() > 0 and strings.where("doc_id = 10").count() == 0


def contexts_with_edits(seed, letters):
    rng = random.Random(seed)
    bases = [bytes(rng.choice(letters) for _ in range(300)) for _ in range(3)]
    out = []
    for _ in range(20):
        start = rng.randrange(0, 200)
        context = bytearray(rng.choice(bases)[start:start + rng.randrange(100, 177)])
        for _ in range(rng.randrange(0, 3)):
            context[rng.randrange(len(context))] = rng.choice(letters)
        out.append(bytes(context) if len(context) >= 100 else bytes(context).ljust(100, letters[-1:]))
    return out


@pytest.mark.parametrize("letters, length", [(b"ab", 100), (b"\0a", 100), (bytes(range(97, 123)), 100), (b"ab", 50), (b"a b", 64)])
def test_repeated_starts_of_texts_that_nearly_repeat(letters, length):
    """Neighbours that share more than the sorted depth, zero bytes at the end, strings shorter than 64 bytes."""
    for seed in range(150):
        contexts, seen, wanted = contexts_with_edits(seed, letters), set(), []
        for context in contexts:
            strings = [context[s:s + length] for s in range(len(context) - length + 1)]
            wanted.append([])
            for s, string in enumerate(strings):
                if string in seen:
                    wanted[-1].append(s)
                seen.add(string)
        assert [found.tolist() for found in rs.repeated_starts(contexts, length)[0]] == wanted


def test_licence_texts_of_few_words_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["the", "licence", "is", "granted", "copy", "of"]
    bases = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(4)]
    docs = []
    for k in range(300):
        text = list("".join(b[rng.randrange(0, 200):] for b in rng.sample(bases, 2)))
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(len(text))] = rng.choice("teicof ")
        docs.append((k * 3 - 20, "".join(text)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = rs.remove_repeated(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(docs)
