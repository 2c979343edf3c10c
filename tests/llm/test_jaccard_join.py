import random

from barograph.llm import jaccard_join as jj
from barograph.llm.common import id_and_text
from barograph.llm.components import components
from tests.llm import fixtures
from tests.llm.fixtures import awkward, empty, prose, words_of


def brute(docs, size, percent):
    sets = []
    for doc_id, text in docs:
        w = words_of(text, r"[^\x20\x09-\x0D]+")
        sets.append((doc_id, {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    roots = fixtures.components([d for d, _ in sets], links)
    return sorted((d, len(s), roots[d]) for d, s in sets)


def edited(text, rng, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def documents():
    rng = random.Random(5)
    docs = [(1000 + k, prose(k, rng.randrange(1, 120), 50)) for k in range(60)]
    base = prose(7, 200)
    chain = base
    for k in range(40):  # a chain whose ends are not alike
        docs.append((2000 + k, chain))
        chain = edited(chain, rng, 4)
    docs += [(3000 + k, edited(base, rng, k % 9)) for k in range(60)]  # copies around the threshold
    docs += [(4000 + k, base) for k in range(5)] + [(5000, base.upper()), (5001, "\n".join(base.split()))]
    return docs


def test_equals_brute_force(spark):
    docs = documents()
    df = awkward(spark, docs).where("doc_id IS NOT NULL AND doc_id <> 7").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for size, percent in ((4, 85), (5, 80)):
        found = jj.near_duplicates(id_and_text(df), size, percent)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == brute(rows, size, percent)


def test_awkward_rows(spark):
    found = jj.near_duplicates(id_and_text(awkward(spark))).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 10
    assert by_id[5].component_id == 1 and by_id[1].n_shingles == 1
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (2, 3, 4))
    assert by_id[None].component_id is None and by_id[7].n_shingles > 70_000
    assert jj.near_duplicates(id_and_text(empty(spark))).count() == 0


def test_suffix_counts_bound_the_symmetric_difference():
    import numpy as np
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    y = np.unique(np.concatenate([x[:400], rng.integers(0, 1 << 63, 90).astype(np.uint64)]))
    a, b = (np.frombuffer(jj.suffix_counts(s), np.uint8).astype(int) for s in (x, y))
    assert np.abs(a - b).sum() <= len(np.setxor1d(x, y))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101 + i) for i in range(20)] + [(7, 7), (205, 200), (200, 205)]
    found = components(spark.createDataFrame(links, "u bigint, v bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert {roots[i] for i in range(51)} == {0} and {roots[100 + i] for i in range(21)} == {100}
    assert roots[205] == roots[200] == 200
