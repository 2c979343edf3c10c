import hashlib
from math import floor, inf, nan

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from barograph.llm import vector_codes
from barograph.llm.vectors import integer_vectors, largest

SCHEMA = ("vec_id bigint, embedding array<float>, label int, x string, codes string, error string, "
          "n int, entry int, of_label int, size int")


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", "c", "e", 1, 2, 3, 4) for i, v, k in rows], SCHEMA)


def vectors(seed, count, size=8):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(v)) for v in row] for row in rng.normal(0, 0.2, (count, size))]


def usable(vector):
    return vector is not None and all(v is not None and np.isfinite(v) for v in vector)


def brute(rows, parts, entries, rounds):
    """Codes, errors and books by comparing every part with every entry."""
    kept = [(i, [floor(1024 * v) for v in vector], k) for i, vector, k in rows if usable(vector)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    split = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[split(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(q, e), at) for at, e in enumerate(books[p]))
                       for p, q in enumerate(split(v))] for _, v, _ in kept]
    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for at in range(len(books[p])):
                mine = [split(v)[p] for (_, v, _), found in zip(kept, near) if found[p][1] == at]
                if mine:
                    books[p][at] = [sum(c) // len(mine) for c in zip(*mine)]
    errors = {}
    out = []
    for (i, _, k), found in zip(kept, assign()):
        error = sum(d for d, _ in found)
        errors[k] = errors.get(k, 0) + error
        out.append((i, [at for _, at in found], error, k))
    return sorted(((i, c, e, errors[k]) for i, c, e, k in out), key=repr), ",".join(
        str(v) for book in books for entry in book for v in entry)


def found_rows(coded):
    return sorted(((r.vec_id, list(r.codes), r.error, r.label_error) for r in coded.collect()), key=repr)


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 4).flatmap(lambda d: st.tuples(
    st.lists(st.lists(st.integers(-6, 6), min_size=d, max_size=d), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-6, 6), min_size=d, max_size=d), min_size=1, max_size=40))), st.sampled_from([1, 1 << 29]))
def test_outward_search_equals_full_search_with_ties(case, factor):
    values, entries = (np.array(side, np.int64) * factor for side in case)
    which, best = vector_codes.nearest(values, entries)
    for row, at, distance in zip(values.astype(object), which, best):
        assert (distance, at) == min((int(((row - e) ** 2).sum()), k) for k, e in enumerate(entries.astype(object)))


def test_codes_and_books_equal_brute_force_on_awkward_rows(spark):
    v = vectors(1, 60)
    rows = [(100 + k, x, k % 3) for k, x in enumerate(v)]
    rows += [(1, None, 1), (2, [nan] + v[0][1:], 1), (3, [inf] + v[0][1:], 2), (4, [None] + v[0][1:], 2), (5, [], 1), (6, v[0][:5], 1),
             (None, v[3], None), (None, v[4], None), (100, v[5], 0), (100, v[5], 0), (7, v[6], None), *[(500 + k, v[7], 2) for k in range(40)]]
    coded, books = vector_codes.compress_vectors(table(spark, rows), parts=4, entries=16, rounds=4)
    wanted, text = brute([r for r in rows if r[1] is None or len(r[1]) == 8], 4, 16, 4)
    assert found_rows(coded) == wanted and books.text == text


def test_label_sums_are_the_same_by_shuffle(spark, monkeypatch):
    rows = [(k, x, None if k % 5 == 0 else k % 4) for k, x in enumerate(vectors(2, 50))]
    wanted = found_rows(vector_codes.compress_vectors(table(spark, rows), entries=8)[0])
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert found_rows(vector_codes.compress_vectors(table(spark, rows), entries=8)[0]) == wanted


def test_empty_tables_and_fewer_rows_than_entries(spark):
    coded, books = vector_codes.compress_vectors(table(spark, []))
    assert coded.count() == 0 and books.text == ""
    coded, books = vector_codes.compress_vectors(table(spark, [(1, None, 1), (2, [nan], 1)]))
    assert coded.count() == 0
    coded, books = vector_codes.compress_vectors(table(spark, [(1, [0.5] * 4, 1), (2, [0.25] * 4, 1)]))
    assert [r.error for r in coded.collect()] == [0, 0] and books.entries.shape == (4, 2, 1)


def test_odd_dimensions_are_filled_up_and_decoding_is_near(spark):
    rows = [(k, x, 1) for k, x in enumerate(vectors(3, 40, size=10))]
    coded, books = vector_codes.compress_vectors(table(spark, rows), entries=64)
    back = {r.vec_id: r.vector for r in vector_codes.decode_vectors(coded, books).collect()}
    assert books.entries.shape[2] == 3 and all(
        np.abs(np.array(back[i]) - np.array(x)).max() <= 0.5 / 1024 + 1e-9 for i, x, _ in rows)


def test_huge_components_are_clipped(spark):
    rows = [(1, [3e38, -3e38, 0.0, 1.0], 1), (2, [0.0] * 4, 1)]
    found = {r.vec_id: r.x for r in integer_vectors(table(spark, rows), {"vec_id": "bigint"}).collect()}
    top = largest(4)
    assert found[1] == [top, -top, 0, 1024]
    coded, _ = vector_codes.compress_vectors(table(spark, rows), entries=1, rounds=0)
    assert {r.vec_id: r.error for r in coded.collect()} == {1: 0, 2: 2 * top * top + 1024 ** 2}


def test_query_returns_the_contract(spark, tmp_path):
    rows = [(k, x, k % 2) for k, x in enumerate(vectors(4, 300, size=16))]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = vector_codes.op11_vector_codes(spark, str(tmp_path)).collect()
    wanted, text = brute(rows, 4, 256, 4)
    assert {r.codebooks_sha256 for r in found} == {hashlib.sha256(text.encode()).hexdigest()}
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr) == sorted(
        ((i, "".join(f"{c:02x}" for c in code), e, s) for i, code, e, s in wanted), key=repr)
