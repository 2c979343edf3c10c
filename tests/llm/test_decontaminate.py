import hashlib

from barograph.llm import decontaminate as dc
from barograph.llm.common import id_and_text
from tests.llm.fixtures import awkward, empty, prose, words_of


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words_of(text, dc.WORD)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text, dc.WORD), set(), set()
        for size in {len(g) for g in windows}:
            for i in range(len(w) - size + 1):
                if (g := tuple(w[i:i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[g]
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def found_rows(df):
    return [(r.doc_id, r.n_words, sum(s.stop - s.start for s in r["spans"]), r["items"]) for r in df.collect()]


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, words string")


def test_equals_brute_force_in_one_and_in_many_blocks(spark):
    items = [(i, prose(i, n, 60)) for i, n in enumerate((3, 10, 11, 25, 1, 40, 0))] + [(20, "Word7,x3"), (21, None)]
    docs = [(k, prose(100 + k, 80, 60)) for k in range(20)] + [
        (50, "start " + items[3][1].upper() + " end " + items[5][1]), (51, items[0][1]), (52, items[1][1] + "."),
        (53, " ".join(items[5][1].split()[5:17])), (54, items[3][1].replace(" ", "--"))]
    df = awkward(spark, docs)
    wanted = sorted(brute([(r.doc_id, r.text) for r in df.collect()], items), key=repr)
    for block in (200_000, 7):
        found = dc.find_windows(id_and_text(df), items_of(spark, items), block_windows=block)
        assert sorted(found_rows(found), key=repr) == wanted


def test_empty_tables(spark):
    assert dc.find_windows(id_and_text(empty(spark)), items_of(spark, [(1, "a b")])).count() == 0
    none = dc.find_windows(id_and_text(awkward(spark)), items_of(spark, [])).collect()
    assert len(none) == 10 and all(r["items"] == [] for r in none)


def test_clean_documents_keeps_columns_and_clean_rows(spark):
    df = awkward(spark)
    kept = dc.clean_documents(df, items_of(spark, [(1, "beta gamma")]))
    assert sorted(kept.columns) == sorted(df.columns)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 7, 8, 9]


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
