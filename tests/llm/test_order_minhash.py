import hashlib

from barograph.llm import order_minhash as om
from barograph.llm.common import id_and_text
from tests.llm.fixtures import awkward, empty, prose


def test_next_documents_and_edits_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(om, "range_bounds", lambda docs: [3, 8, 120, 140])
    df = awkward(spark, [(100 + k, prose(k, 5 + 7 * k)) for k in range(60)])
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    wanted = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        changed = om.edited(text, following)
        own, other = om.sketch(text), om.sketch(changed)
        wanted.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(),
                       other.tobytes().hex(), om.likeness(own, other), om.likeness(own, om.sketch(following))))
    found = om.fingerprints(id_and_text(df)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_edit_counts_code_points():
    assert om.edited("ÄÖÜabc", "\U0001f600é9") == "ÄÖÜa\U0001f600é"
    assert om.edited("abcdef", "z") == "abcdz" and om.edited("ab", "xyz") == "ab" and om.edited("", "x") == ""


def test_order_of_text_matters_and_equal_texts_agree():
    text = prose(1, 400)
    half = len(text) // 2
    moved = text[half:] + text[:half]
    edited = om.edited(text, prose(2, 400))
    assert om.likeness(om.sketch(text), om.sketch(text)) == 1.0
    assert om.likeness(om.sketch(text), om.sketch(prose(3, 400))) < 0.1 < om.likeness(om.sketch(text), om.sketch(edited))
    assert om.likeness(om.sketch(text), om.sketch(moved)) < 0.9
    assert om.likeness(om.sketch(""), om.sketch("")) == 1.0 and om.likeness(om.sketch(""), om.sketch("a")) == 0.0


def test_selection_equals_brute_force():
    """Each sketch takes the smallest occurrence-numbered k-mers from its start on, kept in text order."""
    text = "abcabcabdabcabc" * 9 + "xyz" * 20
    import numpy as np

    from barograph.llm import textbytes as tb
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    values = tb.mixed(codes.astype(np.uint64) + om._SALT)
    up, down = tb.powers(len(codes) + 1)
    kmers = [int(tb.mixed(np.array([sum(int(values[i + j]) * int(up[i + j]) for j in range(om.K)) * int(down[i])
                                    % (1 << 64)], np.uint64))[0]) for i in range(len(codes) - om.K + 1)]
    bits, count, seen, keys = len(bin(len(kmers))) - 2, len(kmers), {}, []
    for i, kmer in enumerate(kmers):
        group = kmer >> bits
        number = seen[group] = seen.get(group, -1) + 1
        value = kmer if number == 0 else int(tb.mixed(np.array(
            [(kmer + number * int(om._SALT)) % (1 << 64)], np.uint64))[0])
        keys.append(((value >> bits) << bits | i, i))
    keys.sort()
    sketch = om.sketch(text)
    for s, start in enumerate(om._STARTS.tolist()):
        at = next((k for k, (value, _) in enumerate(keys) if value >= start), count)
        a, b = sorted(keys[(at + j) % count][1] for j in range(2))
        total = int(tb.mixed(np.array([(kmers[a] * int(om._SALT) + kmers[b]) % (1 << 64)], np.uint64))[0])
        assert sketch[s] == total >> 32


def test_empty_and_single_row_tables(spark):
    assert om.fingerprints(id_and_text(empty(spark))).count() == 0
    row = om.fingerprints(id_and_text(awkward(spark).where("doc_id = 1"))).first()
    assert row.near_next == 1.0 and row.n_chars == 30


def test_likeness_does_not_break_at_a_length():
    text = prose(5, 60)
    for n in range(30, 110):
        assert om.likeness(om.sketch(text[:n]), om.sketch(text[:n + 1])) > 0.5
    assert om.likeness(om.sketch(text[:75]), om.sketch(om.edited(text[:75], "x"))) > 0.3
