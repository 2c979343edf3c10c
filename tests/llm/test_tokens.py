import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barograph.llm import packing, patched_frames as pf
from barograph.llm.common import id_and_text
from barograph.llm.token_ids import default_vocabulary, encoder
from tests.llm.fixtures import awkward, empty, prose

TOKENIZER = Tokenizer.from_file(default_vocabulary())
PIECES = st.sampled_from(["word", " ", "  ", "\n", ",", ".", "it's", "Été", "ß", "日本", "12", "\t", "\x1c", " ", "!", "İ",
                          "ª", "_", "'ll", "<|endoftext|>"])


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(PIECES, max_size=25).map("".join)))
def test_encoder_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder(default_vocabulary()).encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=1500), st.integers(0, 31))
def test_patched_frames_round_trip(values, shift):
    ids = np.array(values, np.uint64).astype(np.uint32) >> np.uint32(shift)
    segment = pf.Segment(pf.encode_segment(ids))
    assert segment.ids().tolist() == ids.tolist()
    if len(ids) > 600:
        assert segment.block(1).tolist() == ids[512:1024].tolist()


def test_outliers_are_patched_and_small():
    ids = np.full(5120, 7, np.uint32)
    ids[::300] = 50_000
    payload = pf.encode_segment(ids)
    assert pf.Segment(payload).ids().tolist() == ids.tolist() and len(payload) < 600


def test_token_files_in_id_order(spark, tmp_path):
    df = awkward(spark, [(100 + k, prose(k, 3000)) for k in range(60)])
    pf.write_token_files(id_and_text(df), str(tmp_path / "files"), default_vocabulary())
    found = pf.read_token_files(spark, str(tmp_path / "files")).collect()
    rows = sorted(((r.doc_id, r.text) for r in df.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, wanted = 0, []
    for doc_id, text in rows:
        ids = ids_of(text)
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == wanted


def test_several_ranges_keep_one_numbering(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pf, "range_bounds", lambda docs: [10, 30, 31, 70])
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(0, 90, 3)], "doc_id bigint, text string")
    pf.write_token_files(docs, str(tmp_path / "files"), default_vocabulary())
    found = sorted(map(tuple, pf.read_token_files(spark, str(tmp_path / "files")).collect()))
    assert [r[1] for r in found] == list(np.cumsum([0, *[r[2] for r in found]])[:-1])


def test_empty_table(spark, tmp_path):
    pf.write_token_files(id_and_text(empty(spark)), str(tmp_path / "files"), default_vocabulary())
    assert pf.read_token_files(spark, str(tmp_path / "files")).count() == 0
    assert packing.pack_documents(id_and_text(empty(spark)), default_vocabulary()).count() == 0


def check_packed(rows, texts, size):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc_id, own in pieces.items():
        ids, at = ids_of(texts[doc_id]), 0
        own.sort(key=lambda r: r.piece)
        copies = sum(r.piece == 0 for r in own)
        for r in own[::copies]:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and [r.piece for r in own[::copies]] == list(range(len(own) // copies))
        assert len(ids) > size or len(own) == copies
        assert all(r.length == size for r in own if r.piece)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) <= size
    return len(sequences), sum(r.length for r in rows)


def test_packing_is_gapless_and_tight(spark):
    df = awkward(spark, [(100 + k, prose(k, 10 + 37 * k % 900)) for k in range(300)])
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = packing.pack_documents(id_and_text(df), default_vocabulary()).collect()
    count, total = check_packed(rows, texts, 2048)
    assert count <= 1.03 * total / 2048 + 8


def test_bounded_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0) and bins.place(5) == (2, 0)  # 1, with 3 left, closes
    assert bins.place(3) == (0, 6) and bins.place(5) == (2, 5) and bins.place(1) == (0, 9)
    assert packing.piece_bounds(10, 4) == [0, 2, 6, 10] and packing.piece_bounds(8, 4) == [0, 4, 8]
    assert packing.piece_bounds(3, 4) == [0, 3]


def test_repeated_rows_without_ids_are_dealt_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(None, "the same text")] * 3_000, "doc_id bigint, text string")
        found = packing.pack_documents(df, default_vocabulary())
        tasks = found.selectExpr("sequence_id >> 36 AS task").groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 1_500


def test_strings_of_added_tokens_are_their_ids():
    for text in ("hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", "<|endoftext"):
        assert encoder(default_vocabulary()).encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert encoder(default_vocabulary()).encode("<|endoftext|>").tolist() == [50256]
