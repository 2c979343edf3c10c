import re

from pyspark.sql import functions as F

import corpus_pipeline as cp
from barograph.llm import decontaminate as dc
from barograph.llm import toxicity
from barograph.llm.common import id_and_text, row_key, stored
from barograph.llm.toxicity import toxicity_scores
from tests.llm.fixtures import awkward, empty, prose
from tests.llm.test_decontaminate import brute as hit_items
from tests.llm.test_jaccard_join import brute as near
from tests.llm.test_tokens import check_packed

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        kept[name] = stored(stage(spark, docs, SF), name)
        if name == "toxicity":
            scores = toxicity_scores(id_and_text(docs), spark.read.parquet(f"{SF}/labels.parquet"))
            toxic = {r.doc_id for r in scores.where("score >= 0.7").collect()}
            wanted = {r.doc_id for r in docs.collect()} - toxic
        elif name == "near_copies":
            wanted = {d for d, _, root in near([(r.doc_id, r.text) for r in docs.collect()], 5, 80) if d == root}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            wanted = {d for d, _, n, _ in hit_items([(r.doc_id, r.text) for r in docs.collect()], items) if n == 0}
        elif name == "secrets":
            secret = re.compile(r'(?<=token = ")[0-9a-f]{40}(?=")|(?<=password=)[0-9a-f]{18}|AKIA[A-Z0-9]{16}')
            masked = {r.doc_id: (r.text, r.n_chars) for r in kept[name].collect()}
            assert masked == {r.doc_id: (t := secret.sub("[SECRET]", r.text), len(t)) for r in docs.collect()}
            wanted = set(masked)
        else:
            texts = {r.doc_id: r.text for r in docs.collect()}
            count, total = check_packed(kept[name].collect(), texts, 2048)
            assert set(r.doc_id for r in kept[name].collect()) == set(texts) and count <= 1.1 * total / 2048 + 1
            break
        assert {r.doc_id for r in kept[name].collect()} == wanted
        assert kept[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = kept[name]


def test_stages_take_awkward_and_empty_tables(spark):
    for table in (awkward(spark), empty(spark)):
        docs = table
        for name, stage in cp.STAGES:
            found = stored(stage(spark, docs, SF), name)
            if name != "packing":
                assert sorted(found.columns) == sorted(table.columns)
                docs = found
    assert dc.WINDOW == 10


def test_rows_with_null_and_repeated_ids_are_decided_by_their_texts(spark, monkeypatch):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    unique, copied, other = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, unique), (1, copied), (1, copied), (2, copied + " end"), (3, item), (3, other), (None, item),
            (None, copied), (None, prose(4, 60)), (None, prose(4, 60)), (-5, copied + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = cp.near_copies(spark, docs, SF)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, unique), (-5, copied + " more"), (3, item), (3, other), (None, prose(4, 60))], key=repr)
    clean = cp.decontamination(spark, docs, SF)
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted([r for r in rows if r[1] != item], key=repr)
    scores = lambda docs, labels: docs.select("doc_id", "_row_key", (F.col("text") == item).cast("double").alias("score"))
    monkeypatch.setattr(toxicity, "toxicity_scores", scores)
    assert sorted(map(tuple, cp.toxicity(spark, docs, SF).collect()), key=repr) == sorted(map(tuple, clean.collect()), key=repr)


def test_row_keys_follow_the_order_of_ids(spark):
    ids = [-(1 << 63), -7, -1, 0, 5, 40, (1 << 63) - 1, None]
    docs = spark.createDataFrame([(i, "t") for i in ids], "doc_id bigint, text string")
    keys = [r.key for r in docs.select(row_key(docs).alias("key")).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(ids)
