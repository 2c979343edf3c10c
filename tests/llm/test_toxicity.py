from barograph.llm import toxicity as tx
from barograph.llm.common import id_and_text
from tests.llm.fixtures import awkward, empty, prose


def test_features_of_awkward_texts():
    weights = tx.Weights({"idiot": 5.0, "stup-": 4.0, "stupi-": 4.5})
    name = lambda text: dict(zip(tx.FEATURES, tx.describe(text, weights)))
    assert set(name(None).values()) == set(name("").values()) == {0.0}
    found = name("You are an idiot!!! STUPIDO 1d10t i-d-i-o-t id.iot")
    assert found["strongest"] == 5.0 and found["near_second_person"] > 0 and found["exclamations"] > 0
    assert found["obfuscated_hits"] >= 1 and found["capital_words"] > 0 and found["density"] > 0
    assert name(prose(1, 100_000))["hits"] == 0.0


def labelled(spark, n=900):
    rows = [(k, prose(k, 60) + (" you pathetic idiot" if k % 4 == 0 else "") + prose(k + 1, 20)) for k in range(100, 100 + n)]
    df = awkward(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0), "z") for k in range(100, 100 + n) if k % 3] + [(None, 1, "z"), (101, None, "z")],
                                   "doc_id bigint, toxic int, text string")
    return df, labels


def test_held_out_rows_and_filter(spark):
    df, labels = labelled(spark)
    scores = tx.toxicity_scores(id_and_text(df), labels).collect()
    assert len(scores) == df.count() and all(0 <= r.score <= 1 for r in scores)
    held = [(r.score >= 0.7) == (r.doc_id % 4 == 0) for r in scores if r.doc_id and r.doc_id >= 100 and r.doc_id % 3 == 0]
    assert sum(held) >= 0.97 * len(held)
    assert all(r.score < 0.7 for r in scores if r.doc_id in (2, 3, 4, None))
    kept = tx.reject_toxic(df, labels)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert None in ids and ids.count(5) == 2
    assert sum(1 for i in ids if i and i >= 100 and i % 4 == 0) <= 3 and sum(1 for i in ids if i and i >= 100 and i % 4) > 650


def test_without_labels_all_scores_are_zero(spark):
    df, labels = labelled(spark, 40)
    for few in (labels.where("doc_id < 0"), labels.where("toxic = 1")):
        assert {r.score for r in tx.toxicity_scores(id_and_text(df), few).collect()} == {0.0}
    assert tx.toxicity_scores(id_and_text(empty(spark)), labels).count() == 0


def test_held_out_accuracy_on_given_tables(spark):
    found = tx.op2_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)
