from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from barograph.llm import sharding
from barograph.llm.common import id_and_text
from tests.llm.fixtures import awkward, empty, prose


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=12), st.integers(1, 5))
def test_smallest_capacity_equals_brute_force(sizes, shards):
    @lru_cache(None)
    def best(i, k):
        if i == len(sizes):
            return 0
        if k == 0:
            return 10 ** 9
        return min(max(sum(sizes[i:j]), best(j, k - 1)) for j in range(i + 1, len(sizes) + 1))

    found = sharding.smallest_capacity(np.array(sizes), shards)
    assert found == best(0, shards)
    cuts = sharding.cuts_within(np.concatenate([[0], np.cumsum(sizes)]), shards, found)
    assert len(cuts) <= shards + 1 and all(sum(sizes[a:b]) <= found for a, b in zip(cuts, cuts[1:]))


def test_a_group_above_an_even_share_stands_alone():
    shard = sharding.minimax_shards(np.array([5, 5, 100, 5, 5]), 3)
    assert shard[2] == 0 and sorted(set(shard.tolist())) == [0, 1, 2]
    assert [int(np.sum(shard == k)) for k in (1, 2)] == [2, 2]


def test_shards_are_even_and_slots_gapless(spark):
    rows = [(100 + k, prose(k, 40 + k % 50)) for k in range(2000)] + [(5000 + k, "hot text") for k in range(900)]
    df = awkward(spark, rows).where("doc_id IS NULL OR doc_id <> 7")
    found = sharding.assign_shards(id_and_text(df), shards=6).toArrow().to_pandas()
    texts = {r.doc_id: r.text or "" for r in df.collect() if r.doc_id}
    assert len(found) == df.count() and set(found["shard"]) == set(range(6))
    load = found.groupby("shard")["size"].sum()
    assert load.max() <= 1.2 * load.mean()
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    of_text = found[found["doc_id"].notna()].groupby(found["doc_id"].map(texts))["shard"].nunique()
    assert of_text.max() == 1
    assert all(s == len(texts[int(d)].encode()) + 8 for d, s in zip(found["doc_id"], found["size"]) if d == d)


def test_empty_table_and_written_shards(spark, tmp_path):
    assert sharding.assign_shards(id_and_text(empty(spark))).count() == 0
    df = awkward(spark).where("doc_id IN (1, 2, 3)")
    sharding.write_shards(df, str(tmp_path / "shards"), shards=2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 3 and {"shard", "slot", "class"} <= set(back.columns)


def test_fewer_classes_than_shards(spark):
    for sizes in ([9], [5, 5], [100, 1, 1], [1] * 22):
        shard = sharding.minimax_shards(np.array(sizes), 24)
        assert len(set(shard.tolist())) == len(sizes) and shard.max() < 24
    one = spark.createDataFrame([(k, "copy") for k in range(50)], "doc_id bigint, text string")
    nulls = spark.createDataFrame([(k, None) for k in range(50)], "doc_id bigint, text string")
    for df in (one, nulls, one.unionByName(nulls)):
        found = sharding.assign_shards(df).toArrow().to_pandas()
        assert len(found) == df.count() and found["shard"].between(0, 23).all()
        for _, own in found.groupby("shard"):
            assert sorted(own["slot"]) == list(range(len(own)))


def test_written_shards_keep_null_and_repeated_ids(spark, tmp_path):
    df = awkward(spark, [(5, "another text"), (None, "alpha"), (None, None)])
    sharding.write_shards(df, str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, back.select(df.columns).collect())) == sorted(map(repr, df.collect()))
    assert back.select("shard", "slot").distinct().count() == df.count()
