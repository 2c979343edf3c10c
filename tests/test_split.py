import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barograph.operators.derive import CANDIDATES_BOOSTED, CANDIDATES_FOREST, CANDIDATES_LINEAR
from barograph.operators.split import (
    hash_split, random_split, sample_rows, split_parts, time_split, with_fold,
)
from barograph.session import clear_scratch, configure, scratch_path
from barograph.sources.tables import key_sample

DATA = "/root/testdata"


@pytest.mark.parametrize("scale, train", [("0.001", 671), ("0.01", 6955)])
def test_split_counts(spark, scale, train):
    events = spark.read.parquet(f"{DATA}/sf{scale}/events.parquet")
    parts = split_parts(hash_split(events, ["event_id"]))
    assert parts[0].count() == train
    assert parts[0].count() + parts[1].count() == events.count()


def test_split_does_not_depend_on_partitioning(spark):
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet").select("event_id", "ts")
    keys = ["event_id", "ts"]
    one = hash_split(events, keys).where("split = 'train'")
    other = hash_split(events.repartition(7), keys).where("split = 'train'")
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_splits_have_the_same_label_mean(spark):
    events = spark.read.parquet(f"{DATA}/sf0.01/events.parquet")
    means = {r["split"]: r["m"] for r in hash_split(events, ["event_id"]).groupBy("split").agg(
        F.avg("value").alias("m")).collect()}
    assert means["train"] == pytest.approx(means["test"], rel=0.1)


def test_folds_are_even_and_independent_of_the_split(spark):
    ids = spark.range(30_000).withColumnRenamed("id", "k")
    both = with_fold(hash_split(ids, ["k"]), ["k"], 3)
    counts = {(r["split"], r["fold"]): r["count"] for r in both.groupBy("split", "fold").count().collect()}
    for fold in range(3):
        assert counts["train", fold] == pytest.approx(7000, rel=0.05)
        assert counts["test", fold] == pytest.approx(3000, rel=0.08)


def test_weights_must_sum_up(spark):
    with pytest.raises(ValueError):
        hash_split(spark.range(1), ["id"], {"train": 70, "test": 20})


def test_null_keys_get_a_part(spark):
    df = spark.createDataFrame([(None, 1), ("a", None)], "a string, b int")
    assert hash_split(df, ["a", "b"]).where("split is null").count() == 0


def test_time_split_has_no_overlap(spark):
    df = spark.createDataFrame(
        [("2024-09-30 23:59:59",), ("2024-10-01 00:00:00",), (None,)], "t string").select(
        F.col("t").cast("timestamp"))
    found = [r["split"] for r in time_split(df, "t", "2024-10-01").orderBy(F.col("t").asc_nulls_last()).collect()]
    assert found == ["train", "test", None]


def test_random_split_and_samples(spark):
    ids = spark.range(10_000)
    train, test = random_split(ids)
    assert train.count() + test.count() == 10_000
    assert random_split(ids)[0].exceptAll(train).count() == 0
    assert sample_rows(ids, 0.1).count() == pytest.approx(1000, rel=0.15)
    assert sample_rows(ids, 0.01).count() == pytest.approx(100, rel=0.5)


def test_no_key_is_an_error(spark):
    df = spark.range(10)
    for use in (lambda: hash_split(df, []), lambda: with_fold(df, [], 3)):
        with pytest.raises(ValueError, match="key"):
            use()


def test_key_sample_is_the_same_for_every_partitioning(spark):
    df = spark.range(20_000)
    found = {r.id for r in key_sample(df, 2_000, ["id"], 20_000).collect()}
    assert found == {r.id for r in key_sample(df.repartition(7), 2_000, ["id"], 20_000).collect()}
    assert abs(len(found) - 2_000) < 200
    assert key_sample(df, 30_000, ["id"], 20_000).count() == 20_000


def test_configure_leaves_the_callers_settings(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    other.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert configure(other).conf.get("spark.sql.session.timeZone") == "America/New_York"
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_no_candidate_comes_from_the_label():
    for candidates in (CANDIDATES_FOREST, CANDIDATES_BOOSTED, CANDIDATES_LINEAR):
        assert not {"label", "TEMP_num", "RH_num", "dew_temp_diff"} & set(candidates)


def test_scratch_tables_are_deleted(spark):
    path = scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
