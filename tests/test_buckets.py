import uuid

import pytest
from pyspark.sql import functions as F

from barograph.operators.history import HISTORY_COLUMNS, attach_history, history_features, hourly_series
from barograph.sources.buckets import Buckets, joins_by_bucket, largest_bucket, open_bucketed, write_bucketed


def attached(rows):
    hourly = hourly_series(rows, "STATION", "timestamp", ["temperature", "sea_level_pressure"])
    return attach_history(rows, history_features(hourly)).select("id", *HISTORY_COLUMNS)


@pytest.fixture
def rows(spark):
    return spark.range(4_000).select(
        "id", F.concat(F.lit("S"), F.col("id") % 37).alias("STATION"), F.timestamp_seconds(F.lit(1.7e9) + F.col("id") * 97).alias("timestamp"),
        (F.col("id") % 50).cast("double").alias("temperature"), (F.col("id") % 20 + 1000).cast("double").alias("sea_level_pressure"))


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")
    spark.sql(f"DROP TABLE IF EXISTS {made}_again")


def test_history_of_a_bucketed_table_needs_no_shuffle(spark, rows, name, tmp_path):
    layout = Buckets("STATION", 4, ("timestamp",))
    table = write_bucketed(rows, str(tmp_path / "t"), name, layout)
    again = open_bucketed(spark, str(tmp_path / "t"), f"{name}_again", layout)
    wanted = sorted(map(tuple, attached(rows).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for source in (table, again):
            with joins_by_bucket(spark):
                found = attached(source)
                plan = found._jdf.queryExecution().executedPlan().toString()
                assert "Exchange" not in plan and "SortMergeJoin" in plan
                assert sorted(map(tuple, found.collect())) == wanted
        assert "Exchange" in attached(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_a_hot_key_is_refused(spark, rows, name, tmp_path):
    layout = Buckets("STATION", 16)
    hot = rows.withColumn("STATION", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("STATION")))
    assert largest_bucket(hot, layout) > 4 and largest_bucket(rows.limit(0), layout) == 0
    with pytest.raises(ValueError):
        write_bucketed(hot, str(tmp_path / "t"), name, layout)
