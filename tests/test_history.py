import random

from pyspark.sql import functions as F

from barograph.operators.history import (
    HISTORY_COLUMNS, apply_station_stats, attach_history, fit_station_stats, history_features,
    hourly_series,
)

BASE = 1_704_067_200


def observations(spark, seed=3, hot=False):
    rng = random.Random(seed)
    rows = []
    for station in ("A", "B", "C"):
        for hour in range(60):
            if rng.random() < 0.3:
                continue
            for _ in range(40 if hot and station == "A" else rng.randrange(1, 3)):
                rows.append((station, BASE + 3600 * hour + rng.randrange(3600),
                             round(rng.uniform(-20, 30), 1),
                             round(rng.uniform(990, 1030), 1) if rng.random() < 0.8 else None))
    df = spark.createDataFrame(rows, "STATION string, s long, temperature double, sea_level_pressure double")
    return rows, df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def brute_force(rows):
    def mean(values):
        values = [v for v in values if v is not None]
        return sum(values) / len(values) if values else None

    groups = {}
    for station, second, temperature, pressure in rows:
        groups.setdefault((station, second // 3600), []).append((temperature, pressure))
    series = {k: (mean(t for t, _ in v), mean(p for _, p in v)) for k, v in groups.items()}
    found = {}
    for station, hour in series:
        past = [series.get((station, hour - k), (None, None)) for k in (1, 2, 3)]
        lags = [t for t, _ in past]
        change = lags[0] - lags[1] if None not in lags[:2] else None
        found[station, hour] = (*lags, past[0][1], mean(lags), change)
    return found


def rounded(values):
    return tuple(None if v is None else round(v, 6) for v in values)


def test_history_equals_brute_force(spark):
    for hot in (False, True):
        rows, df = observations(spark, hot=hot)
        hourly = hourly_series(df, "STATION", "timestamp", ["temperature", "sea_level_pressure"])
        expected = brute_force(rows)
        found = {(r["STATION"], r["hour_epoch"] // 3600): rounded(r[c] for c in HISTORY_COLUMNS)
                 for r in history_features(hourly).collect()}
        assert found == {k: rounded(v) for k, v in expected.items()}


def test_every_observation_gets_its_hour(spark):
    rows, df = observations(spark)
    features = history_features(
        hourly_series(df, "STATION", "timestamp", ["temperature", "sea_level_pressure"]))
    attached = attach_history(df, features)
    assert attached.count() == len(rows)
    expected = brute_force(rows)
    for r in attached.withColumn("h", F.unix_seconds("timestamp")).collect():
        assert rounded(r[c] for c in HISTORY_COLUMNS) == rounded(expected[r["STATION"], r["h"] // 3600])


def test_features_do_not_read_the_current_label(spark):
    _, df = observations(spark)
    last = df.agg(F.max("timestamp")).first()[0]
    changed = df.withColumn("temperature", F.when(F.col("timestamp") == last, 999.0).otherwise(F.col("temperature")))

    def features(table):
        return history_features(hourly_series(
            table, "STATION", "timestamp", ["temperature", "sea_level_pressure"])).select(
            "STATION", "hour_epoch", *HISTORY_COLUMNS)

    assert features(df).exceptAll(features(changed)).count() == 0


def test_one_window_for_all_features(spark):
    _, df = observations(spark)
    hourly = hourly_series(df, "STATION", "timestamp", ["temperature", "sea_level_pressure"])
    plan = history_features(hourly)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" +-:").startswith("Window ") for line in plan.split("\n")) == 1


def test_station_stats_come_from_train_only(spark):
    schema = "STATION string, temperature double, dew_point double, sea_level_pressure double"
    train = spark.createDataFrame([("A", 1.0, 0.0, None), ("A", 3.0, 2.0, 1000.0)], schema)
    test = spark.createDataFrame([("A", 50.0, 1.0, 1.0), ("B", 7.0, 1.0, 1.0)], schema)
    stats = fit_station_stats(train)
    names = ("station_avg_temp", "station_avg_dew", "station_avg_pressure")
    for limit in (0, 1, 10):
        found = {r["STATION"]: tuple(r[n] for n in names)
                 for r in apply_station_stats(test, stats, broadcast_rows=limit).collect()}
        assert found == {"A": (2.0, 1.0, 1000.0), "B": (None, None, None)}
