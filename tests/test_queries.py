import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.check_queries import compare, connect
from workload import models

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, SMOKE, name) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_feature_list_follows_the_rows(spark, monkeypatch):
    gone = models.FEATURES_14[3]
    whole = models.clean
    monkeypatch.setattr(models, "clean", lambda *a: whole(*a).withColumn(gone, F.lit(None).cast("double")))
    found = models.feature_list_table(spark, SMOKE).orderBy("index").collect()
    assert [r.column for r in found] == [f"{c}_imputed" for c in models.FEATURES_14 if c != gone]
