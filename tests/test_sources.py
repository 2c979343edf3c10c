import gzip
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barograph.operators.features import feature_list
from barograph.session import materialize, persisted, scratch_path, spread
from barograph.sources.raw import file_headers, read_raw
from barograph.sources.tables import (
    read_partition, read_result, read_table, replace_partitions, write_bounded, write_partitioned,
    write_result, write_sample,
)


ROOT = Path(__file__).resolve().parents[1]


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)


def scans(df):
    """File scans of the rows and of the table of headers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan text") + plan.count("Scan ExistingRDD")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_one_header_reads_the_folder(spark, tmp_path):
    put(tmp_path, "a.csv", '"STATION","TMP"\n"1","+0010,1"\n')
    put(tmp_path, "b.csv", '"STATION","TMP"\n"2","+0020,1"\n')
    put(tmp_path, "notes.txt", "nothing\n")
    df = read_raw(spark, str(tmp_path))
    assert dict(df.dtypes) == {"STATION": "string", "TMP": "string"}
    assert rows(df, "STATION", "TMP") == [("1", "+0010,1"), ("2", "+0020,1")]


def test_files_with_different_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP\n1,x\n")
    put(tmp_path, "b.csv", "STATION,AA1,TMP\n2,rain,y\n")
    put(tmp_path, "with space.csv", "TMP,STATION\r\nz,3\r\n")
    put(tmp_path, "empty.csv", "")
    df = read_raw(spark, str(tmp_path))
    assert rows(df, "STATION", "TMP", "AA1") == [
        ("1", "x", None), ("2", "y", "rain"), ("3", "z", None)]


def test_compressed_file(spark, tmp_path):
    put(tmp_path, "a.csv.gz", "STATION,TMP\n1,x\n")
    assert rows(read_raw(spark, str(tmp_path), glob="*.csv.gz"), "STATION", "TMP") == [("1", "x")]


def test_wanted_columns(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP,Q1\n1,x,p\n")
    put(tmp_path, "b.csv", "STATION,TMP,Q2,Q3\n2,y,p,q\n")
    df = read_raw(spark, str(tmp_path), columns=["STATION", "TMP", "CIG"])
    assert df.columns == ["STATION", "TMP"]
    assert rows(df, "STATION", "TMP") == [("1", "x"), ("2", "y")]
    assert scans(df) == 2


def test_wanted_columns_with_dropping(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP,Q1\n1,x,p\n9,x\n")
    put(tmp_path, "b.csv", "STATION,TMP,Q2\n2,y,p\n8,y,p,q\n")
    df = read_raw(spark, str(tmp_path), malformed="drop", columns=["STATION", "TMP"])
    assert rows(df, "STATION", "TMP") == [("1", "x"), ("2", "y")]
    assert scans(df) == 2


def test_file_with_a_blank_first_line_keeps_its_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP\n1,x\n")
    put(tmp_path, "b[1].csv", "\n  \nSTATION,TMP\n2,y\n\n")
    put(tmp_path, "blank.csv", "\n\n")
    assert rows(read_raw(spark, str(tmp_path)), "STATION", "TMP") == [("1", "x"), ("2", "y")]
    put(tmp_path, "c.csv", "STATION,CIG,TMP\n3,c,z\n")
    df = read_raw(spark, str(tmp_path))
    assert rows(df, "STATION", "TMP", "CIG") == [("1", "x", None), ("2", "y", None), ("3", "z", "c")]


@pytest.mark.parametrize("malformed", ["keep", "drop"])
def test_number_of_scans_does_not_depend_on_headers(spark, tmp_path, malformed):
    for i in range(35):
        put(tmp_path, f"f{i:02}.csv", f"STATION,{''.join(f'Q{j},' for j in range(i))}TMP\n{i},{'q,' * i}t{i}\n{i},short\n")
    df = read_raw(spark, str(tmp_path), malformed=malformed)
    whole = [row for row in rows(df, "STATION", "TMP") if row[1] and row[1] != "short"]
    assert whole == sorted((str(i), f"t{i}") for i in range(35))
    assert df.count() == (70 if malformed == "keep" else 36) and scans(df) == 2


def test_given_header_needs_one_scan(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP\n1,x\n")
    put(tmp_path, "b.csv", "STATION,TMP\n2,y\n")
    df = read_raw(spark, str(tmp_path), header="STATION,TMP")
    assert rows(df, "STATION", "TMP") == [("1", "x"), ("2", "y")] and scans(df) == 1


def test_quoted_values_and_byte_order_mark(spark, tmp_path):
    put(tmp_path, "a.csv", "\ufeffSTATION,TMP\n1,\"a,b\"\n2,\n")
    put(tmp_path, "b.csv", "TMP,STATION,X\n\"c,d\",3,\n")
    assert rows(read_raw(spark, str(tmp_path), malformed="drop"), "STATION", "TMP") == [
        ("1", "a,b"), ("2", None), ("3", "c,d")]


def test_malformed_rows_drop_whatever_is_selected(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,DATE,TMP\n1,d,x\n2,d\n3,d,y,z\n4,d,w\n")
    df = read_raw(spark, str(tmp_path), malformed="drop")
    assert rows(df, "STATION") == [("1",), ("4",)] and df.count() == 2
    assert read_raw(spark, str(tmp_path)).count() == 4
    with pytest.raises(ValueError):
        read_raw(spark, str(tmp_path), malformed="maybe")


def test_workers_need_no_package(tmp_path):
    """The tasks of ``read_raw`` run where only Spark is installed."""
    put(tmp_path, "raw/a.csv", "STATION,TMP\n1,x\n")
    script = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from barograph.sources.raw import read_raw\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', read_raw(spark, {str(tmp_path / 'raw')!r}).count())\n")
    environment = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK_", "SPARK_"))}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True,
        timeout=120)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


def test_header_names_are_made_unique(spark, tmp_path):
    put(tmp_path, "a.csv", "X,,X\n1,2,3\n")
    assert read_raw(spark, str(tmp_path)).columns == ["X0", "_c1", "X2"]


def test_no_file(spark, tmp_path):
    put(tmp_path, "a.txt", "X\n")
    with pytest.raises(ValueError):
        read_raw(spark, str(tmp_path))


def months(spark, n=240):
    return spark.range(n).select(
        "id", F.lit(2024).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))


def test_partitioned_write_prunes_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(spark)
    write_partitioned(df, path)
    write_partitioned(df, path)
    assert read_table(spark, path).count() == 240
    one = read_partition(spark, path, year=2024, month=3)
    assert one.count() == 20
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()
    changed = df.where("month = 3").withColumn("id", F.col("id") + 1000)
    for _ in range(2):
        replace_partitions(changed, path)
    table = read_table(spark, path)
    assert table.count() == 240 and table.where("month = 3").agg(F.min("id")).first()[0] >= 1000


def test_small_partitions_get_one_file_each(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(months(spark).repartition(8), path)
    for month in range(1, 13):
        names = os.listdir(f"{path}/year=2024/month={month}")
        assert sum(name.endswith(".parquet") for name in names) == 1


def test_a_hot_partition_is_split(spark, tmp_path):
    hot = spark.range(200_000).select(
        F.hash("id").alias("x"), F.lit(2024).alias("year"),
        F.when(F.col("id") % 20 == 0, (F.col("id") % 12 + 1)).otherwise(5).cast("int").alias("month"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "128KB")
    try:
        write_partitioned(hot.repartition(16), str(tmp_path / "t"))
    finally:
        spark.conf.set(name, before)

    def files(month):
        names = os.listdir(f"{tmp_path}/t/year=2024/month={month}")
        return sum(n.endswith(".parquet") for n in names)

    assert files(5) > 4 and files(1) == 1
    assert read_table(spark, str(tmp_path / "t")).count() == 200_000


def test_listing_reads_no_content(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP\n1,x\n")
    plan = file_headers(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_files_without_a_header_are_listed(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,TMP\n1,x\n")
    put(tmp_path, "b.csv", "\n  \n")
    put(tmp_path, "c.csv", "\n \nTMP,STATION\ny,2\n")
    found = {r.path.rsplit("/", 1)[1]: r.header for r in file_headers(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": "STATION,TMP", "b.csv": None, "c.csv": "TMP,STATION"}
    assert rows(read_raw(spark, str(tmp_path)), "STATION", "TMP") == [("1", "x"), ("2", "y")]


def test_bounded_write(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bounded(months(spark).repartition(8), path, files=2)
    assert sum(name.endswith(".parquet") for name in os.listdir(path)) == 2


def test_result_tables(spark, tmp_path):
    path = str(tmp_path / "r")
    assert read_result(spark, path) is None
    write_result(feature_list(spark.range(1), ["a_imp", "b_imp"]), path)
    found = read_result(spark, path)
    assert dict(found.dtypes) == {"index": "int", "column": "string"}
    assert rows(found, "index", "column") == [(0, "a_imp"), (1, "b_imp")]
    with pytest.raises(Exception, match="nosuchscheme"):
        read_result(spark, "nosuchscheme://host/table")


def test_sample_sink(spark, tmp_path):
    write_sample(months(spark), str(tmp_path / "p"), 10, order_by=["id"])
    assert rows(read_table(spark, str(tmp_path / "p")), "id") == sorted([(i,) for i in range(10)], key=str)
    write_sample(months(spark), str(tmp_path / "c"), 7, order_by=["id"], kind="csv")
    assert read_result(spark, str(tmp_path / "c")).count() == 7


def test_execution_controls(spark):
    df = spark.range(10)
    with persisted(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
    assert spread(df, 3).rdd.getNumPartitions() == 3
    assert spread(df, None) is df
    assert materialize(df).count() == 10
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
