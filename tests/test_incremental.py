import os
import time

import pytest

from barograph.plans import incremental
from barograph.plans.incremental import run_incremental_cleaning
from barograph.plans.resume import Stages
from barograph.sources.tables import read_table

HEADER = "STATION,DATE,TMP,DEW,SLP\n"


def put(folder, name, rows):
    """Observations (station, date, tenths of degrees) as one file."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(HEADER + "".join(f'{s},{d}T00:00:00,"{t:+05d},1","{t - 10:+05d},1","10132,1"\n' for s, d, t in rows))


def state(spark, path):
    return sorted((r.STATION, r.year, r.month, r.temperature) for r in read_table(spark, path).collect())


@pytest.fixture
def folders(tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "a.csv", [("A", "2024-01-05", 10), ("A", "2024-02-05", 20)])
    put(raw, "b.csv", [("B", "2024-01-06", 30), ("B", "2024-03-06", 40)])
    return raw, str(tmp_path / "clean"), str(tmp_path / "ledger")


def test_second_run_reads_no_file(spark, folders, monkeypatch):
    first = run_incremental_cleaning(spark, *folders)
    assert (first.files_new, first.months) == (2, 3)
    assert state(spark, folders[1]) == [("A", 2024, 1, 1.0), ("A", 2024, 2, 2.0), ("B", 2024, 1, 3.0), ("B", 2024, 3, 4.0)]

    def never(*args, **kwargs):
        raise AssertionError("a data file was read")

    monkeypatch.setattr(incremental, "read_raw", never)
    monkeypatch.setattr(incremental, "replace_partitions", never)
    assert run_incremental_cleaning(spark, *folders) == incremental.IncrementalReport(0, 0, 0, 0)


def test_a_new_file_touches_only_its_months(spark, folders, monkeypatch):
    raw, clean, _ = folders
    run_incremental_cleaning(spark, *folders)
    before = {m: sorted(os.listdir(f"{clean}/year=2024/month={m}")) for m in (1, 2, 3)}
    put(raw, "c.csv", [("C", "2024-02-07", 50), ("C", "2024-02-08", 5000)])
    read = []
    original = incremental.read_raw
    monkeypatch.setattr(incremental, "read_raw", lambda s, path, **k: read.append(path) or original(s, path, **k))
    found = run_incremental_cleaning(spark, *folders)
    assert (found.files_new, found.files_changed, found.months) == (1, 0, 1)
    assert [p.rsplit("/", 1)[1] for p in read[0]] == ["c.csv"]
    after = {m: sorted(os.listdir(f"{clean}/year=2024/month={m}")) for m in (1, 2, 3)}
    assert before[1] == after[1] and before[3] == after[3] and before[2] != after[2]
    assert [r for r in state(spark, clean) if r[2] == 2] == [("A", 2024, 2, 2.0), ("C", 2024, 2, 5.0)]


@pytest.mark.parametrize("listed", [10, 0])
def test_changed_and_removed_files(spark, folders, listed):
    raw, clean, ledger = folders
    run_incremental_cleaning(spark, *folders)
    time.sleep(1.1)
    put(raw, "a.csv", [("A", "2024-01-05", 11), ("A", "2024-04-05", 21)])
    os.remove(f"{raw}/b.csv")
    found = run_incremental_cleaning(spark, *folders, listed_files=listed)
    assert (found.files_new, found.files_changed, found.files_gone, found.months) == (0, 1, 1, 4)
    assert state(spark, clean) == [("A", 2024, 1, 1.1), ("A", 2024, 4, 2.1)]
    assert sorted(os.listdir(f"{clean}/year=2024")) == ["month=1", "month=4"]
    put(raw, "b.csv", [("B", "2024-04-06", 60)])
    assert run_incremental_cleaning(spark, *folders, listed_files=listed).files_new == 1
    assert state(spark, clean)[-1] == ("B", 2024, 4, 6.0)
    assert run_incremental_cleaning(spark, *folders).months == 0


def test_a_run_broken_off_before_the_ledger_is_repeated(spark, folders, monkeypatch):
    raw, clean, ledger = folders
    run_incremental_cleaning(spark, *folders)
    put(raw, "c.csv", [("C", "2024-01-09", 70)])
    ledgers = incremental.read_ledger
    calls = []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:  # the table is written, the ledger is not
            raise RuntimeError("lost")
        return ledgers(*args)

    monkeypatch.setattr(incremental, "read_ledger", breaks)
    with pytest.raises(RuntimeError):
        run_incremental_cleaning(spark, *folders)
    monkeypatch.setattr(incremental, "read_ledger", ledgers)
    assert run_incremental_cleaning(spark, *folders).files_new == 1
    assert [r[0] for r in state(spark, clean) if r[2] == 1] == ["A", "B", "C"]


def stages_job(spark, source, folder, factor=2, broken=False):
    stages = Stages(spark, "job", source, folder=folder)
    one = stages.table("read", lambda: spark.read.parquet(source))
    two = stages.table("scaled", lambda: one.selectExpr(f"id * {factor} AS id"), factor=factor)

    def third():
        if broken:
            raise RuntimeError("lost")
        return two.groupBy().sum("id")

    return stages, stages.table("total", third)


def test_a_rerun_starts_after_the_last_finished_stage(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(10).write.parquet(source)
    with pytest.raises(RuntimeError):
        stages_job(spark, source, folder, broken=True)
    stages, total = stages_job(spark, source, folder)
    assert stages.ran == ["total"] and total.first()[0] == 90
    assert stages_job(spark, source, folder)[0].ran == []
    other, total = stages_job(spark, source, folder, factor=3)
    assert other.ran == ["scaled", "total"] and total.first()[0] == 135
    spark.range(10, 11).write.mode("append").parquet(source)
    changed, total = stages_job(spark, source, folder)
    assert changed.ran == ["read", "scaled", "total"] and total.first()[0] == 110
    changed.clear()
    assert stages_job(spark, source, folder)[0].ran == ["read", "scaled", "total"]


def test_a_stage_without_its_commit_is_built_again(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(4).write.parquet(source)
    stages, _ = stages_job(spark, source, folder)
    os.remove(f"{stages.paths[1]}/_SUCCESS")
    assert stages_job(spark, source, folder)[0].ran == ["scaled"]
