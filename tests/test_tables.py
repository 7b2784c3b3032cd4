"""Replacing tables: old rows after failures, one version for a reader, figures without a second read."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citymart.operators import validate
from citymart.plans import exploitation
from citymart.sources import files, tables, versions
from citymart.sources.schemas import EXPLOITATION
from citymart.sources.storage import entries, exists
from tests.test_pipelines import formatted, zones  # noqa: F401  (fixtures)

HOW = [{}, {"versioned": True}]


def frame(spark, rows, schema="v int, k string"):
    return spark.createDataFrame(rows, schema)


def content(spark, path):
    return sorted((r["v"], r["k"]) for r in tables.read_table(spark, path).collect())


def failing(df):
    return df.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))


def hidden(spark, folder):
    return [e.name for e in entries(spark, str(folder)) if e.name.startswith(".")]


@pytest.mark.parametrize("how", HOW)
@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, how, partition_by):
    path = str(tmp_path / "t")
    rows = [(1, "a"), (2, "b"), (3, None)]
    tables.write_table(frame(spark, rows), path, partition_by, **how)
    with pytest.raises(Exception, match="broken"):
        tables.write_table(failing(frame(spark, rows)), path, partition_by, **how)
    assert content(spark, path) == sorted(rows)
    assert hidden(spark, tmp_path) == []
    assert len(versions.committed(spark, path)) == len(how)


@pytest.mark.parametrize("how", HOW)
def test_a_failed_first_write_leaves_nothing(spark, tmp_path, how):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="broken"):
        tables.write_table(failing(frame(spark, [(2, "b")])), path, **how)
    with pytest.raises(PySparkException):
        tables.read_table(spark, path).collect()


@pytest.mark.parametrize("how", HOW)
def test_a_table_can_be_written_from_itself(spark, tmp_path, how):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a"), (2, "b")]), path, ["k"], **how)
    for _ in range(3):
        old = tables.read_table(spark, path)
        tables.write_table(old.withColumn("v", F.col("v") + 1).unionByName(old.filter("k = 'a'")), path, ["k"], **how)
    assert content(spark, path) == [(1, "a"), (2, "a"), (2, "a"), (2, "a"), (3, "a"), (3, "a"), (3, "a"), (4, "a"), (5, "b")]


def test_a_reader_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a")]), path, versioned=True)
    before = tables.read_table(spark, path)
    seen = []
    tables.write_table(frame(spark, [(2, "b")]), path, versioned=True, check=lambda new: seen.append(content(spark, path)))
    assert seen == [[(1, "a")]]  # until the new content is in place
    assert [r["v"] for r in before.collect()] == [1] and content(spark, path) == [(2, "b")]
    tables.write_table(frame(spark, [(3, "c")]), path, versioned=True)
    assert len(versions.committed(spark, path)) == 2
    tables.write_table(frame(spark, [(4, "d")]), path, versioned=True, keep=0)
    assert len(versions.committed(spark, path)) == 1 and content(spark, path) == [(4, "d")]


def test_a_check_stops_the_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a")]), path)

    def enough(new):
        if new.count() < 2:
            raise validate.GateError("too few rows")

    with pytest.raises(validate.GateError):
        tables.write_table(frame(spark, [(9, "z")]), path, check=enough)
    assert content(spark, path) == [(1, "a")]


def test_a_crash_between_the_renames_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a")]), path)

    class Crash(BaseException):
        pass

    real, done = versions._rename, []

    def rename(spark, source, target):
        if done:
            raise Crash
        done.append(target)
        real(spark, source, target)

    monkeypatch.setattr(versions, "_rename", rename)
    with pytest.raises(Crash):
        tables.write_table(frame(spark, [(2, "b")]), path)
    monkeypatch.undo()
    assert not exists(spark, path) and content(spark, path) == [(1, "a")]
    assert files.list_tables(spark, str(tmp_path)).collect() == []  # nothing half done is listed
    tables.write_table(frame(spark, [(3, "c")]), path)
    assert content(spark, path) == [(3, "c")] and hidden(spark, tmp_path) == []


def test_an_interrupted_rename_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a")]), path)
    real = versions._rename

    def rename(spark, source, target):
        if ".new-" in source:
            raise OSError("no rename")
        real(spark, source, target)

    monkeypatch.setattr(versions, "_rename", rename)
    with pytest.raises(OSError):
        tables.write_table(frame(spark, [(2, "b")]), path)
    assert spark.read.parquet(path).count() == 1 and hidden(spark, tmp_path) == []


def test_a_plain_table_becomes_a_versioned_one(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(1, "a")]), path, ["k"])
    tables.write_table(frame(spark, [(2, "b")]), path, ["k"], versioned=True)
    assert content(spark, path) == [(2, "b")]
    assert [e.name for e in entries(spark, path)] == ["_versions"]
    assert [r["file_count"] for r in files.table_file_counts(spark, str(tmp_path)).collect()] == [1]
    inventory = files.zone_inventory(spark, {"z": str(tmp_path)}).first()
    assert (inventory["file_count"], inventory["dir_count"]) == (2, 2) and inventory["latest_modification"] is not None


def test_versions_beyond_nine_sort_by_number(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(12):
        tables.write_table(frame(spark, [(i, "a")]), path, versioned=True)
    assert content(spark, path) == [(11, "a")]


@pytest.mark.parametrize("how", HOW)
def test_empty_table_and_figures(spark, tmp_path, how):
    df = frame(spark, [], "v int, k string")
    figures = tables.write_table(df, str(tmp_path / "t"), ["k"], figures=validate.status_figures(df), **how)
    assert figures == {"record_count": 0, "null_count": 0}
    df = frame(spark, [(1, "a"), (None, None), (3, "")])
    figures = tables.write_table(df, str(tmp_path / "u"), ["k"], figures=validate.status_figures(df), **how)
    assert figures == {"record_count": 3, "null_count": 2}


def test_status_of_a_run_needs_no_second_read(spark, zones, formatted, tmp_path):  # noqa: F811
    zone, tracker = str(tmp_path / "e"), spark.sparkContext.statusTracker()
    read, real = [], validate.read_table
    validate.read_table = lambda *a, **k: read.append(a) or real(*a, **k)
    try:
        status = exploitation.run_exploitation(spark, zones["formatted"], zone)
        assert read == []
        spark.sparkContext.setJobGroup("status", "status")
        written = sorted(map(tuple, status.collect()), key=repr)
        assert len(tracker.getJobIdsForGroup("status")) <= 1  # the rows are local
    finally:
        validate.read_table = real
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    again = validate.validate_zone(spark, "exploitation", zone, list(EXPLOITATION), nulls=False)
    assert written == sorted(map(tuple, again.collect()), key=repr)


def test_status_of_formatting_equals_a_second_read(spark, zones, formatted):  # noqa: F811
    again = validate.validate_zone(spark, "formatted", zones["formatted"], ["idealista", "income", "cultural_sites"])
    assert sorted(map(tuple, formatted.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
