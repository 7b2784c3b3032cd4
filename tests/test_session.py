"""The shared folder and staged tables."""

import os
import threading

import pytest

from citymart import session


def test_staged_table_lives_in_the_configured_folder(spark):
    df = session.stage(spark.range(5).selectExpr("id", "cast(null as string) as s"), "five")
    assert f"{spark.conf.get('spark.checkpoint.dir')}/citymart-" in df.inputFiles()[0]
    assert df.count() == 5 and df.dtypes == [("id", "bigint"), ("s", "string")]


class Lookup(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeSession:
    """A session whose folder is not configured, on a given master."""

    def __init__(self, master):
        self.conf = Lookup()
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def getConf(self):
        return self.conf


def test_only_a_local_session_may_use_a_temporary_folder():
    local = FakeSession("local[2]")
    folder = session.shared_dir(local)
    assert os.path.isdir(folder) and session.shared_dir(local) == folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://host:7077"))


def test_runs_in_two_threads_keep_their_tables(spark):
    """Each run drops what it staged itself and nothing of the other."""
    opened = threading.Event()

    def first(_):
        with session.scratch(spark):
            table = session.stage(spark.range(3).toDF("v"), "first")
            opened.wait(60)
            return table.count()

    def second(_):
        with session.scratch(spark):
            session.stage(spark.range(5).toDF("v"), "second")
        opened.set()
        return 0

    found = session.side_by_side(spark, lambda f: f(None), [first, second], 2)
    assert found == [3, 0]


def test_work_side_by_side_stays_in_the_callers_scope(spark):
    with session.scratch(spark):
        here = session.staging_dir(spark)
        found = session.side_by_side(spark, lambda i: (i, session.staging_dir(spark)), [1, 2, 3], 2)
        assert found == [(i, here) for i in (1, 2, 3)]
    assert session.staging_dir(spark) != here and session.side_by_side(spark, print, [], 2) == []
