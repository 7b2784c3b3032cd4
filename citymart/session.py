"""Session settings and the shared folder that staged tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(name: str = "citymart", cores: str | int = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.appName(name)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder: on a cluster a machine-local path would be lost with the machine.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return _temporary_dir(spark.sparkContext.applicationId)


@cache
def _temporary_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"citymart-{application_id}-")


# Open scopes, outermost first; every thread has its own.
_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def staging_dir(spark: SparkSession) -> str:
    """One folder per application, so that all of its staged tables can be dropped together; inside
    ``scratch``, one per scope in it."""
    folder = f"{shared_dir(spark)}/citymart-{spark.sparkContext.applicationId}"
    return "/".join([folder, *_SCOPES.get()])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope whose staged tables are dropped at its end; nothing built on them may leave it. Runs in other threads
    have scopes of their own."""
    opened = _SCOPES.set((*_SCOPES.get(), f"run-{uuid.uuid4().hex}"))
    try:
        yield
    finally:
        clear_staged(spark)
        _SCOPES.reset(opened)


def side_by_side(spark: SparkSession, work: Callable, items: Sequence, most: int) -> list:
    """``work`` on every item, up to ``most`` at a time, in the scope and with the local properties of the caller:
    small jobs share the cluster instead of queueing for it. Results in the order of the items."""
    if not items:
        return []
    contexts = [copy_context() for _ in items]
    job = inheritable_thread_target(spark)(lambda context, item: context.run(work, item))
    with ThreadPoolExecutor(min(most, len(items))) as pool:
        return list(pool.map(job, contexts, items))


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Three things follow: the lineage is cut at storage, so a lost executor costs no recomputation;
    several consumers share one evaluation; and the optimizer knows the true size, so a later join
    broadcasts the table only when it is really below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles otherwise.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete the tables this application, or the open scope, staged; frames built on them stop working."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
