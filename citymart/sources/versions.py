"""Replacing a folder in two steps: written aside, then put in place by a rename.

A plain table is one folder. A versioned table keeps each of its contents in a folder of its own under
``_versions``, which Spark's readers pass over; the newest is the one with the largest number. Either way nothing
that is readable is touched before the new content is whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from citymart.sources.storage import Entry, entries, exists, filesystem

VERSIONS = "_versions"


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, where = filesystem(spark, source)
    if not fs.rename(where, filesystem(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def committed(spark: SparkSession, path: str) -> list[Entry]:
    """The versions of a table, oldest first; none for a plain one."""
    folder = f"{path}/{VERSIONS}"
    if not exists(spark, folder):
        return []
    return [e for e in entries(spark, folder) if e.is_dir and e.name.startswith("v")]


def _set_aside(spark: SparkSession, path: str) -> list[Entry]:
    """What a plain replacement moved away and did not delete."""
    parent, name = _split(path)
    if not exists(spark, parent):
        return []
    return [e for e in entries(spark, parent) if e.is_dir and e.name.startswith(f".{name}.old-")]


def current(spark: SparkSession, path: str) -> str:
    """The folder with the newest whole content of a table.

    A reader resolves this once, so it reads one version however long it takes. Between the two renames of a plain
    replacement, or after a crash there, the content that was moved away is the newest.
    """
    if found := committed(spark, path):
        return found[-1].path
    if not exists(spark, path) and (moved := _set_aside(spark, path)):
        return moved[-1].path
    return path


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(committed(spark, path))


@contextmanager
def replacing(spark: SparkSession, path: str, versioned: bool = False, keep: int = 1) -> Iterator[str]:
    """A folder to write to; at the end of the block it becomes the content of ``path``.

    An error in the block leaves the table as it was. ``versioned`` leaves ``keep`` earlier versions for readers that
    still use them, drops older ones, and does away with plain content that the table had before. Of two writers that end
    together both versions are whole and the one with the larger name counts.
    """
    parent, name = _split(path)
    key = uuid.uuid4().hex
    aside = f"{path}/{VERSIONS}/.new-{key}" if versioned else f"{parent}/.{name}.new-{key}"
    try:
        yield aside
        if versioned:
            _switch_version(spark, path, aside, keep)
        else:
            _switch_folder(spark, path, aside)
    except BaseException:
        _delete(spark, aside)
        raise


def _switch_version(spark: SparkSession, path: str, aside: str, keep: int) -> None:
    before = committed(spark, path)
    number = 1 + max((int(e.name[1:].partition("-")[0]) for e in before), default=0)
    _rename(spark, aside, f"{path}/{VERSIONS}/v{number:010d}-{uuid.uuid4().hex[:8]}")
    for old in before[: max(0, len(before) - keep)]:
        _delete(spark, old.path)
    for entry in entries(spark, path):
        if entry.name != VERSIONS:
            _delete(spark, entry.path)


def _switch_folder(spark: SparkSession, path: str, aside: str) -> None:
    parent, name = _split(path)
    left = _set_aside(spark, path)
    moved = None
    if exists(spark, path):
        moved = f"{parent}/.{name}.old-{uuid.uuid4().hex}"
        _rename(spark, path, moved)
    try:
        _rename(spark, aside, path)
    except BaseException:
        if moved:
            _rename(spark, moved, path)
        raise
    for old in [*(e.path for e in left), *([moved] if moved else [])]:
        _delete(spark, old)
