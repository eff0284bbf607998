"""Folders as Hadoop's file systems see them: replaced as a whole, marked when complete, removed when done with.

Paths may be of any store that Spark writes to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: A file that is written last of all: a folder without it is not complete.
MARK = "_COMMITTED"


def _opened(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it names it."""
    jvm = spark.sparkContext._jvm
    named = jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), named


def _beside(path: str, what: str) -> str:
    """A name next to ``path`` that readers of the folder around it pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{what}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    store, named = _opened(spark, path)
    return store.exists(named)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all that is in it; one that is not there is no error."""
    store, named = _opened(spark, path)
    store.delete(named, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    store, named = _opened(spark, old)
    if not store.rename(named, _opened(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def replace(spark: SparkSession, path: str, write: Callable[[str], None],
            mark: str | Callable[[], str] | None = None) -> None:
    """Let ``write`` fill a folder beside ``path``, then put that in the place of ``path``.

    What ``path`` holds stays until then, so it can be read while its successor is written,
    and a write that fails leaves it as it was. With ``mark`` a file of that text is added
    when all else is in place; a function is asked for it then.
    """
    path = path.rstrip("/")
    aside, before = _beside(path, "new"), _beside(path, "old")
    try:
        write(aside)
    except BaseException:
        remove(spark, aside)
        raise
    had = exists(spark, path)
    if had:
        _rename(spark, path, before)
    _rename(spark, aside, path)
    if mark is not None:
        store, named = _opened(spark, f"{path}/{MARK}")
        stream = store.create(named, True)
        stream.write(bytearray((mark() if callable(mark) else mark).encode()))
        stream.close()
    if had:
        remove(spark, before)


def mark_of(spark: SparkSession, path: str) -> str | None:
    """The text of the folder's mark; None if it is not complete or not there."""
    store, named = _opened(spark, f"{path.rstrip('/')}/{MARK}")
    if not store.exists(named):
        return None
    stream = store.open(named)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it is not there."""
    store, named = _opened(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(named)) if store.exists(named) else []
