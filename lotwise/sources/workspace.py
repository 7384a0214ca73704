"""Shared working folder: where intermediate tables go so that they outlive an executor.

On a cluster the folder is the one named by ``spark.checkpoint.dir``. Only a local session without that setting
gets a private temporary folder.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows that one task sorts or groups, where the number of partitions follows the table.
TASK_ROWS = 1_000_000

_local_folder: str | None = None
_made: list[str] = []
_inside: ContextVar[list[str] | None] = ContextVar("_inside", default=None)
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    on_context = spark.sparkContext.getCheckpointDir()
    if on_context:
        return on_context.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="lotwise-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    if (inside := _inside.get()) is not None:
        inside.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes the tables written inside it when it ends, but for those of ``stage`` that the given function is told to keep.

    For steps that need a table only until the next one is written. What other threads write meanwhile stays.
    """
    written, kept = [], set()
    token = _inside.set(written)

    def keep(table: DataFrame) -> DataFrame:
        kept.add(_paths[table])
        return table

    try:
        yield keep
    finally:
        _inside.reset(token)
        for path in set(written) - kept:
            _made.remove(path)
            delete(spark, path)
        if (outer := _inside.get()) is not None:
            outer.extend(kept)


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, a shuffle has a partition for every ``TASK_ROWS`` rows, or the session's number if that is larger.

    What one task sorts or groups then stays the same when tables grow. Adaptive execution still merges small partitions,
    up to 16 MB. For steps that write their result inside; a lazy one would run with the session's settings.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def layout(spark: SparkSession, label: str, sources: Sequence[str], write: Callable[[str], None]) -> str:
    """The folder of a table that ``write`` derives from the files at ``sources``: written by whoever asks first, then reused.

    The folder is named after the paths, sizes and times of those files, so new data make a new one. It appears when it is
    complete. ``release`` leaves it; it is dropped with the shared folder.
    """
    listing = sorted(line for source in sources for line in _files(spark, source))
    path = f"{shared_folder(spark)}/layout-{label}-{hashlib.sha256(repr(listing).encode()).hexdigest()[:24]}"
    if not names(spark, path):
        building = f"{path}-{uuid.uuid4().hex}"
        write(building)
        if not renamed(spark, building, path):
            delete(spark, building)  # another session was first
    return path


def _files(spark: SparkSession, source: str) -> list[str]:
    store, folder = _opened(spark, source)
    found, left = [], [folder]
    while left:
        for status in store.listStatus(left.pop()):
            if status.isDirectory():
                left.append(status.getPath())
            elif not status.getPath().getName().startswith(("_", ".")):
                found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return found


def renamed(spark: SparkSession, old: str, new: str) -> bool:
    """Gives a folder or file its final name, unless there is one of that name already."""
    store, source = _opened(spark, old)
    _, target = _opened(spark, new)
    return not store.exists(target) and store.rename(source, target)


def mark() -> int:
    """Remembers which tables are already written, for a ``release`` of what comes after."""
    return len(_made)


def release(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables this process wrote into the shared folder after ``since``, a ``mark``; call it when the results
    that read them are no longer needed. Tables of results made before the mark stay."""
    gone = 0
    while len(_made) > since:
        store, path = _opened(spark, _made.pop())
        gone += store.delete(path, True)
    return gone


def _opened(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, nothing if there is no such folder."""
    store, folder = _opened(spark, path)
    if not store.exists(folder):
        return []
    found = [status.getPath().getName() for status in store.listStatus(folder)]
    return [name for name in found if not name.startswith(("_", "."))]


def delete(spark: SparkSession, path: str) -> None:
    store, folder = _opened(spark, path)
    store.delete(folder, True)


def together(*builders: Callable[[], DataFrame]) -> list[DataFrame]:
    """Runs builders that write tables side by side, so that small jobs fill the cluster."""
    with ThreadPoolExecutor(len(builders)) as pool:
        return list(pool.map(lambda build: build(), builders))
