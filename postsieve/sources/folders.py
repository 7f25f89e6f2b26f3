"""Folders on the store that Spark reads and writes: list, move and delete, names only."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, without hidden ones; none if it does not exist."""
    store, found = _store(spark, path)
    if not store.exists(found):
        return []
    names = [s.getPath().getName() for s in store.listStatus(found) if s.isDirectory()]
    return sorted(name for name in names if name[0] not in "._")


def exists(spark: SparkSession, path: str) -> bool:
    store, found = _store(spark, path)
    return store.exists(found)


def entry_names(spark: SparkSession, path: str) -> list[str]:
    """Names of all files and folders in ``path``; none if it does not exist."""
    store, found = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(found)) if store.exists(found) else []


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, which must not exist yet."""
    store, found = _store(spark, path)
    store.create(found, False).close()


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``, whose parent is made; what stood there is deleted."""
    store, old = _store(spark, source)
    _, new = _store(spark, target)
    store.delete(new, True)
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    store, found = _store(spark, path)
    store.delete(found, True)
