"""Tables that are replaced as a whole, on any store, without a rename.

Each version of a table is a folder of its own under the target. A numbered pointer, a file of one
line written once and never changed, names the folder of a version; the highest pointer that is
complete is the table. Readers see the former version until the pointer is there and the new one
after, and what a crash leaves behind is never read.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from itertools import islice
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTERS, VERSIONS = "_pointers", "_versions"


class Store(Protocol):
    """What publishing asks of a store: no renames, no locks, no overwriting."""

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False where there is one."""

    def read(self, path: str) -> str: ...

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none where there is no folder."""

    def delete(self, folder: str) -> None: ...


class SparkStore:
    """The file systems that Spark itself reads and writes."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):  # noqa: ANN202  a pair of Java objects
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def create(self, path: str, text: str) -> bool:
        fs, where = self._at(path)
        if fs.exists(where):
            return False
        try:
            out = fs.create(where, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        fs, where = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def delete(self, folder: str) -> None:
        fs, where = self._at(folder)
        fs.delete(where, True)


def fresh_version(target: str) -> str:
    """A folder for the next version; nothing reads it before it is published."""
    return posixpath.join(target.rstrip("/"), VERSIONS, uuid.uuid4().hex)


def _versions(store: Store, target: str) -> Iterator[str]:
    """Versions that complete pointers name, the newest first; older pointers are read on demand."""
    folder = posixpath.join(target.rstrip("/"), POINTERS)
    for name in sorted((n for n in store.names(folder) if n.isdigit()), reverse=True):
        text = store.read(posixpath.join(folder, name))
        if text.endswith("\n"):  # else its writer is at work, or crashed
            yield text.strip()


def publish(store: Store, version: str, target: str) -> int:
    """Make the folder version, written and checked, the table at target; returns its number.

    Publishers at the same time get different numbers, and the last one's table counts.
    """
    target = target.rstrip("/")
    name = posixpath.relpath(version, posixpath.join(target, VERSIONS))
    if name.startswith(".") or "/" in name:
        raise ValueError(f"{version} is no version of {target}")
    taken = [int(n) for n in store.names(posixpath.join(target, POINTERS)) if n.isdigit()]
    number = max(taken, default=0) + 1
    while not store.create(posixpath.join(target, POINTERS, f"{number:012d}"), f"{name}\n"):
        number += 1
    return number


def current_version(store: Store, target: str) -> str | None:
    """The folder of the published version, if there is one."""
    name = next(_versions(store, target), None)
    return None if name is None else posixpath.join(target.rstrip("/"), VERSIONS, name)


def read_published(spark: SparkSession, target: str, store: Store | None = None) -> DataFrame:
    """The published table; one that was never published is an error.

    The frame goes on reading the version it found, whatever is published meanwhile.
    """
    version = current_version(store or SparkStore(spark), target)
    if version is None:
        raise ValueError(f"nothing was published at {target}")
    return spark.read.parquet(version)


def remove_old(store: Store, target: str, *, keep: int = 2) -> int:
    """Delete versions that none of the last keep pointers names; returns how many went.

    Readers of a version that old must be done, and so must writers of versions not yet published.
    Pointers stay: they are a line each, and readers of the last one need no other.
    """
    held = set(islice(_versions(store, target), max(keep, 1)))
    folder = posixpath.join(target.rstrip("/"), VERSIONS)
    old = [n for n in store.names(folder) if n not in held]
    for name in old:
        store.delete(posixpath.join(folder, name))
    return len(old)
