"""Replacing a table so that a whole one can be read at any time.

A new version of `base/name` is written to `base/_versions/name/<number>`. Its number is reserved by a marker that
only one writer can create. When the version is complete and checked, an empty file `_published-<number>` beside it
makes it the table: creating that file is the only step that counts, and it happens or does not. Readers take the
published version with the highest number, and `base/name` itself if that version is not there any more or none was
ever published. A writer that fails leaves the old table as it was.

After that the version settles: the old `base/name` goes and the version takes its place, so that other readers
find it under the table's own name. Where moving a folder means copying it, as in an object store, `settle=False`
leaves versions where they are; then the version before the newest is kept for those who still read it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

VERSIONS = "_versions"
PUBLISHED, RESERVED = "_published-", "_reserved-"


class Superseded(RuntimeError):
    """Another writer has published a later version meanwhile."""


class _Folder:
    """The file system's view of one table's versions."""

    def __init__(self, spark: SparkSession, table: str):
        self.jvm = spark.sparkContext._jvm
        base, _, name = table.rstrip("/").rpartition("/")
        self.table = table.rstrip("/")
        self.path = f"{base}/{VERSIONS}/{name}"
        self.fs = self.at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        return [status.getPath().getName() for status in self.fs.listStatus(self.at(path))] if self.exists(path) else []

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def create(self, name: str) -> bool:
        """Whether this call, and no other one, made the empty file."""
        return self.fs.createNewFile(self.at(f"{self.path}/{name}"))

    def move(self, source: str, target: str) -> bool:
        return self.fs.rename(self.at(source), self.at(target))

    def numbers(self, prefix: str) -> list[int]:
        return sorted(int(n[len(prefix) :]) for n in self.names(self.path) if n.startswith(prefix))

    def version(self, number: int) -> str:
        return f"{self.path}/{number}"


def current_path(spark: SparkSession, table: str) -> str:
    """The folder that holds the table now."""
    folder = _Folder(spark, table)
    published = folder.numbers(PUBLISHED)
    if published and folder.exists(folder.version(published[-1])):
        return folder.version(published[-1])
    return folder.table


def _reserve(folder: _Folder) -> int:
    number = max([0, *folder.numbers(RESERVED), *folder.numbers(PUBLISHED)]) + 1
    while not folder.create(f"{RESERVED}{number}"):
        number += 1
    return number


def _publish(folder: _Folder, number: int) -> None:
    later = [n for n in folder.numbers(PUBLISHED) if n > number]
    if later:
        raise Superseded(f"version {later[-1]} of {folder.table} was published before version {number}")
    folder.create(f"{PUBLISHED}{number}")


def _settle(folder: _Folder, number: int) -> None:
    """Move the published version to the table's own name. Whatever ends this half way, a later settling or
    replacement goes on from there, and readers are led by what is left."""
    folder.delete(folder.table)
    folder.move(folder.version(number), folder.table)


def _clear(folder: _Folder, number: int, kept: int) -> None:
    """Remove what came before version `number`, but for the `kept` published ones next to it."""
    before = [n for n in folder.numbers(PUBLISHED) if n < number]
    for old in [*before[: len(before) - kept], *(n for n in folder.numbers(RESERVED) if n < number and n not in before)]:
        folder.delete(folder.version(old))
        folder.delete(f"{folder.path}/{PUBLISHED}{old}")
        folder.delete(f"{folder.path}/{RESERVED}{old}")


@contextmanager
def replacing(spark: SparkSession, table: str, settle: bool = True) -> Iterator[str]:
    """Gives the folder to write the table's new version to, and publishes it when the block ends.

    When the block raises, the version is removed and the old table stays. Of two writers the one that started
    later wins; the other one's end raises `Superseded` if that has published already.
    """
    folder = _Folder(spark, table)
    number = _reserve(folder)
    try:
        yield folder.version(number)
        _publish(folder, number)
    except BaseException:
        folder.delete(folder.version(number))
        folder.delete(f"{folder.path}/{RESERVED}{number}")
        raise
    if settle:
        _settle(folder, number)
        _clear(folder, number, 0)
        return
    if folder.exists(folder.table):
        if any(n < number for n in folder.numbers(PUBLISHED)):
            folder.delete(folder.table)  # from before the first version; the one version kept for readers is newer
    _clear(folder, number, 1)
