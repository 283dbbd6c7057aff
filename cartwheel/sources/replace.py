"""Replacing stored tables so that a failing write leaves the old one in place.

The new rows are written beside the table, under a hidden name. Only when that has
succeeded do they take the table's place, by renames: where a folder can be renamed in one
step, as on HDFS, a reader of a whole table finds the old or the new one. What a swap
replaces is moved aside first and deleted last: a swap that fails is undone, and one that is
interrupted is undone by the next writer of any kind. Months are moved one by one, so a
reader may meet some of them half way; :mod:`cartwheel.sources.versions` has no such moment.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_CREATING = threading.Lock()


class InterruptedSwap(RuntimeError):
    """A replace of this table stopped half way, or is under way."""


class Folders:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        self._files.mkdirs(self._path(new).getParent())
        if not self._files.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {old} to {new}")

    def names(self, path: str) -> list[str]:
        """The folders directly below a folder; none if it is not there."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._path(path))
                      if s.isDirectory())

    def file_names(self, path: str) -> list[str]:
        """The files directly below a folder; none if it is not there."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._path(path)) if s.isFile())

    def data_files(self, path: str) -> dict[str, int]:
        """Sizes of the files at a path or pattern, or directly below it, that are not hidden."""
        found = {}
        for status in self._files.globStatus(self._path(path)) or []:
            inside = self._files.listStatus(status.getPath()) if status.isDirectory() else [status]
            for file in inside:
                if file.isFile() and not file.getPath().getName().startswith(("_", ".")):
                    found[file.getPath().toString()] = file.getLen()
        return found

    def make(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def modified(self, path: str) -> datetime:
        status = self._files.getFileStatus(self._path(path))
        return datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)

    def read_text(self, path: str) -> str:
        stream = self._files.open(self._path(path))
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """A file with its whole content, in one step; False if the name is taken.

        Written under a hidden name, then renamed without overwriting. A local disk has no
        such rename, so there the lock keeps this process's threads apart, and no others.
        """
        parent, _, name = path.rpartition("/")
        self.make(parent)
        hidden = f"{parent}/.{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        java = self._spark._jvm.org.apache.hadoop.fs
        to = self._files.makeQualified(self._path(path))
        context = java.FileContext.getFileContext(to.toUri(), self._spark._jsc.hadoopConfiguration())
        no_overwriting = self._spark.sparkContext._gateway.new_array(java.Options.Rename, 1)
        no_overwriting[0] = java.Options.Rename.NONE
        try:
            with _CREATING:
                context.rename(self._files.makeQualified(self._path(hidden)), to, no_overwriting)
            return True
        except Py4JJavaError as error:
            self.delete(hidden)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise

    def bytes_at(self, path: str) -> int:
        return self._files.getContentSummary(self._path(path)).getLength()


def _beside(path: str, what: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}"


def _undo_months(files: Folders, path: str) -> None:
    """Put the months back that a swap moved aside, and take away those it added."""
    aside = _beside(path, "months")
    for name in files.names(f"{aside}/added"):
        files.delete(f"{path}/{name}")
    for name in files.names(f"{aside}/replaced"):
        files.delete(f"{path}/{name}")
        files.rename(f"{aside}/replaced/{name}", f"{path}/{name}")
    files.delete(aside)


def recover(files: Folders, path: str) -> None:
    """Undo a swap of a table or of months that stopped between its renames."""
    files.delete(_beside(path, "done"))
    old = _beside(path, "old")
    if files.exists(old):
        if files.exists(path):
            files.delete(old)
        else:
            files.rename(old, path)
    if files.exists(_beside(path, "months")):
        _undo_months(files, path)


def refuse_half_swapped(spark: SparkSession, path: str) -> None:
    """For readers, who may not undo the swap of a writer that is still at work."""
    files = Folders(spark, path)
    if files.exists(_beside(path, "months")) or (
            files.exists(_beside(path, "old")) and not files.exists(path)):
        raise InterruptedSwap(f"a replace of {path} is under way or stopped; the next write undoes it")


@contextmanager
def staged(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to; it is deleted if the block fails or leaves it in place."""
    files = Folders(spark, path)
    recover(files, path)
    new = _beside(path, f"new-{uuid.uuid4().hex}")
    try:
        yield new
    finally:
        files.delete(new)


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the table at ``path`` by what ``write`` stores in the folder it is given."""
    files = Folders(spark, path)
    with staged(spark, path) as new:
        write(new)
        old = _beside(path, "old")
        if files.exists(path):
            files.rename(path, old)
        try:
            files.rename(new, path)
        except BaseException:
            recover(files, path)
            raise
        files.delete(old)


def replace_months(spark: SparkSession, path: str, column: str, replaced: Callable[[str], bool],
                   write: Callable[[str], None]) -> None:
    """Replace the folders of the months that ``replaced`` accepts by those that ``write`` stores.

    Such a month that the new rows do not have is removed; other months stay. Folders are swapped after all of them are written: the old months are kept
    aside until the last new one is in place.
    """
    files = Folders(spark, path)

    def within(name: str) -> bool:
        return replaced(name.removeprefix(f"{column}="))

    with staged(spark, path) as new:
        write(new)
        written = [n for n in files.names(new) if n.startswith(f"{column}=")]
        if outside := [n for n in written if not within(n)]:
            raise ValueError(f"rows outside of the replaced months: {outside[0]}")
        present = [n for n in files.names(path) if n.startswith(f"{column}=") and within(n)]
        aside, done = _beside(path, "months"), _beside(path, "done")
        for name in set(written) - set(present):
            files.make(f"{aside}/added/{name}")
        try:
            for name in present:
                files.rename(f"{path}/{name}", f"{aside}/replaced/{name}")
            for name in written:
                files.rename(f"{new}/{name}", f"{path}/{name}")
        except BaseException:
            _undo_months(files, path)
            raise
        if files.exists(aside):
            files.rename(aside, done)
            files.delete(done)
