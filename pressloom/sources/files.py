"""Replacing directories of files on any Hadoop file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A path with the few file-system calls a staged write needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.run = uuid.uuid4().hex[:12]
        jvm = spark._jvm
        self._as_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._as_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str | None = None) -> bool:
        return self._fs.exists(self._as_path(path or self.path))

    def qualified(self) -> str:
        """The full path with its scheme."""
        return self._fs.makeQualified(self._as_path(self.path)).toString()

    def _move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._as_path(source), self._as_path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def _remove(self, path: str) -> None:
        self._fs.delete(self._as_path(path), True)

    @property
    def staging(self) -> str:
        """Sibling for the new content, of this writer alone; the leading underscore hides it from readers of the parent."""
        parent, _, name = self.path.rpartition("/")
        return f"{parent}/_staging.{name}.{self.run}"

    @property
    def previous(self) -> str:
        parent, _, name = self.path.rpartition("/")
        return f"{parent}/_previous.{name}"

    def recover(self) -> None:
        """Undo a swap that died between its two moves."""
        if self.exists(self.previous):
            if self.exists():
                self._remove(self.previous)
            else:
                self._move(self.previous, self.path)

    def remove(self) -> None:
        self._remove(self.path)

    def discard_staging(self) -> None:
        self._remove(self.staging)

    def swap_in(self) -> None:
        """Put the staged content in place. Not atomic on object stores: publish a view there."""
        self.replace_with(self.staging)

    def replace_with(self, content: str) -> None:
        """Move a folder to this path, in place of what is there."""
        self.recover()
        if self.exists():
            self._move(self.path, self.previous)
        else:
            self._fs.mkdirs(self._as_path(self.path.rpartition("/")[0]))
        self._move(content, self.path)
        self._remove(self.previous)

    def size(self) -> tuple[int, int]:
        """Bytes and number of files."""
        summary = self._fs.getContentSummary(self._as_path(self.path))
        return summary.getLength(), summary.getFileCount()

    def children(self) -> list[str]:
        """Names directly below the path."""
        return [status.getPath().getName() for status in self._fs.listStatus(self._as_path(self.path))] if self.exists() else []
