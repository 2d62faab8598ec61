"""Folders of a dataset, by Hadoop's file system: works on every store that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """File-system calls on the store of ``path``; they run on the driver and move no rows."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._copy = spark._jvm.org.apache.commons.io.IOUtils.toString

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def match(self, pattern: str) -> list[str]:
        """Paths that match a glob pattern."""
        found = self._fs.globStatus(self._path(pattern))
        return [str(s.getPath().toString()) for s in found] if found else []

    def listing(self, path: str) -> dict[str, tuple[int, int]]:
        """Name to (bytes, modification time in ms) of what lies in a folder."""
        return {str(s.getPath().getName()): (s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self._path(path))}

    def status(self, path: str) -> tuple[int, int]:
        """Bytes and modification time (ms) of a file or folder."""
        found = self._fs.getFileStatus(self._path(path))
        return found.getLen(), found.getModificationTime()

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, old: str, new: str) -> bool:
        """Move a folder to a name that is free; False where it could not be moved."""
        self.make(new.rsplit("/", 1)[0])
        return not self.exists(new) and self._fs.rename(self._path(old), self._path(new))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return self._copy(source, "UTF-8")
        finally:
            source.close()
