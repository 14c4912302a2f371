"""Small files and listings in a folder that all executors share, by Hadoop's file systems."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import SparkSession


class FileInfo(NamedTuple):
    path: str
    size: int
    changed: int


class SharedFiles:
    """The file system of one path: local, HDFS or any store Spark itself reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def all_files(self, folder: str) -> Iterator[FileInfo]:
        """Every file below a folder, without opening any."""
        found = self._system.listFiles(self._path(folder), True)
        while found.hasNext():
            one = found.next()
            yield FileInfo(one.getPath().toString(), one.getLen(), one.getModificationTime())

    def names(self, folder: str) -> list[str]:
        """What lies directly in a folder; nothing where there is none."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self._system.listStatus(self._path(folder))]

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_once(self, path: str, text: str) -> bool:
        """Put a whole file at a path no file is at; whether this writer was the one.

        The text is written beside it and renamed, so no reader meets half of it.
        """
        beside = self._path(f"{path}.part")
        stream = self._system.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.exists(path) and self._system.rename(beside, self._path(path))
        if not done:
            self._system.delete(beside, False)
        return done

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)
