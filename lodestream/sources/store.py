"""Small files in a folder that Spark's file systems reach, each replaced as a whole."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


class Store:
    """Texts by name. Each version is a file of its own, written aside and renamed to a name that does not exist yet; the
    highest version counts and older ones go afterwards. So a reader, or the next run after a crash, sees the old text or the new one.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        found = (re.fullmatch(rf"_{re.escape(name)}\.(\d+)", f.getPath().getName()) for f in self._fs.listStatus(folder))
        return sorted(int(m[1]) for m in found if m)

    def read(self, name: str) -> str | None:
        versions = self._versions(name)
        if not versions:
            return None
        with_stream = self._fs.open(self._path(f"{self.folder}/_{name}.{versions[-1]}"))
        try:
            return self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_stream, "UTF-8")
        finally:
            with_stream.close()

    def write(self, name: str, text: str) -> None:
        versions = self._versions(name)
        aside, new = (self._path(f"{self.folder}/{x}") for x in (f".{name}.new", f"_{name}.{max(versions, default=0) + 1}"))
        self._fs.mkdirs(self._path(self.folder))
        out = self._fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(aside, new):
            raise OSError(f"{new} was not written")
        for v in versions:
            self._fs.delete(self._path(f"{self.folder}/_{name}.{v}"), False)

    def remove(self, name: str) -> None:
        for v in self._versions(name):
            self._fs.delete(self._path(f"{self.folder}/_{name}.{v}"), False)
