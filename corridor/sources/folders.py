"""Small files beside a table, on whatever store the session's paths lead to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Names and short texts in one folder, through the session's own file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str = "") -> bool:
        """Is there such a file or folder; without a name, the folder itself?"""
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        """Names in the folder; none if there is no folder."""
        if not self.has():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all; one that exists is left as it is."""
        draft = self._at(f".{uuid.uuid4().hex}.draft")
        self._fs.mkdirs(self._at(""))
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.has(name) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
