"""Numbered versions in a directory, each published once.

A version is a small file. It is written under another name and then renamed, which
fails if the number is taken; so of two writers one is first, the other reads again and
takes the next number. It needs a file system whose rename does not replace, as
checkpoints of streams do (HDFS, ABFS, a local disk).
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# a local disk renames onto what is there: writers of one driver take turns
_TURNS = threading.Lock()


class Versions:
    """The versions of one directory, as JSON values."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        given = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = given.getFileSystem(self._conf)
        self.path = self._fs.makeQualified(given).toString()

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        """Numbers of all versions that are there, in order."""
        if not self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(self.path)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._jvm.org.apache.hadoop.fs.Path(self.path))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def read(self, number: int) -> object:
        stream = self._fs.open(self._file(f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, number: int, value: object) -> bool:
        """Whether the version is ours now; False if the number was taken."""
        aside, target = self._file(f".{uuid.uuid4().hex}"), self._file(f"{number:012d}.json")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._conf)
        with _TURNS:
            try:
                context.rename(aside, target, how)
                return True
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                    raise
        self._fs.delete(aside, False)
        return False

    def remove(self, number: int) -> None:
        self._fs.delete(self._file(f"{number:012d}.json"), False)

    def newest(self) -> tuple[int, object] | None:
        """The last version; one that is removed meanwhile is looked for again."""
        while numbers := self.numbers():
            try:
                return numbers[-1], self.read(numbers[-1])
            except Py4JJavaError as error:
                if "FileNotFoundException" not in error.java_exception.getClass().getName():
                    raise
        return None

    def change(self, change: Callable[[object], object], first: object) -> object:
        """Publish what ``change`` makes of the newest value (``first`` if there is none)
        as the next version; done again with the newer value whenever another writer
        was faster. Returns the value that was published."""
        while True:
            newest = self.newest()
            number, value = (-1, first) if newest is None else newest
            value = change(value)
            if self.publish(number + 1, value):
                return value
