"""What counts in a folder of the shared storage: a log of small numbered files, of which the last holds.

A commit is one rename that fails if the next number is taken, so of two writers that saw the same state the first wins
and the other gets a :class:`ConflictError`. That rename is atomic on HDFS and local file systems; on object stores it
is as good as the store's put-if-absent.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from docmill.errors import ConflictError

#: Numbered files that are kept; older ones are deleted by later commits.
KEPT = 8


class Pointer:
    def __init__(self, spark: SparkSession, folder: str, name: str = "CURRENT"):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self._jvm.org.apache.hadoop.fs.Path
        self.folder, self.name = folder.rstrip("/"), name
        self.fs = self.path(self.folder).getFileSystem(self._conf)

    def make_folder(self) -> None:
        self.fs.mkdirs(self.path(self.folder))

    def _numbers(self) -> list[int]:
        at = self.path(self.folder)
        if not self.fs.exists(at):
            return []
        found = (re.fullmatch(re.escape(self.name) + r"\.(\d{10})", f.getPath().getName()) for f in self.fs.listStatus(at))
        return sorted(int(m[1]) for m in found if m)

    def _file(self, number: int) -> str:
        return f"{self.folder}/{self.name}.{number:010d}"

    def latest(self) -> tuple[int, str | None]:
        """The number of the last commit and its text; 0 and None before the first."""
        for _ in range(3):  # a file may be deleted as old between the listing and the reading
            numbers = self._numbers()
            if not numbers:
                return 0, None
            try:
                stream = self.fs.open(self.path(self._file(numbers[-1])))
            except Py4JJavaError:
                continue
            try:
                return numbers[-1], bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
        raise ConflictError(f"{self.folder}: commits follow each other too fast to be read")

    def read(self) -> str | None:
        return self.latest()[1]

    def swap(self, text: str, after: int | None = None) -> int:
        """Commits ``text`` as the one after number ``after`` (default: the last there is); returns its number."""
        number = (self.latest()[0] if after is None else after) + 1
        self.make_folder()
        fresh = self.path(f"{self.folder}/.{self.name}.{uuid.uuid4().hex}")
        out = self.fs.create(fresh, True)
        out.write(text.encode())
        out.close()
        uri = fresh.toUri()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri if uri.getScheme() else self.fs.getUri(), self._conf)
        modes = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        modes[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(fresh, self.path(self._file(number)), modes)
        except Py4JJavaError as e:
            self.fs.delete(fresh, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise ConflictError(f"{self.folder}: commit {number} was made by another writer") from None
            raise
        for old in self._numbers():
            if old <= number - KEPT:
                self.delete(self._file(old))
        return number

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def exists(self) -> bool:
        return bool(self._numbers())

    def size(self, path: str) -> int:
        at = self.path(path)
        return self.fs.getContentSummary(at).getLength() if self.fs.exists(at) else 0
