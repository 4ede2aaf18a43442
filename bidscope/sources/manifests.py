"""Numbered manifests: atomic commits of folders in a shared file system.

A log is a folder of files ``00000000000000000007``, each with the lines of one
state.  A commit writes its lines under a name of its own and renames the file to the next
number, which fails if that number exists (``FileContext.rename`` without overwrite,
atomic on HDFS).  So of two writers who read the same state one is refused and starts
again from the other's, and a reader sees a whole state or the one before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_DIGITS = 20


class Conflict(RuntimeError):
    """Another writer has committed this number."""


class ManifestLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        self._fs.mkdirs(self._path(""))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def latest(self) -> int:
        """The last committed number, 0 when there is none."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        return max((int(n) for n in names if len(n) == _DIGITS and n.isdigit()), default=0)

    def read(self, number: int | None = None) -> list[str]:
        """The lines of a commit (the latest one by default)."""
        number = self.latest() if number is None else number
        if number == 0:
            return []
        stream = self._fs.open(self._path(f"{number:0{_DIGITS}}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return text.split("\n")[:-1]

    def commit(self, number: int, lines: list[str]) -> None:
        """Make ``lines`` the state ``number``; raises ``Conflict`` if that exists."""
        own = self._path(f".{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        try:
            out.write(bytearray("".join(f"{x}\n" for x in lines), "utf-8"))
        finally:
            out.close()
        fc = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            fc.rename(fc.makeQualified(own), fc.makeQualified(self._path(f"{number:0{_DIGITS}}")), how)
        except Exception as e:
            self._fs.delete(own, False)
            if self._fs.exists(self._path(f"{number:0{_DIGITS}}")):
                raise Conflict(f"{self.root}: {number} is committed") from e
            raise

    def update(self, change: Callable[[list[str]], list[str] | None], tries: int = 100) -> bool:
        """Commit ``change(lines)`` on top of the latest state, again after each conflict;
        None commits nothing and returns False."""
        for _ in range(tries):
            number = self.latest()
            lines = change(self.read(number))
            if lines is None:
                return False
            try:
                self.commit(number + 1, lines)
                return True
            except Conflict:
                continue
        raise Conflict(f"{self.root}: no commit in {tries} tries")
