"""One order for all writers of a table: each write takes the next number when its rows are known.

Numbers are files in the hidden folder ``_orders`` of the table, made with exclusive creation, so no
two writers get the same one, whatever their clocks say. A second file says that the write is
complete. Readers of the table do not see the folder.
"""

from __future__ import annotations

import contextlib
import threading
import time
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Numbers kept in the folder; older ones are removed as new ones are taken.
KEPT = 1000
_DIGITS = 19
_DONE = ".done"
_lock = threading.Lock()


class Folder:
    """A folder of the file system it lies in, whichever Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark.sparkContext._jvm, path
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> dict[str, float]:
        """Names in the folder and the seconds they were last changed at; none if there is no folder."""
        if not self._files.exists(self._at("")):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._files.listStatus(self._at(""))}

    def matching(self, pattern: str) -> list[str]:
        """Paths below the folder that a pattern fits, relative to it."""
        found = [str(s.getPath().toString()) for s in self._files.globStatus(self._at(pattern)) or []]
        depth = pattern.count("/") + 1
        return ["/".join(path.split("/")[-depth:]) for path in found]

    def create(self, name: str, text: str = "") -> bool:
        """Make a file that must not exist; whether it is ours."""
        try:
            out = self._files.create(self._at(name), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                return False
            raise
        out.writeBytes(text)
        out.close()
        return self.text(name) == text

    def text(self, name: str) -> str:
        source = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def remove(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def orders(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, f"{path}/_orders")


def taken(folder: Folder) -> dict[int, tuple[float, bool]]:
    """The numbers of a folder: when each was taken, and whether its write is complete."""
    names = folder.names()
    return {int(n): (at, f"{n}{_DONE}" in names) for n, at in names.items() if n.isdigit()}


def take_number(spark: SparkSession, path: str, least: Callable[[], int] = lambda: 0) -> int:
    """The next number of the table at ``path``. ``least`` is asked once per table, for its first number."""
    folder = orders(spark, path)
    with _lock:
        known = taken(folder)
        number = max(known) if known else least()
        while True:
            number += 1
            if folder.create(f"{number:0{_DIGITS}d}", uuid.uuid4().hex):
                # Whoever was slow may have filled a place that was already cleared away.
                newest = max(taken(folder))
                if newest == number:
                    break
                number = newest
    for old in sorted(known)[:-KEPT]:
        for name in (f"{old:0{_DIGITS}d}", f"{old:0{_DIGITS}d}{_DONE}"):
            with contextlib.suppress(Py4JJavaError):
                folder.remove(name)
    return number


def complete(spark: SparkSession, path: str, number: int) -> None:
    orders(spark, path).create(f"{number:0{_DIGITS}d}{_DONE}")


def complete_up_to(spark: SparkSession, path: str, grace: float = 3600.0) -> int:
    """The largest number up to which every write has ended.

    A write that has not ended ``grace`` seconds after it took its number counts as given up: what a
    failed Spark write leaves is never read.
    """
    upto = 0
    for number, (at, done) in sorted(taken(orders(spark, path)).items()):
        if not done and time.time() - at < grace:
            break
        upto = number
    return upto
