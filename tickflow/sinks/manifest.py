"""Which ``batch=`` folders of a published day count: a small list per day.

The list is a JSON file in the day's ``_manifest`` folder, which Spark's readers do not see.
It is never changed: a change writes the next number, and the highest one counts. Two
writers cannot write the same number, so none overlooks what the other did. (The store must
create a file only if there is none, as HDFS does; on a plain local folder that holds for
the writers of one process.) That is what makes a change of several folders happen at once.
A day without a list, written before
there were any or by Spark's own file sink, has the folders that are there.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tickflow.schemas import PARTITIONS

Day = tuple[str, ...]  # year, month and day

_FOLDER = "_manifest"
# Older lists that stay, for a reader that has just looked for the newest.
_KEPT = 3
_TRIES = 20
_CREATING = threading.Lock()


@dataclass(frozen=True)
class Entry:
    """One committed write of a day. A write that is repeated has another ``id``; a compacted
    one names the batches that it holds."""

    batch: str
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    of: tuple[str, ...] = ()

    def holds(self, batch: str) -> bool:
        return batch in self.of


@dataclass(frozen=True)
class Manifest:
    """The entries of a day in the order of their commits; number 0 if there is no list."""

    number: int
    entries: tuple[Entry, ...]

    @property
    def batches(self) -> list[str]:
        return [e.batch for e in self.entries]


def day_folder(root: str, day: Iterable[str]) -> str:
    return "/".join([root, *(f"{name}={value}" for name, value in zip(PARTITIONS.names, day, strict=True))])


class Store:
    """The file system of a published result."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._path_of = spark._jvm.org.apache.hadoop.fs.Path
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString
        self._system = self._path_of(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path_of(path))

    def found(self, pattern: str) -> list[str]:
        return [str(s.getPath()) for s in self._system.globStatus(self._path_of(pattern)) or []]

    def delete(self, path: str) -> None:
        self._system.delete(self._path_of(path), True)

    def rename(self, path: str, target: str) -> None:
        if not self._system.rename(self._path_of(path), self._path_of(target)):
            raise RuntimeError(f"could not put {path} in its place {target}")

    def set_time(self, path: str, millis: int) -> None:
        self._system.setTimes(self._path_of(path), millis, -1)

    def read(self, path: str) -> str:
        stream = self._system.open(self._path_of(path))
        try:
            return self._read(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if it is there already."""
        with _CREATING:
            try:
                stream = self._system.create(self._path_of(path), False)
            except Py4JJavaError as error:
                if "AlreadyExists" in error.java_exception.getClass().getName():
                    return False
                raise
            try:
                stream.write(bytearray(text, "utf-8"))
            finally:
                stream.close()
        return True

    # --- lists -----------------------------------------------------------------------

    def _list_path(self, day: Day, number: int) -> str:
        return f"{day_folder(self.root, day)}/{_FOLDER}/{number:012d}.json"

    def manifest(self, day: Day) -> Manifest:
        """The newest list of a day."""
        paths = self.found(f"{day_folder(self.root, day)}/{_FOLDER}/*.json")
        return self._newest(day, sorted(paths, reverse=True))

    def _newest(self, day: Day, paths: list[str]) -> Manifest:
        for path in paths:
            try:
                entries = json.loads(self.read(path))
            except (json.JSONDecodeError, Py4JJavaError):
                continue  # being written, or just removed
            number = int(path.rsplit("/", 1)[1].split(".")[0])
            return Manifest(number, tuple(Entry(e["batch"], e["id"], tuple(e["of"])) for e in entries))
        return Manifest(0, ())

    def manifests(self) -> dict[Day, Manifest]:
        """The newest list of every day there is, from one look at the folders."""
        levels = "/".join(f"{name}=*" for name in PARTITIONS.names)
        days: dict[Day, list[str]] = {_keys(path): [] for path in self.found(f"{self.root}/{levels}")}
        for path in self.found(f"{self.root}/{levels}/{_FOLDER}/*.json"):
            days[_keys(path.rsplit("/", 2)[0])].append(path)
        newest = each(days, lambda day: self._newest(day, sorted(days[day], reverse=True)))
        return dict(zip(days, newest, strict=True))

    def folders(self, day: Day) -> list[str]:
        """The names of all ``batch=`` folders of a day, whether they count or not."""
        paths = self.found(f"{day_folder(self.root, day)}/batch=*")
        return sorted(path.rsplit("/batch=", 1)[1] for path in paths)

    def commit(
        self, day: Day, change: Callable[[tuple[Entry, ...]], tuple[Entry, ...] | None]
    ) -> tuple[Entry, ...]:
        """Replace a day's entries by what ``change`` makes of them; None leaves them. Gives
        the entries that hold then.

        ``change`` is asked again if another writer was faster. The first list of a day
        begins with the folders that are there."""
        for _ in range(_TRIES):
            now = self.manifest(day)
            entries = now.entries if now.number else tuple(Entry(b) for b in self.folders(day))
            after = change(entries)
            if after is None:
                return entries
            text = json.dumps([{"batch": e.batch, "id": e.id, "of": e.of} for e in after])
            if self.create(self._list_path(day, now.number + 1), text):
                if now.number >= _KEPT:
                    self.delete(self._list_path(day, now.number - _KEPT + 1))
                return after
        raise RuntimeError(f"{day_folder(self.root, day)}: other writers were faster {_TRIES} times")


def _keys(path: str) -> Day:
    return tuple(part.split("=", 1)[1] for part in path.split("/")[-len(PARTITIONS.names) :])


def each(days: Iterable[Day], action: Callable) -> list:
    """``action`` for every day, several at a time."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(action, days))
