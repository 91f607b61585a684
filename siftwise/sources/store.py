"""Stages of a job as tables in a folder: written once, reused on restart. Small states with compare-and-set."""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class StageStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _has(self, name: str, child: str) -> bool:
        fs, where = self._fs(name)
        return fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(where, child))

    def exists(self, name: str) -> bool:
        """A finished table is there."""
        return self._has(name, "_SUCCESS") and not self._has(name, "_temporary")

    def failed(self, name: str) -> bool:
        """A write was begun and not finished."""
        fs, where = self._fs(name)
        return fs.exists(where) and not self.exists(name)

    def drop(self, name: str) -> None:
        fs, where = self._fs(name)
        fs.delete(where, True)

    def save(self, df: DataFrame, name: str, skip_existing: bool = True) -> bool:
        """Write a stage; an existing one is left alone. Returns whether it was written."""
        if self.exists(name):
            if skip_existing:
                return False
            raise FileExistsError(self.path(name))
        self.drop(name)
        df.write.option("compression", "zstd").parquet(self.path(name))
        return True

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The saved stage, made first if it is not there."""
        if not self.exists(name):
            self.save(make(), name)
        return self.load(name)


class StateStore:
    """Small JSON states by name, in a folder that several drivers may share.

    Each state is a row of numbered files that are never changed. To set a state is to rename a finished file to the number
    after the one read, which fails where another has done so: no change is lost where the file system renames atomically
    and never over a file (HDFS; local folders only between threads of one driver).
    """

    _making = threading.Lock()

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _folder(self, name: str) -> str:
        return hashlib.sha256(name.encode()).hexdigest()

    def _make(self, text: str, *parts: str) -> bool:
        fs, where = self._at(*parts)
        with self._making:
            if fs.exists(where):
                return False
            _, written = self._at("unfinished", uuid.uuid4().hex)
            out = fs.create(written, False)
            out.write(bytearray(text.encode()))
            out.close()
            fs.mkdirs(where.getParent())
            if fs.rename(written, where):
                return True
        fs.delete(written, False)
        if not fs.exists(where):
            raise OSError(f"cannot make {where}")
        return False

    def _names(self, *parts: str) -> list[str]:
        fs, where = self._at(*parts)
        return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, name: str) -> tuple[int, dict | None]:
        """Number and value of the last state; 0 and None before the first one, None after a deletion."""
        return self._last("states", self._folder(name))

    def _last(self, *parts: str) -> tuple[int, dict | None]:
        numbers = [n for n in self._names(*parts) if n.isdigit()]
        if not numbers:
            return 0, None
        fs, where = self._at(*parts, numbers[-1])
        stream = fs.open(where)
        try:
            return int(numbers[-1]), json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["value"]
        finally:
            stream.close()

    def swap(self, name: str, number: int, value: dict | None) -> bool:
        """Set the state that follows the one of this number; False where it has been followed already."""
        return self._make(json.dumps({"name": name, "value": value}), "states", self._folder(name), f"{number + 1:012d}")

    def change(self, name: str, change: Callable[[dict | None], dict | None]) -> dict | None:
        """Set the state to what `change` makes of it, tried anew when another was faster."""
        while True:
            number, value = self.read(name)
            after = change(value)
            if after == value or self.swap(name, number, after):
                return after

    def values(self) -> Iterator[dict]:
        for folder in self._names("states"):
            value = self._last("states", folder)[1]
            if value is not None:
                yield value

    def acquire(self, name: str, stale: float = 3600.0) -> bool:
        """Take the lock of this name, if nobody holds it; one older than `stale` seconds was left by a lost driver. Two that
        find it so at one moment may both take it: states are safe from that, as they are swapped."""
        fs, where = self._at("locks", self._folder(name))
        if fs.exists(where) and time.time() - fs.getFileStatus(where).getModificationTime() / 1000 > stale:
            fs.delete(where, False)
        return self._make("", "locks", self._folder(name))

    def release(self, name: str) -> None:
        fs, where = self._at("locks", self._folder(name))
        fs.delete(where, False)

    @contextmanager
    def locked(self, name: str, wait: float = 60.0):
        """Hold the lock of this name; TimeoutError when it is not free within `wait` seconds."""
        end = time.time() + wait
        while not self.acquire(name):
            if time.time() > end:
                raise TimeoutError(f"{name} is locked")
            time.sleep(0.05)
        try:
            yield
        finally:
            self.release(name)
