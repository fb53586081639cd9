"""Tables as chains of committed versions, so that no crash and no second writer loses rows.

A version is a small JSON manifest that names the data folders it consists of.
Data is written to fresh folders first, by Spark's own committer; then the
manifest is written under a temporary name and renamed to the next number, which
fails if that number is taken. A reader takes the highest number. A crash before
the rename leaves folders that nothing names (``vacuum`` deletes them), one after
it leaves the new version: there is no moment at which a reader finds nothing.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one would have been."""


def shared_folder(spark: SparkSession, label: str, *key: str) -> str:
    """A folder below ``spark.checkpoint.dir`` that stays the same for the same label and key."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("lectern.shared.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("lectern.shared.dir", base)
    return f"{base.rstrip('/')}/lectern/{label}-{hashlib.sha256(chr(0).join(key).encode()).hexdigest()[:16]}"


class Versions:
    """The versions in folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def numbers(self) -> list[int]:
        folder = self._at("manifest")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._at(f"manifest/{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict | None:
        """The latest manifest, with its number as ``version``; None if nothing was ever committed."""
        numbers = self.numbers()
        return self.read(numbers[-1]) | {"version": numbers[-1]} if numbers else None

    def folder(self, label: str) -> str:
        """A fresh folder for data; only a commit makes it part of the table."""
        return f"{self.path}/data/{label}-{uuid.uuid4().hex}"

    def commit(self, manifest: dict, after: int) -> int:
        """Make ``manifest`` the version that follows number ``after`` (0: the first)."""
        number = after + 1
        if number <= max(self.numbers(), default=0):
            raise CommitConflict(f"version {number} of {self.path} is taken")
        temporary, final = self._at(f"manifest/.{uuid.uuid4().hex}.tmp"), self._at(f"manifest/{number:012d}.json")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm = self.spark._jvm
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(temporary, final, no_overwrite)
        except Py4JJavaError as e:
            self._fs.delete(temporary, False)
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise CommitConflict(f"version {number} of {self.path} is taken") from e
            raise
        return number

    def vacuum(self, keep: int = 2, age_s: int = 3600) -> list[str]:
        """Delete manifests but the latest ``keep``, and data folders that none of those names and that are older than ``age_s``."""
        numbers = self.numbers()
        named = json.dumps([self.read(n) for n in numbers[-keep:]])
        gone = []
        for n in numbers[:-keep]:
            self._fs.delete(self._at(f"manifest/{n:012d}.json"), False)
        if self._fs.exists(self._at("data")):
            for s in self._fs.listStatus(self._at("data")):
                name = s.getPath().getName()
                if name not in named and time.time() - s.getModificationTime() / 1000 >= age_s:
                    self._fs.delete(s.getPath(), True)
                    gone.append(name)
        return gone


def state_of(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of the files at ``path``: another one means that they may have changed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], [at]
    while todo:
        for s in files.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()
