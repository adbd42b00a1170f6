"""Publishing sets of tables so that readers see the old set or the new one, whole.

Every run writes to a folder of its own.  A manifest then names the folder of each
table, and manifests are numbered: the one with the highest number holds.  It is
written under another name and renamed, so it is there whole or not at all; a
number that another writer took meanwhile is never overwritten, the later writer
takes the next one.  A run that fails leaves the manifest, and so every reader,
where it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Where a root keeps its manifests and its runs.
MANIFESTS, RUNS = "_manifests", "_runs"


class _Files:
    """The few file operations that publishing needs, on whatever store a path names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.system = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return [s.getPath().getName() for s in self.system.listStatus(place)] if self.system.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Whole or not at all; False where the name is taken."""
        folder, last = name.rsplit("/", 1)
        part = f"{folder}/.{last}-{uuid.uuid4().hex}"
        stream = self.system.create(self.path(part))
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.NONE
        place = self.path(name)
        try:
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.makeQualified(place).toUri(), self.conf)
            context.rename(self.system.makeQualified(self.path(part)), self.system.makeQualified(place), options)
            return True
        except Py4JJavaError:
            self.delete(part)
            if self.system.exists(place):
                return False
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _numbers(files: _Files, root: str) -> list[int]:
    names = [name.removesuffix(".json") for name in files.names(f"{root}/{MANIFESTS}")]
    return sorted(int(name) for name in names if name.isdigit())


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of every table in the newest published set; empty where nothing was published.

    Read a set's tables from one call's paths: a later call may name a later set.
    """
    root = root.rstrip("/")
    files = _Files(spark, root)
    numbers = _numbers(files, root)
    if not numbers:
        return {}
    named = json.loads(files.read(f"{root}/{MANIFESTS}/{numbers[-1]:012d}.json"))
    return {name: f"{root}/{place}" for name, place in named.items()}


def publish(spark: SparkSession, root: str, writers: Mapping[str, Callable[[str], object]]) -> dict[str, str]:
    """Run the writers, each with the path to write to, then switch to what they wrote.

    Tables that are published already and not written now stay in the set.  Returns
    the paths written.
    """
    root = root.rstrip("/")
    files = _Files(spark, root)
    run = f"{RUNS}/{uuid.uuid4().hex}"
    written = {name: f"{run}/{name}" for name in writers}
    try:
        for name, write in writers.items():
            write(f"{root}/{written[name]}")
    except BaseException:
        files.delete(f"{root}/{run}")
        raise
    while True:
        numbers = _numbers(files, root)
        held = {}
        if numbers:
            held = json.loads(files.read(f"{root}/{MANIFESTS}/{numbers[-1]:012d}.json"))
        following = numbers[-1] + 1 if numbers else 1
        if files.write_new(f"{root}/{MANIFESTS}/{following:012d}.json", json.dumps(held | written)):
            return {name: f"{root}/{place}" for name, place in written.items()}


def retire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete sets older than the newest ``keep``, and runs that only those name.

    Runs that no manifest names may still be in writing and stay.
    """
    root = root.rstrip("/")
    files = _Files(spark, root)
    numbers = _numbers(files, root)

    def runs(chosen: list[int]) -> set[str]:
        manifests = [json.loads(files.read(f"{root}/{MANIFESTS}/{n:012d}.json")) for n in chosen]
        return {"/".join(place.split("/")[:2]) for named in manifests for place in named.values()}

    old, kept = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]
    for run in runs(old) - runs(kept):
        files.delete(f"{root}/{run}")
    for number in old:
        files.delete(f"{root}/{MANIFESTS}/{number:012d}.json")
