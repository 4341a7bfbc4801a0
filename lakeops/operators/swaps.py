"""Replacing folders of a table by renames, so that a job that dies can be finished or undone.

A swap has a hidden folder beside what it replaces: ``new`` holds the files that were written, ``old`` takes those
that go, and ``ready`` names the folders to exchange. Until ``ready`` is written the table is as it was;
from then on the exchange is carried out, by whoever comes next if the job dies: every step looks at what
is there and can be repeated. Nothing is written twice. A reader that meets a swap between its two
renames finds no folder and fails, rather than reading half of it; :func:`recover` completes the swap.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from lakeops.sources.ingest import path_exists


class Files:
    """The file system of a path, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def folders(self, pattern: str) -> list[str]:
        return [s.getPath().toUri().getPath() for s in self._fs.globStatus(self._path(pattern)) if s.isDirectory()]

    def rename(self, src: str, dst: str) -> None:
        self._fs.mkdirs(self._path(dst).getParent())
        if not self._fs.rename(self._path(src), self._path(dst)):
            raise OSError(f"{src} was not renamed to {dst}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _beside(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, f"_{name}.swap-"


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None], inner: int = 0) -> None:
    """Put what ``write`` writes into a folder in the place of ``path``.

    With ``inner`` only the folders that many levels below are exchanged (partitions), the others stay. Hidden
    files of a replaced folder are kept, but for those of the job that wrote it.
    """
    recover(spark, path)
    files, (parent, prefix) = Files(spark, path), _beside(path)
    if files.exists(f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is listed by a stream's log and can't be replaced")
    swap = f"{parent}/{prefix}{uuid.uuid4().hex}"
    write(f"{swap}/new")
    found = files.folders(f"{swap}/new" + "/*" * inner) if inner else [f"{swap}/new"]
    inside = [f.rpartition(f"{prefix}")[2].partition("/new")[2].lstrip("/") for f in found]
    spark.createDataFrame([(json.dumps(inside),)], "value STRING").coalesce(1).write.text(f"{swap}/ready")
    _exchange(spark, path, swap)


def recover(spark: SparkSession, path: str) -> int:
    """Complete the swaps of ``path`` that were ready and drop those that were not; how many were found."""
    files, (parent, prefix) = Files(spark, path), _beside(path)
    found = [f"{parent}/{n}" for n in files.names(parent) if n.startswith(prefix)]
    for swap in found:
        if path_exists(spark, f"{swap}/ready/_SUCCESS"):
            _exchange(spark, path, swap)
        else:
            files.delete(swap)
    return len(found)


def _exchange(spark: SparkSession, path: str, swap: str) -> None:
    files = Files(spark, path)
    for name in json.loads(spark.read.text(f"{swap}/ready").first()[0]):
        new, old, place = (f"{p}/{name}".rstrip("/") for p in (f"{swap}/new", f"{swap}/old", path))
        if files.exists(new):
            if files.exists(place):
                files.rename(place, old)
            files.rename(new, place)
        for hidden in files.names(old):
            if hidden.startswith(("_", ".")) and hidden != "_SUCCESS" and not hidden.endswith(".crc") and not files.exists(f"{place}/{hidden}"):
                files.rename(f"{old}/{hidden}", f"{place}/{hidden}")
    files.delete(swap)
