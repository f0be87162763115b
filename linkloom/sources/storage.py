"""Files of the control plane, on the file system that the executors see.

A path of this machine's file system is handled by Python; any other, such as one of a distributed file system,
by Hadoop's file system classes through the running session, so that driver and executors mean the same file.
Files handled here are small, or are read in blocks.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import SparkSession

BLOCK = 1 << 20


def _local(path: str) -> Path | None:
    """The path, if it is one of this machine."""
    if path.startswith("file:"):
        return Path("/" + path.removeprefix("file:").lstrip("/"))
    if "://" in path:
        return None
    spark = SparkSession.getActiveSession()
    if spark is not None and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    return Path(path)


class _Remote:
    """A path of Hadoop's file systems."""

    def __init__(self, path: str):
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise ValueError(f"{path} needs a running session")
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def blocks(self) -> Iterator[bytes]:
        stream = self.fs.open(self.path)
        try:
            io = self.jvm.org.apache.commons.io
            while block := io.IOUtils.toByteArray(io.input.BoundedInputStream(stream, BLOCK)):
                yield bytes(block)
        finally:
            stream.close()

    def write(self, blocks: Iterable[bytes]) -> None:
        out = self.fs.create(self.path, True)
        try:
            for block in blocks:
                out.write(bytearray(block))
        finally:
            out.close()

    def rename(self, target: _Remote) -> None:
        # A file system of this kind refuses to rename onto a file.
        if self.fs.exists(target.path):
            self.fs.delete(target.path, True)
        if not self.fs.rename(self.path, target.path):
            raise OSError(f"cannot rename {self.path.toString()} to {target.path.toString()}")


def exists(path: str) -> bool:
    at = _local(path)
    if at is not None:
        return at.exists()
    remote = _Remote(path)
    return remote.fs.exists(remote.path)


def blocks(path: str) -> Iterator[bytes]:
    """The contents, block by block."""
    at = _local(path)
    if at is None:
        yield from _Remote(path).blocks()
        return
    with at.open("rb") as f:
        while block := f.read(BLOCK):
            yield block


def read(path: str) -> bytes:
    return b"".join(blocks(path))


def write(path: str, contents: Iterable[bytes]) -> None:
    """Writes under another name, then renames."""
    at = _local(path)
    if at is None:
        hidden = _Remote(path + ".tmp")
        hidden.write(contents)
        hidden.rename(_Remote(path))
        return
    at.parent.mkdir(parents=True, exist_ok=True)
    hidden = at.with_name(at.name + ".tmp")
    with hidden.open("wb") as f:
        for block in contents:
            f.write(block)
    os.replace(hidden, at)


def rename(source: str, target: str) -> None:
    """Renames a file, in place of one that is there."""
    a, b = _local(source), _local(target)
    if a is None or b is None:
        _Remote(source).rename(_Remote(target))
        return
    b.parent.mkdir(parents=True, exist_ok=True)
    os.replace(a, b)


def remove(path: str) -> None:
    """Removes a file or folder, if it is there."""
    at = _local(path)
    if at is None:
        remote = _Remote(path)
        remote.fs.delete(remote.path, True)
    elif at.is_dir():
        shutil.rmtree(at)
    else:
        at.unlink(missing_ok=True)


def files(folder: str) -> list[str]:
    """The files below a folder, sorted."""
    at = _local(folder)
    if at is not None:
        return [str(p) for p in sorted(at.rglob("*")) if p.is_file()]
    remote, out = _Remote(folder), []
    found = remote.fs.listFiles(remote.path, True)
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return sorted(out)


def one_file(lines, path: str) -> None:
    """A sorted or single-partition DataFrame of one text column as one file; its rows pass one task."""
    hidden = f"{path}.parts"
    lines.coalesce(1).write.mode("overwrite").text(hidden)
    parts = [x for x in files(hidden) if x.rsplit("/", 1)[-1].startswith("part-")]
    if len(parts) != 1:
        raise OSError(f"{hidden} has {len(parts)} parts")
    rename(parts[0], path)
    remove(hidden)
