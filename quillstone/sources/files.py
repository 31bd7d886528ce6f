"""Files and folders by Spark's own file systems, so that any store it can read will do.

State is kept as numbered versions under a folder of its name: a version is written aside and renamed
to a number that does not exist yet, and readers take the newest. Nothing that a reader may need is
deleted first, so a stop at any point leaves the old state or the new one.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published a version in between."""


class LockTimeout(RuntimeError):
    pass


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; where none is set, one of a local session's own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"{tempfile.gettempdir()}/checkpoints"
    return found.rstrip("/")


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A new plain file."""
    _write_whole(spark, path, text, new=True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a name that does not exist; False if it does. The parent folder is made."""
    fs, p = _at(spark, source)
    to = _at(spark, target)[1]
    fs.mkdirs(to.getParent())
    return not fs.exists(to) and fs.rename(p, to)


def _write_whole(spark: SparkSession, path: str, text: str, new: bool = False) -> None:
    fs, p = _at(spark, path)
    stream = fs.create(p, not new)
    try:
        stream.write(bytearray(text.encode()))
        stream.hsync()
    finally:
        stream.close()


def _read_whole(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names(spark, path) if n.isdigit())


def version(spark: SparkSession, path: str) -> int:
    """The number of the newest version of a state; 0 without one."""
    return max(_versions(spark, path), default=0)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The newest version of a state; None without one."""
    for _ in range(20):  # a version may be superseded and removed between listing and reading
        newest = version(spark, path)
        if not newest:
            return None
        try:
            return _read_whole(spark, f"{path}/{newest:012d}")
        except Py4JJavaError:
            if version(spark, path) == newest:
                raise
    raise Conflict(f"{path} changes faster than it can be read")


def write_text(spark: SparkSession, path: str, text: str, after: int | None = None) -> int:
    """Publish a new version of a state and return its number; the one before is kept for readers that hold its name.

    With `after`, Conflict is raised if the newest version is another one than that.
    """
    aside = f"{path}/.{uuid.uuid4().hex}"
    _write_whole(spark, aside, text)
    while True:
        number = (version(spark, path) if after is None else after) + 1
        if (after is None or version(spark, path) == after) and rename_new(spark, aside, f"{path}/{number:012d}"):
            break
        if after is not None:
            delete(spark, aside)
            raise Conflict(f"{path}: another version than {after} is the newest")
    for old in _versions(spark, path):
        if old < number - 1:
            delete(spark, f"{path}/{old:012d}")
    return number


def append_numbered(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Add a whole, flushed file of that number to a folder; False if there is one already."""
    aside = f"{folder}/.{uuid.uuid4().hex}"
    _write_whole(spark, aside, text)
    if rename_new(spark, aside, f"{folder}/{number:012d}"):
        return True
    delete(spark, aside)
    return False


def read_numbered(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    return [(n, _read_whole(spark, f"{folder}/{n:012d}")) for n in _versions(spark, folder)]


@contextmanager
def lock(spark: SparkSession, path: str, wait: float = 30.0, stale: float = 600.0) -> Iterator[None]:
    """Hold a lock file. LockTimeout after `wait` seconds; a lock older than `stale` seconds was left by a crash and is broken."""
    token, give_up = uuid.uuid4().hex, time.monotonic() + wait
    fs, p = _at(spark, path)
    while True:
        try:
            _write_whole(spark, path, token, new=True)
            if _read_whole(spark, path) == token:  # where creating is not exclusive, the last writer holds it
                break
        except Py4JJavaError:
            if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > stale:
                rename_new(spark, path, f"{path}.broken-{token}")
                delete(spark, f"{path}.broken-{token}")
                continue
        if time.monotonic() > give_up:
            raise LockTimeout(f"{path} has been held for {wait} seconds")
        time.sleep(0.1)
    try:
        yield
    finally:
        if exists(spark, path) and _read_whole(spark, path) == token:
            delete(spark, path)


def first_line(spark: SparkSession, path: str) -> str | None:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes, a block at a time."""
    import hashlib

    fs, p = _at(spark, path)
    stream, total = fs.open(p), hashlib.sha256()
    try:
        while block := bytes(b & 0xFF for b in stream.readNBytes(1 << 20)):
            total.update(block)
    finally:
        stream.close()
    return total.hexdigest()
