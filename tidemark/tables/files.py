"""The few file operations that need Spark's own file system client."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _resolve(spark, path)
    return fs.exists(handle)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; empty if there is no such directory."""
    fs, handle = _resolve(spark, path)
    if not fs.exists(handle):
        return []
    return [status.getPath().getName() for status in fs.listStatus(handle)]


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file that appears complete; an existing one is an error."""
    fs, handle = _resolve(spark, path)
    _, draft = _resolve(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(handle) or not fs.rename(draft, handle):
        fs.delete(draft, False)
        raise FileExistsError(path)


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small new file."""
    fs, handle = _resolve(spark, path)
    stream = fs.create(handle, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def read(spark: SparkSession, path: str) -> str:
    fs, handle = _resolve(spark, path)
    stream = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, handle = _resolve(spark, path)
    fs.delete(handle, True)


def beside(path: str, mark: str) -> str:
    """A hidden directory next to ``path``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{mark}" if parent else f"_{name}-{mark}"


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Let a finished directory take the place of another one.

    The old one steps aside to a fixed name. If the two renames were cut short before,
    it is still there: with nothing at ``path`` it first comes back, otherwise the
    swap was complete and it goes."""
    fs, new = _resolve(spark, staged)
    _, target = _resolve(spark, path)
    _, aside = _resolve(spark, beside(path, "before"))
    if fs.exists(aside):
        if fs.exists(target):
            fs.delete(aside, True)
        else:
            fs.rename(aside, target)
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, aside):
        raise OSError(f"Cannot move {path}")
    if not fs.rename(new, target):
        if replaced:
            fs.rename(aside, target)
        raise OSError(f"Cannot move {staged} to {path}")
    if replaced:
        fs.delete(aside, True)


def absolute(spark: SparkSession, path: str) -> str:
    fs, handle = _resolve(spark, path)
    return fs.makeQualified(handle).toString().rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory that every executor can reach.

    It lies in the folder the session names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
