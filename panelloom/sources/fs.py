"""Paths of the session's own file systems: listing, renaming, small text files."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# What a failing read, write or move can raise.
SPARK_ERRORS = (OSError, PySparkException, Py4JError)


def short_message(error: Exception) -> str:
    """First line of an error; of a JVM error the line that names its cause."""
    java = getattr(error, "java_exception", None)
    text = java.getMessage() if java is not None else str(error)
    return (text or type(error).__name__).strip().splitlines()[0]


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def join(*parts: str) -> str:
    return "/".join(str(p).rstrip("/") for p in parts)


def parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


def name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark names files below it."""
    target, fs = _path(spark, path)
    return fs.makeQualified(target).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def rename(spark: SparkSession, source: str, target: str) -> None:
    origin, fs = _path(spark, source)
    destination, _ = _path(spark, target)
    fs.mkdirs(destination.getParent())
    if fs.exists(destination):
        raise OSError(f"Destino já existe: {target}")
    if not fs.rename(origin, destination):
        raise OSError(f"Não foi possível mover {source} para {target}")


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def list_files(spark: SparkSession, root: str, hidden: bool = False) -> list[str]:
    """Paths of all files below ``root``, relative to it, sorted; without hidden and marker files
    unless asked for.  Empty files are listed too, which a Spark scan would pass over."""
    target, fs = _path(spark, root)
    if not fs.exists(target):
        return []
    base = fs.resolvePath(target).toUri().getPath()
    found, pending = [], fs.listFiles(target, True)
    while pending.hasNext():
        relative = pending.next().getPath().toUri().getPath()[len(base):].lstrip("/")
        if hidden or not any(part.startswith(("_", ".")) for part in relative.split("/")):
            found.append(relative)
    return sorted(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _path(spark, path)
    fs.mkdirs(target.getParent())
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a text file unless there is one; whoever reads it finds the whole text, and of two writers one succeeds.

    A finished file gets its name by one operation that fails where the name is taken: a hard link on a local
    file system, elsewhere a rename without overwriting.
    """
    target, fs = _path(spark, path)
    staged = join(parent(path), f"_novo-{uuid.uuid4().hex}")
    write_text(spark, staged, text)
    try:
        if fs.getScheme() == "file":
            os.link(_path(spark, staged)[0].toUri().getPath(), target.toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            none = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
            hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(
                _path(spark, staged)[0], target, none)
    except FileExistsError:
        return False
    except Py4JError as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    finally:
        delete(spark, staged)
    return True


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root``, sorted."""
    target, fs = _path(spark, root)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
