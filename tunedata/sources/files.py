"""Small files and folders next to a table, on any file system that Spark reaches."""

from __future__ import annotations

import re

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds ``path``, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def read_small_file(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None where there is none."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole or not at all: under another name first. An older one is replaced."""
    files, where = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft")
    stream = files.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files.delete(where, False)
    if not files.rename(draft, where):
        raise OSError(f"cannot write {path}")


def numbered_folders(spark: SparkSession, parent: str, name: str) -> list[tuple[int, str]]:
    """Number and path of the folders ``<name>=<number>`` in ``parent``."""
    files, where = _at(spark, parent)
    if not files.exists(where):
        return []
    found = [re.fullmatch(rf"{name}=(\d+)", status.getPath().getName()) for status in files.listStatus(where)]
    return [(int(match[1]), f"{parent}/{match[0]}") for match in found if match]
