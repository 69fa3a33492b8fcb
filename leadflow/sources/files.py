"""Folders and small marker files, on whatever file system the path names (the driver's part of a load)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Taken(RuntimeError):
    """Another writer has created the file first."""


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has been completed."""
    return exists(spark, f"{folder}/_SUCCESS")


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if there is no such folder."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def create(spark: SparkSession, path: str, content: dict) -> None:
    """A small JSON file that must not be there yet: of two writers, the later one gets ``Taken``."""
    fs, where = _at(spark, path)
    try:
        out = fs.create(where, False)
    except Exception as refused:
        if fs.exists(where):
            raise Taken(path) from refused
        raise
    out.write(bytearray(json.dumps(content).encode()))
    out.close()


def content(spark: SparkSession, path: str) -> dict | None:
    """What ``create`` has written; nothing while it is still being written."""
    fs, where = _at(spark, path)
    size = fs.getFileStatus(where).getLen()
    if not size:
        return None
    source = fs.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    try:
        return json.loads(text)
    except ValueError:
        return None
