"""Small files beside tables, in whatever file system a path names, as Spark itself would find it."""

from __future__ import annotations

import json

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared URI, for tasks that read a table's files themselves."""
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def read_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """The file appears under its name when it is whole."""
    fs, where = _at(spark, path)
    _, partial = _at(spark, f"{path}.partial")
    out = fs.create(partial, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    fs.rename(partial, where)


def write_json(spark: SparkSession, value, path: str) -> None:
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False, sort_keys=True), path)
