"""Tables that a plan writes and reads again, so that what several branches need is made once and survives
the loss of an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, in the file system that the cluster says. Only where the
    session has no such setting, in a local run, is a temporary folder made, which goes with the process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        local = tempfile.mkdtemp(prefix="kinmatch-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        base = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path)
    return f"{whole.toString().rstrip('/')}/kinmatch/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """What is written is read from its files, so the shuffles that made it go as soon as it is there, not when the
    driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The table, written and read back; ``by`` a column, if its rows are to lie in files of their own."""
    return staged_parts([df], name, by)


def staged_parts(parts: Iterable[DataFrame], name: str, by: str | None = None) -> DataFrame:
    """One table of all parts, written one after the other, so that no more than one part's shuffles are on disk."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or shared_folder(spark, name)
        with no_shuffle_left(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path, partitionBy=by)
    return spark.read.schema(schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of :func:`staged` that nothing will read again."""
    context = table.sparkSession.sparkContext
    for file in table.inputFiles()[:1]:
        folder = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "=" in folder.getName():  # of a table written by a column
            folder = folder.getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
