"""What several operators share: written tables, shared files, word hashing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes A-Z map to a-z, every other byte to itself.
ASCII_LOWER = bytes(range(256)).lower()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``, which driver and executors share.

    Only where the session has no such setting (a local test) is a temporary folder made and
    set; it goes when the process ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="kinmatch-")
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)  # without a scheme it lies in the cluster's default file system
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path)
    return f"{whole.toString().rstrip('/')}/kinmatch/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage.

    The rows outlive any executor, and what is read later is what was counted earlier even
    where a plan is not deterministic.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table of :func:`write_table` that nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever it has."""
    name = f"__{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def spread_join(rows: DataFrame, facts: DataFrame, key: str, how: str = "left", *, salts: int = 32, share: int = 1000) -> DataFrame:
    """``rows`` joined to ``facts`` (one row a key), with keys of many rows dealt to ``salts`` tasks.

    A key is hot if it has more than one row in ``share``, so there are fewer than ``share`` hot keys
    whatever the input, and they can be broadcast. The salt is a hash of the row, so a task that runs
    again deals alike. Nulls meet nothing.
    """
    n = rows.count()
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") * share > max(n, share * 100)).select(key, F.lit(True).alias("__hot"))
    hot = write_table(hot, "hot-keys")
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(salts))).otherwise(0).cast("int")).drop("__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = facts.join(F.broadcast(hot), key, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return dealt.join(copied, [key, "__salt"], how).drop("__salt")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared URI, for tasks that read or write bytes themselves."""
    fs, path = pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs, path


def put_file(uri: str, data: bytes) -> None:
    """Write a file whole under its final name: a temporary name first, then a rename."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


def get_file(uri: str) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text, none for null."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def slices(batches, rows: int = 256):
    """The batches in slices of few rows, so that texts aren't all Python objects, or results all held, at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_views(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column's rows; a null gives no bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, as unsigned integers."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling; the result is shorter by width - 1."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, .. `` for each start and length, in one array."""
    if not len(starts):
        return np.zeros(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - begin, lengths)


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours, and the length at the end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def whole_runs(batches, key: int = 0):
    """Batches sorted by a column, cut anew so that no run of equal keys spans two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != batch.column(key)[0].as_py():
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        starts = runs(keys)
        last = int(starts[-2])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
