"""Writers. Tables are Parquet, committed whole; text exports and reports appear under their name when complete."""

from __future__ import annotations

import gzip
import json
import os
import shutil
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


_TSV = {"sep": "\t", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_tsv_folder(df: DataFrame, path: str, compression: str | None = None, header: bool = True) -> None:
    """Tab-separated part files: what a large export is."""
    df.write.mode("overwrite").options(header=header, **_TSV).option("compression", compression or "none").csv(path)


def write_tsv(df: DataFrame, path: str, order_by: list[str] | None = None) -> int:
    """One file, gzip by its name, for results that are handed in as one. Tasks write sorted parts beside
    it; their bytes are then put one after the other, so no row passes through the driver's Python."""
    seen, parts, partial = Observation(), Path(f"{path}.parts"), Path(f"{path}.partial")
    ordered = (df.orderBy(*order_by) if order_by else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    packed = path.endswith(".gz")
    write_tsv_folder(ordered, parts.absolute().as_uri(), "gzip" if packed else None, header=False)
    head = ("\t".join(df.columns) + "\n").encode()
    with partial.open("wb") as out:
        out.write(gzip.compress(head) if packed else head)
        for part in sorted(parts.glob("part-*")):
            with part.open("rb") as f:
                shutil.copyfileobj(f, out, 1 << 20)
    shutil.rmtree(parts)
    os.replace(partial, path)
    return int(seen.get["rows"])


def write_json(value, path: str) -> None:
    partial = Path(f"{path}.partial")
    partial.write_text(json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False, sort_keys=True), encoding="utf-8")
    partial.replace(path)


def write_cleaned(df: DataFrame, raw_columns: list[str], path: str) -> None:
    """Raw columns as they came, then the derived ones by name."""
    write_tsv_folder(df.select(*raw_columns, *sorted(c for c in df.columns if c not in raw_columns)), path, "gzip")


def zip_files(files: dict[str, str], path: str) -> None:
    """A new ZIP file; one that exists is never overwritten."""
    with open(path, "xb") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for name, source in sorted(files.items()):
            z.write(source, name)
