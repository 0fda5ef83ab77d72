"""Readers of record files. Schemas are fixed: ids and leading zeros survive."""

from __future__ import annotations

import re
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmatch.functions.constants import RAW_COLUMNS, TRUTH_COLUMNS

SOURCE_FILE = re.compile(r"(?:.*/)?(train|test)_source([123])\.tsv(?:\.gz)?$")
TRUTH_FILE = "train_ground_truth.tsv"
#: What a sample takes along of other files: code, templates and notes.
EXTRA_SUFFIXES = (".py", ".csv", ".md", ".txt")


def strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str | list[str], columns=None) -> DataFrame:
    """A tab-separated file: quotes and line ends in fields honoured, a byte order mark dropped, rows
    that are too short or too long refused, empty fields as empty strings.

    Without ``columns`` the header names them. A gzip file, or one with line ends in fields, is one task:
    its rows are dealt out afterwards.
    """
    paths = [path] if isinstance(path, str) else path
    packed = any(p.endswith(".gz") for p in paths)
    # a line with an odd number of quotes begins or ends a field of several lines; without one, files can be split
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    whole = packed or bool(spark.read.text(paths).filter(quotes % 2 == 1).take(1))
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": whole, "mode": "FAILFAST", "enforceSchema": False}
    names = columns or header_of(spark, paths[0])
    frame = spark.read.schema(strings(names)).options(**options).csv(paths)
    return (frame.repartition(spark.sparkContext.defaultParallelism) if whole else frame).fillna("")


def header_of(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return first[0].lstrip("﻿").rstrip("\r").split("\t")


def select_required(df: DataFrame, columns, what: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks columns {absent}")
    return df.select(*columns)


class Inputs:
    """A folder or a ZIP file of record files. Members of a ZIP file are unpacked to ``staging``, which
    Spark can read; resource forks of archivers are left out; each name may occur once."""

    def __init__(self, location: str, staging: str | None = None):
        at = Path(location)
        if not at.exists():
            raise ValueError(f"{location} doesn't exist")
        self.files: dict[str, str] = {}
        if at.is_dir():
            for p in sorted(at.rglob("*")):
                if p.is_file() and "__MACOSX" not in p.parts:
                    self._add(p.name, str(p))
        else:
            if staging is None:
                raise ValueError("a ZIP file needs a staging folder")
            with zipfile.ZipFile(at) as z:
                for info in z.infolist():
                    if info.is_dir() or "__MACOSX" in info.filename.split("/"):
                        continue
                    target = Path(staging) / Path(info.filename).name
                    if self._wanted(target.name) and self._add(target.name, str(target)):
                        target.parent.mkdir(parents=True, exist_ok=True)
                        with z.open(info) as a, target.open("wb") as b:
                            while block := a.read(1 << 20):
                                b.write(block)

    @staticmethod
    def _wanted(name: str) -> bool:
        return bool(SOURCE_FILE.match(name)) or name.endswith((".tsv", ".tsv.gz", *EXTRA_SUFFIXES))

    def _add(self, name: str, path: str) -> bool:
        if (SOURCE_FILE.match(name) or name == TRUTH_FILE) and name in self.files:
            raise ValueError(f"{name} occurs more than once")
        self.files[name] = path
        return True

    def require(self, splits=("train", "test"), truth: bool = True) -> Inputs:
        wanted = [f"{s}_source{n}" for s in splits for n in (1, 2, 3)]
        absent = [w for w in wanted if not any(f.startswith(w + ".tsv") for f in self.files)] + ([TRUTH_FILE] if truth and TRUTH_FILE not in self.files else [])
        if absent:
            raise ValueError(f"missing input files: {absent}")
        return self

    def source(self, split: str, number: int) -> str:
        found = [p for n, p in self.files.items() if n in (f"{split}_source{number}.tsv", f"{split}_source{number}.tsv.gz")]
        if len(found) != 1:
            raise ValueError(f"expected one file {split}_source{number}.tsv[.gz], found {len(found)}")
        return found[0]

    def truth(self) -> str:
        if TRUTH_FILE not in self.files:
            raise ValueError(f"expected one file {TRUTH_FILE}")
        return self.files[TRUTH_FILE]

    def extras(self) -> dict[str, str]:
        return {n: p for n, p in self.files.items() if n.endswith(EXTRA_SUFFIXES)}

    def sizes(self) -> dict[str, int]:
        return {n: Path(p).stat().st_size for n, p in self.files.items()}


def raw_records(spark: SparkSession, inputs: Inputs, split: str, number: int) -> DataFrame:
    frame = read_tsv(spark, inputs.source(split, number))
    select_required(frame, RAW_COLUMNS, f"{split}_source{number}")
    return frame


def truth(spark: SparkSession, path: str) -> DataFrame:
    return select_required(read_tsv(spark, path), TRUTH_COLUMNS, "the ground truth")


def probabilities(spark: SparkSession, path: str) -> DataFrame:
    """Scores from Parquet or TSV, by the file's name."""
    if path.rstrip("/").endswith(".parquet") or Path(path).is_dir():
        return spark.read.parquet(path)
    return read_tsv(spark, path, ["source1_entity_id", "candidate_entity_id", "match_probability"])
