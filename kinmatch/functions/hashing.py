"""Hashes: term buckets, the split of queries, digests of files."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType


def _blake(text: str, order: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), order)


def term_bucket(term: str, bits: int, hash_fn: str = "blake2b") -> int:
    """A term's bucket: BLAKE2b to 64 bits, read from its low end, or ``md5`` to 60 bits, which SQL has too."""
    number = int(hashlib.md5(term.encode()).hexdigest()[:15], 16) if hash_fn == "md5" else _blake(term, "little")
    return number % (1 << bits)


def split_share(seed: int, country: str, has_match: bool, sid: str) -> float:
    """A query's place in [0, 1): BLAKE2b to 64 bits, read from its high end."""
    return _blake(f"{seed}|{country}|{int(has_match)}|{sid}", "big") / 2.0**64


def in_validation(sid: Column, country: Column, has_match: Column, seed: int, fraction: float, hash_fn: str = "blake2b") -> Column:
    """Whether a query belongs to the validation split; a property of the query, never of a pair."""
    if hash_fn == "md5":
        key = F.concat_ws("|", F.lit(str(seed)), country, has_match.cast("int").cast("string"), sid)
        return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(16**13)) < fraction

    @pandas_udf(BooleanType())
    def drawn(sids: pd.Series, countries: pd.Series, matched: pd.Series) -> pd.Series:
        return pd.Series([split_share(seed, c, m, s) < fraction for s, c, m in zip(sids, countries, matched, strict=True)])

    return drawn(sid, country, has_match)


def file_sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def file_identity(path: str | Path) -> dict:
    at = Path(path).resolve()
    return {"path": str(at), "size": at.stat().st_size, "mtime_ns": at.stat().st_mtime_ns}
