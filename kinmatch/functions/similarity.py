"""Similarities of two text columns. Null where either side is empty: no evidence isn't evidence against."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import DoubleType

from kinmatch.functions.text import grams, words


def both(a: Column, b: Column, value: Column) -> Column:
    return F.when((a != "") & (b != ""), value)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    return both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def edit_distance(a: Column, b: Column) -> Column:
    return both(a, b, F.levenshtein(a, b))


def _set_ratio(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def word_jaccard(a: Column, b: Column) -> Column:
    return _set_ratio(words(a), words(b))


def gram_jaccard(a: Column, b: Column) -> Column:
    return _set_ratio(grams(a), grams(b))


def exact(a: Column, b: Column) -> Column:
    return both(a, b, (a == b).cast("double"))


def length_ratio(a: Column, b: Column) -> Column:
    return both(a, b, F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b)))


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two strings with characters."""
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    met: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                met.append(c)
                break
    if not met:
        return 0.0
    swaps = sum(x != y for x, y in zip(met, (c for c, f in zip(b, free, strict=True) if not f), strict=True)) // 2
    m = len(met)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro with up to four equal first characters rewarded, where it is above 0.7."""
    value = jaro(a, b)
    if value <= 0.7:
        return value
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return value + 0.1 * prefix * (1 - value)


@pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_of(x, y) if x and y else None for x, y in zip(a, b, strict=True)], dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != ""), _jaro_winkler(a, b))


@pandas_udf(DoubleType())
def _sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y, autojunk=False).ratio() if x and y else None for x, y in zip(a, b, strict=True)], dtype="float64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity, for small sets of pairs."""
    return F.when((a != "") & (b != ""), _sequence_ratio(a, b))


def flat(packed: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in each row of packed ones, and all of them in a row."""
    width, offsets, data = np.dtype(kind).itemsize, packed.buffers()[1], packed.buffers()[2]
    if not len(packed) or data is None:
        return np.zeros(len(packed), np.int64), np.zeros(0, kind)
    at = np.frombuffer(offsets, np.int32)[packed.offset : packed.offset + len(packed) + 1]
    return np.diff(at) // width, np.frombuffer(data, kind, count=int(at[-1] - at[0]) // width, offset=int(at[0]))


@arrow_udf(DoubleType())
def _dot(ia: pa.Array, va: pa.Array, ib: pa.Array, vb: pa.Array) -> pa.Array:
    (na, xa), (nb, xb) = flat(ia, "<i4"), flat(ib, "<i4")
    wa, wb = flat(va, "<f8")[1], flat(vb, "<f8")[1]
    if not len(xa) or not len(xb):
        return pa.array(np.zeros(len(ia)))
    # a row's buckets ascend, so all keys do, and each is looked up in the other side's
    ka, kb = ((np.repeat(np.arange(len(n)), n) << 32) | x for n, x in ((na, xa), (nb, xb)))
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    met = kb[at] == ka
    return pa.array(np.bincount(ka[met] >> 32, weights=wa[met] * wb[at[met]], minlength=len(ia)).astype(float))


def sparse_cosine(a: str, b: str) -> Column:
    """Of two packed unit vectors ``struct<i: binary, v: binary>``: their product, in [0, 1]."""
    product = _dot(F.col(f"{a}.i"), F.col(f"{a}.v"), F.col(f"{b}.i"), F.col(f"{b}.v"))
    return F.when((F.octet_length(f"{a}.i") > 0) & (F.octet_length(f"{b}.i") > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), product)))
