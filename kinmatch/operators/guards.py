"""Checks that fail loudly before anything is written."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.sources.staging import no_shuffle_left


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks columns {absent}")
    return df


def forbid_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    clash = sorted(set(columns) & set(df.columns))
    if clash:
        raise ValueError(f"{what} already has columns {clash}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def forbid(df: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    """Raise if any row meets a condition, naming one; all conditions are looked for in one pass."""
    row = F.to_json(F.struct(*df.columns))
    with no_shuffle_left(df.sparkSession):
        found = df.agg(*[F.min(F.when(condition, row)).alias(f"c{i}") for i, (condition, _) in enumerate(checks)]).first()
    for value, (_, message) in zip(found, checks, strict=True):
        if value is not None:
            raise ValueError(f"{message}: {value}")
    return df


def require_unique(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    again = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    forbid(again, (F.col("n") > 1, f"{what} repeats"))
    return df


def require_keys(df: DataFrame, keys: DataFrame, columns: list[str], message: str) -> DataFrame:
    """Every row's key must be among the keys: an anti join that must come out empty."""
    forbid(df.join(keys, columns, "left_anti").select(*columns), (F.lit(True), message))
    return df
