"""Cosines of very many pairs, without rows that hold the vectors of two records.

A join would copy both vectors to each pair, which is kilobytes a pair. Here references are written in parts, which
tasks read from their files, so their vectors are never shuffled; the vectors of a query go once to each part in which
it has pairs, these as an array beside them, and a task that holds a part's vectors multiplies. Sums run in the order of buckets, as in :func:`kinmatch.functions.similarity.sparse_cosine`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.functions.similarity import flat
from kinmatch.sources.files import open_fs

#: References of a part, about; their vectors are held by a task.
PART_ROWS = 1 << 15
#: Pairs of a batch of results, about.
OUT_ROWS = 1 << 15
_HELD = ["rid", "eid", "candidate_source", "rname", "name_vector", "address_vector"]


def parts_of(rows: int) -> int:
    return max(1, -(-rows // PART_ROWS))


def part_of(parts: int) -> Column:
    """The part of a reference, by its ``rid``."""
    return F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int")


def files_of(references: DataFrame) -> dict[int, list[str]]:
    """The files of each part, of a table written by ``part``."""
    found: dict[int, list[str]] = {}
    for file in sorted(references.inputFiles()):
        found.setdefault(int(re.search(r"/part=(\d+)/", file)[1]), []).append(file)
    return found


class Vectors:
    """Packed vectors of many records, in an order if one is given."""

    def __init__(self, packed: pa.StructArray, order: np.ndarray | None = None):
        self.size, self.at = flat(packed.field("i"), "<i4")
        self.value = flat(packed.field("v"), "<f8")[1]
        self.start = np.cumsum(self.size) - self.size
        if order is not None:
            self.size, self.start = self.size[order], self.start[order]

    def products(self, at: np.ndarray, value: np.ndarray, rows: np.ndarray, space: np.ndarray) -> np.ndarray:
        """Of one vector with those of the rows, NaN where either is empty. ``space`` has a zero for each bucket."""
        size = self.size[rows]
        if not len(at):
            return np.full(len(rows), np.nan)
        owner = np.repeat(np.arange(len(rows)), size)
        met = np.arange(len(owner)) + np.repeat(self.start[rows] - (np.cumsum(size) - size), size)
        space[at] = value
        found = np.bincount(owner, weights=space[self.at[met]] * self.value[met], minlength=len(rows))
        space[at] = 0
        return np.where(size > 0, np.clip(found, 0, 1), np.nan)


class Part:
    """The references of a part."""

    def __init__(self, files: list[str]):
        tables = []
        for file in files:
            fs, path = open_fs(file)
            tables.append(pq.read_table(path, filesystem=fs, partitioning=None, columns=_HELD))
        table = pa.concat_tables(tables).combine_chunks()
        rids = table.column("rid").to_numpy()
        order = np.argsort(rids)
        self.rids = rids[order]
        self.told = table.select(["eid", "candidate_source", "rname"]).take(pa.array(order))
        self.vectors = [Vectors(table.column(c).chunk(0), order) for c in _HELD[-2:]]

    def places(self, rids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows, by rid, of those that are here, and which are."""
        at = np.minimum(np.searchsorted(self.rids, rids), len(self.rids) - 1)
        here = self.rids[at] == rids
        return at[here], here


def _multiply(bits: int, files: dict[int, list[str]]):
    def answers(part: Part, asked: pa.RecordBatch, space: np.ndarray) -> Iterator[pa.RecordBatch]:
        mine = [Vectors(asked.column(asked.schema.get_field_index(c))) for c in ("x", "y")]
        met = asked.column(asked.schema.get_field_index("met"))
        many, listed = np.asarray(met.value_lengths()), met.flatten()
        every, marked = np.asarray(listed.field("rid")), np.asarray(listed.field("marks"))
        stops = np.cumsum(many)
        begin = 0
        while begin < len(many):
            stop = max(begin + 1, int(np.searchsorted(stops, (stops[begin - 1] if begin else 0) + OUT_ROWS, side="right")))
            query, row, marks, products = [], [], [], ([], [])
            for k in range(begin, stop):
                own = slice(stops[k] - many[k], stops[k])
                rids, group = np.unique(every[own], return_inverse=True)
                united = np.zeros(len(rids), np.int32)
                np.bitwise_or.at(united, group, marked[own])
                rows, here = part.places(rids)
                marks.append(united[here])
                query.append(np.full(len(rows), k))
                row.append(rows)
                for q, r, out in zip(mine, part.vectors, products, strict=True):
                    own = slice(q.start[k], q.start[k] + q.size[k])
                    out.append(r.products(q.at[own], q.value[own], rows, space))
            query, row = np.concatenate(query), np.concatenate(row)
            told = part.told.take(pa.array(row))
            cosines = [pa.array(np.concatenate(x), pa.float64(), from_pandas=True) for x in products]  # NaN is null
            name, sid = (asked.column(asked.schema.get_field_index(c)).take(pa.array(query)) for c in ("qname", "sid"))
            columns = [sid, pa.array(part.rids[row]), name, *(c.combine_chunks() for c in told.columns), *cosines, pa.array(np.concatenate(marks))]
            yield pa.RecordBatch.from_arrays(columns, names=["sid", "rid", "qname", "eid", "candidate_source", "rname", "nc", "ac", "marks"])
            begin = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by part."""
        number, part, space = None, None, np.zeros(1 << bits)
        for batch in batches:
            own = batch.column("part").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else []
            for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True):
                if own[a] != number:
                    number, part = int(own[a]), None  # the one before goes first
                    part = Part(files[number]) if number in files else None
                if part is not None:
                    yield from answers(part, batch.slice(a, b - a), space)

    return run


def of_pairs(references: DataFrame, parts: int, queries: DataFrame, pairs: DataFrame, bits: int) -> DataFrame:
    """``sid, rid, qname, eid, candidate_source, rname, nc, ac, marks`` of distinct pairs; a cosine with an empty vector is null.

    ``references`` are ``rid, eid, candidate_source, rname, name_vector, address_vector``, written by ``part`` (of
    :func:`part_of` so many ``parts``), ``queries`` ``sid, qname, qn, qa``, ``pairs`` ``sid, rid, marks``, which may
    repeat: marks are bits, and a pair has those of all its rows.
    """
    # the queries of a part are dealt to no more tasks than keep the cores busy: each of them holds the whole part
    salts = max(1, -(-2 * references.sparkSession.sparkContext.defaultParallelism // parts))
    kinds = dict(references.dtypes) | dict(queries.dtypes)
    met = pairs.groupBy("sid", part_of(parts).alias("part")).agg(F.collect_set(F.struct(F.col("rid").cast("long").alias("rid"), F.col("marks").cast("int").alias("marks"))).alias("met"))
    asked = met.join(queries.select("sid", "qname", "qn", "qa").hint("merge"), "sid").select("part", (F.col("part") * salts + F.pmod(F.xxhash64("sid"), F.lit(salts))).alias("cell"), "sid", "qname", "met", F.col("qn").alias("x"), F.col("qa").alias("y"))
    dealt = asked.repartition(parts * salts, "cell").sortWithinPartitions("part")
    found = ", ".join(f"{c} {kinds[c]}" for c in ("sid", "rid", "qname", "eid", "candidate_source", "rname"))
    return dealt.select("part", "sid", "qname", "met", "x", "y").mapInArrow(_multiply(bits, files_of(references)), f"{found}, nc double, ac double, marks int")
