"""The best references of each query by BM25 over full posting lists.

A posting list as rows makes a row of each token that a query and a reference share, which grows with the
product of both. Here references are dealt to parts, each part meets every query, and a task adds up the
weights of a query's posting lists as arrays: nothing is cut, and only the best of each part are rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: References of a part at most, about; their posting lists are held by a task.
PART_ROWS = 1 << 16
_TERMS = "array<struct<kind:string,term:string,w:double>>"


def _joined(kinds: pa.Array, terms: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(kinds, terms, "\x1f")


class Postings:
    """Lists of the references of a part: places by term, and by class."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.rids = table.column("rid").to_numpy()
        self.norm = table.column("norm").to_numpy()
        terms = table.column("terms").combine_chunks()
        owner = np.repeat(np.arange(len(terms), dtype=np.int32), pc.list_value_length(terms).to_numpy())
        flat = terms.flatten()
        coded = _joined(flat.field("kind"), flat.field("term")).dictionary_encode()
        codes = coded.indices.to_numpy()
        self.at = owner[np.argsort(codes, kind="stable")]
        self.ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        self.code = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        classes = table.column("classes").combine_chunks()
        of = np.repeat(np.arange(len(classes)), pc.list_value_length(classes).to_numpy())
        names = np.array(classes.flatten().to_pylist(), dtype=object)
        self.classes = {c: np.bincount(of[names == c], minlength=len(classes)) > 0 for c in set(names.tolist())}
        self.masks: dict[tuple, np.ndarray] = {}

    def places(self, term: str) -> np.ndarray:
        i = self.code.get(term, -1)
        return self.at[self.ends[i - 1] if i else 0 : self.ends[i]] if i >= 0 else self.at[:0]

    def open_to(self, classes: tuple) -> np.ndarray:
        """References of any of the classes."""
        if classes not in self.masks:
            found = [self.classes[c] for c in classes if c in self.classes]
            self.masks[classes] = np.logical_or.reduce(found) if found else np.zeros(len(self.rids), bool)
        return self.masks[classes]

    def sums(self, terms: list[dict]) -> np.ndarray:
        """The weights of the terms that each reference has; above zero where it has one."""
        lists = [self.places(f"{t['kind']}\x1f{t['term']}") for t in terms]
        if not lists:
            return np.zeros(len(self.rids))
        weights = np.repeat([t["w"] for t in terms], [len(x) for x in lists])
        return np.bincount(np.concatenate(lists), weights=weights, minlength=len(self.rids))

    def best(self, at: np.ndarray, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``n`` best, ties to the lowest rid."""
        score = np.round(sums[at] * self.norm[at], 9)
        if len(at) > n:
            kept = score >= np.partition(score, len(at) - n)[len(at) - n]
            at, score = at[kept], score[kept]
        order = np.lexsort((self.rids[at], -score))[:n]
        return at[order], score[order]


def _answers(row: dict, lists: Postings, n: int, by_key: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Of a query, each group with its best references: fields, or the channels of its keys."""
    mine = lists.open_to(tuple(row["classes"]))
    fields = {f: lists.sums([t for t in row["terms"] if t["kind"] == f]) for f in dict.fromkeys(t["kind"] for t in row["terms"])}
    if not by_key:
        for field, sums in fields.items():
            yield field, *lists.best(np.flatnonzero((sums > 0) & mine), sums, n)
    elif fields:
        sums = sum(fields.values())
        for channel in dict.fromkeys(k["channel"] for k in row["keys"]):
            at = np.unique(np.concatenate([lists.places(f"key {channel}\x1f{k['key']}") for k in row["keys"] if k["channel"] == channel]))
            yield channel, *lists.best(at[(sums[at] > 0) & mine[at]], sums, n)


def _answer(n: int, by_key: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell, in a cell the references first."""
        cell, held, lists = None, [], None
        for batch in batches:
            cells, asks = batch.column("cell").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])]))
            for a, b in zip(cuts, [*cuts[1:], len(cells)], strict=True):
                part = batch.slice(a, b - a)
                if cells[a] != cell:
                    cell, held, lists = cells[a], [], None
                if not asks[a]:
                    held.append(part.select(["rid", "norm", "classes", "terms"]))
                    continue
                if lists is None:
                    if not held:
                        continue
                    lists, held = Postings(pa.Table.from_batches(held)), []
                for start in range(0, len(part), 500):
                    sids, groups, rids, scores = [], [], [], []
                    for row in part.slice(start, 500).select(["sid", "classes", "terms", "keys"]).to_pylist():
                        for group, at, score in _answers(row, lists, n, by_key):
                            sids += [row["sid"]] * len(at)
                            groups += [group] * len(at)
                            rids.append(lists.rids[at])
                            scores.append(score)
                    if sids:
                        yield pa.RecordBatch.from_arrays([pa.array(sids), pa.array(groups), pa.array(np.concatenate(rids)), pa.array(np.concatenate(scores))], names=["sid", "g", "rid", "score"])

    return run


def best(references: DataFrame, queries: DataFrame, n: int, by_key: bool) -> DataFrame:
    """``sid, g, rid``: the ``n`` best of each group by BM25 over the matched tokens, ties to the lowest ``rid``.

    ``references`` are ``rid, classes, tokens, keys``, ``queries`` ``sid, classes, asked, keys``. Groups are
    fields, each by its own tokens; or, with ``by_key``, the channels of a query's keys, among the references
    that share one, by all tokens.
    """
    spark = references.sparkSession
    length = F.size("tokens") + F.size("keys") + 1
    rows, mean = references.agg(F.count(F.lit(1)), F.avg(length)).first()
    parts = max(1, -(-rows // PART_ROWS))
    # the queries of a part are dealt to no more tasks than keep the cores busy: each of them holds the whole part
    salts = max(1, -(-2 * spark.sparkContext.defaultParallelism // parts))
    present = references.select(F.explode("tokens").alias("t")).select("t.*").groupBy("field", "token").agg(F.count(F.lit(1)).alias("n"))
    idf = F.greatest(F.log((F.lit(rows) - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))
    weighed = queries.select("sid", F.explode("asked").alias("t")).select("sid", "t.*").join(present.hint("merge"), ["field", "token"])
    terms = weighed.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct(F.col("field").alias("kind"), F.col("token").alias("term"), idf.alias("w")))).alias("terms"))
    keyed = F.transform("keys", lambda k: F.struct(F.concat(F.lit("key "), k["channel"]).alias("kind"), k["key"].alias("term"), F.lit(0.0).alias("w")))
    plain = F.transform("tokens", lambda t: F.struct(t["field"].alias("kind"), t["token"].alias("term"), F.lit(0.0).alias("w")))
    norm = 2.2 / (1 + 1.2 * (0.25 + 0.75 * length / F.lit(mean)))
    no_keys = F.array().cast("array<struct<channel:string,key:string>>")
    held = references.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.pmod(F.xxhash64("rid"), F.lit(parts)) * salts + i)).alias("cell"), F.lit(False).alias("asks"), "rid", norm.alias("norm"), F.lit(None).cast("string").alias("sid"), "classes",
        (F.concat(plain, keyed) if by_key else plain).cast(_TERMS).alias("terms"), no_keys.alias("keys"),
    )
    asked = queries.join(terms.hint("merge"), "sid").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: i * salts + F.pmod(F.xxhash64("sid"), F.lit(salts)))).alias("cell"), F.lit(True).alias("asks"), F.lit(None).cast("long").alias("rid"), F.lit(None).cast("double").alias("norm"), "sid", "classes",
        F.col("terms").cast(_TERMS).alias("terms"), F.col("keys") if by_key else no_keys.alias("keys"),
    )
    dealt = held.union(asked).repartition(parts * salts, "cell").sortWithinPartitions("cell", "asks")
    found = dealt.mapInArrow(_answer(n, by_key), "sid string, g string, rid long, score double")
    w = Window.partitionBy("sid", "g").orderBy(F.col("score").desc(), "rid")
    return found.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).select("sid", "g", "rid")
