"""Connected components of links, by contraction in rounds.

Each round points every node at the smallest node it is linked to, shortens the pointers twice and
replaces links by links between what their ends point at. At least half of the nodes that still
have links go in a round. Each round is a written table; nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import drop_table, write_table


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As many links as connect the same nodes: each node with the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(x, y)
        np.minimum.at(root, np.maximum(x, y), low)
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        left = x != y
        x, y = x[left], y[left]
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def spanning(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning forest of the links, of links that are among them (weights under 64).

    Boruvka's rounds over links in one order, by weight and then by their ends; so the links of at most
    any weight connect the same nodes in the forest as in the whole, and equal groups give equal links.
    """
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)].astype(np.uint64), ends[len(a) :].astype(np.uint64)
    packed = np.unique(weight.astype(np.uint64) << np.uint64(58) | np.minimum(x, y) << np.uint64(29) | np.maximum(x, y))
    low = np.uint64((1 << 29) - 1)
    x, y = (packed >> np.uint64(29) & low).astype(np.int64), (packed & low).astype(np.int64)
    label, left, chosen = np.arange(len(nodes)), np.flatnonzero(x != y), []
    while len(left):
        best = np.full((2, len(nodes)), len(packed))
        best[0, label[x[left[::-1]]]] = left[::-1]  # of repeated places the last is kept: the lightest link
        best[1, label[y[left[::-1]]]] = left[::-1]
        picked = np.unique(best.min(axis=0))
        picked = picked[picked < len(packed)]
        chosen.append(picked)
        moved, root = forest(label[x[picked]], label[y[picked]])
        to = np.arange(len(nodes))
        to[moved] = root
        label = to[label]
        left = left[label[x[left]] != label[y[left]]]
    at = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
    return nodes[x[at]], nodes[y[at]], (packed[at] >> np.uint64(58)).astype(np.int64)


def forest_of_batches(batches: Iterator[pa.RecordBatch], reduce=forest) -> Iterator[pa.RecordBatch]:
    """Links (int64 columns) of a task, reduced to a forest whenever many have come together."""
    held: list[list[np.ndarray]] = []
    size, names = 0, []

    def made(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def reduced() -> list[np.ndarray]:
        return list(reduce(*(np.concatenate(c) for c in zip(*held, strict=True))))

    for batch in batches:
        names = batch.schema.names
        held.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size > 500_000:
            held, size = [reduced()], 0
            if len(held[0][0]) > 250_000:
                yield made(held[0])
                held = []
    if held:
        found = reduced()
        if len(found[0]):
            yield made(found)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that has a link, ``root`` being one node of its component."""
    links = write_table(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    layers: list[DataFrame] = []
    while links.limit(1).count():
        both = links.union(links.select("b", "a")).toDF("node", "other")
        point = write_table(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("to")), "pointers")
        for _ in range(2):
            further = point.select(F.col("node").alias("n2"), F.col("to").alias("to2"))
            jumped = write_table(point.join(further, F.col("to") == F.col("n2"), "left").select("node", F.coalesce("to2", "to").alias("to")), "pointers")
            drop_table(point)
            point = jumped
        layers.append(point)
        ends = point.select(F.col("node").alias("n"), F.col("to").alias("t"))
        moved = links.join(ends, F.col("a") == F.col("n")).select(F.col("t").alias("a"), "b").join(ends, F.col("b") == F.col("n")).select("a", F.col("t").alias("b"))
        fewer = write_table(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        drop_table(links)
        links = fewer
    if not layers:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = layers[-1].select("node", F.col("to").alias("root"))
    for layer in reversed(layers[:-1]):
        above = found.select(F.col("node").alias("n"), "root")
        found = layer.join(above, F.col("to") == F.col("n"), "left").select("node", F.coalesce("root", "to").alias("root"))
    return found
