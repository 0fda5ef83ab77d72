"""SimHash near duplicates by the general pigeonhole principle.

A fingerprint's bits are grouped into parts, correlated bits together. If two fingerprints differ
in at most ``distance`` bits and the parts have thresholds that sum to ``distance - parts + 1``
(-1 leaves a part out), then in some part they differ in no more than its threshold. Thresholds,
and the number of parts, come from a dynamic programme over estimated costs: signatures written,
and pairs compared as the bits' statistics over all fingerprints predict them. A fingerprint writes
its own value of a part, and as probes the values within the threshold; rows that share a value
meet in one bucket, where each pair of a probe and an own value is verified on all bits.

Buckets report a spanning forest of what they found, not pairs, so a large group of near copies
costs links in proportion to its members. Equal fingerprints are one node from the start. A bucket of
very many rows is dealt to many tasks in tiles: its rows by its own values.

Where a similarity is asked for, nodes are sets of distinct shingles, the forest is a minimum one by
differing bits, made of pairs that were found, and each of its links is held to the two sets. Where
links fail, they may stand for pairs that the forest left out. So the nodes that found pairs connect,
a family, are compared set by set wherever good links don't join them yet: in cells of two tiles of a
family, which count common shingles by an index of the cell and report a spanning forest, not pairs.
Only a family that is both larger than a tile and thinly connected has its found pairs listed instead:
fewer than one in ``CELL`` of all that it could have. So groups are those of all found pairs, whatever
the order by bits.

Defined results: a null text, or one without words, has fingerprint zero and is linked like any
other; fewer words than a shingle's are one shingle; a null id takes part but is never the smallest
unless its whole component has none; repeated rows each get a row; an empty table gives no rows; ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import ASCII_LOWER, byte_views, drop_table, fresh_name, mix64, runs, slices, spread_join, stretches, whole_runs, write_table
from kinmatch.llm.components import components, forest, forest_of_batches, spanning

BITS = 64
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: What a written signature costs, counted in comparisons.
ROW_COST = 100
#: The longest bucket that is compared by shifting whole columns against themselves.
SHORT = 24
#: Rows of a bucket from which it is dealt in tiles, as one row in ``HOT_SAMPLE`` tells.
BUCKET_ROWS, HOT_SAMPLE = 1 << 17, 64
#: Nodes, and shingles, that a tile of a family has at most, as expected.
CELL, CELL_SHINGLES = 1024, 4_000_000


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(words: list[bytes], width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``width`` words, or of all words where there are fewer."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(width, n)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: n - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)), dtype=np.uint64, count=n - width + 1)


def majority(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    raw = np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    if n < 128:
        ones = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        tally = np.zeros((8, 256), np.int64)
        for at in range(0, n, 1 << 20):
            tally += np.bincount((raw[at : at + (1 << 20)] + np.arange(0, 2048, 256, dtype=np.int64)).ravel(), minlength=2048).reshape(8, 256)
        ones = (tally @ _BIT_TABLE).ravel()
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, lanes: int = 1, sets: bool = False) -> DataFrame:
    """``id, f0 .. f{lanes-1}, size``: 64 bits a lane, as signed longs; ``size`` is the number of shingles.

    With ``sets``, of distinct shingles, and ``node``, a hash of all of them, follows.
    """
    names = ["id", *(f"f{i}" for i in range(lanes)), "size", *(["node"] if sets else [])]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            found: list[list[int]] = [[] for _ in range(lanes)]
            sizes, nodes = [], []
            for text in byte_views(batch.column(1)):
                hashes = shingle_hashes(text.translate(ASCII_LOWER).split(), width)
                if sets:
                    hashes = np.unique(hashes)
                    nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sizes.append(len(hashes))
                for i in range(lanes):
                    found[i].append(majority(mix64(hashes + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)) if i else hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in found), pa.array(sizes, pa.int32()), *([_signed(nodes)] if sets else [])], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(make, "id long, " + ", ".join(f"f{i} long" for i in range(lanes)) + ", size int" + ", node long" * sets)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def shingle_sets(docs: DataFrame, *, text_col: str, width: int) -> DataFrame:
    """``node, shingles``: the distinct shingles of a text, as 32 bits of their hashes.

    Two sets of n shingles have about n*n / 2**32 such values in common by chance, a share of
    n / 2**32 of them: a millionth at 4,000 shingles.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(shingle_hashes(text.translate(ASCII_LOWER).split(), width)) for text in byte_views(batch.column(0))]
            shingles = pa.array([np.unique(h.astype(np.uint32)).view(np.int32) for h in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([_signed([xxhash.xxh64_intdigest(h.tobytes()) for h in found]), shingles], names=["node", "shingles"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(make, "node long, shingles array<int>")


# ---------------------------------------------------------------- plan


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Over all rows of column ``f0``: their number, each bit's share, and all pairs' correlations."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n += len(bits)
            both += (bits.T @ bits).astype(np.int64)
        values = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "n"])

    sums = np.zeros(BITS * BITS + 1, np.int64)
    for row in prints.select("f0").mapInArrow(tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        sums[row["at"]] = row["n"]
    n = int(sums[-1])
    both = sums[:-1].reshape(BITS, BITS) / max(1, n)
    share = both.diagonal()
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return n, share, (both - np.outer(share, share)) / np.outer(spread, spread)


def correlated_parts(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of (nearly) equal size: a part starts with the bit that is most correlated with
    those left and takes in the bits most correlated with it."""
    strength = np.abs(correlation - np.diag(np.diag(correlation)))
    left, out = set(range(len(correlation))), []
    for i in range(parts):
        size = len(left) // (parts - i)
        own = [max(sorted(left), key=lambda b: strength[b, sorted(left)].sum())]
        left.discard(own[0])
        while len(own) < size:
            best = max(sorted(left), key=lambda b: strength[b, own].sum())
            own.append(best)
            left.discard(best)
        out.append(sorted(own))
    return out


def close_share(share: np.ndarray, upto: int) -> float:
    """The estimated share of pairs that differ in at most ``upto`` of bits with these shares."""
    chance = np.zeros(upto + 2)
    chance[0] = 1.0
    for p in share:
        q = 2 * p * (1 - p)
        chance = chance * (1 - q) + np.append(0, chance[:-1]) * q
        chance[-1] = 0
    return float(chance[: upto + 1].sum())


def allocate(n: int, share: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """The cheapest thresholds for parts, by a dynamic programme over the parts and their sum."""
    budget = distance - len(parts) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in parts:
        cost = {-1: 0.0}
        for t in range(min(distance, len(own), 4) + 1):
            cost[t] = ROW_COST * n * sum(comb(len(own), i) for i in range(t + 1)) + float(n) * n * close_share(share[own], t)
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (paid, chosen) in best.items():
            for t, price in cost.items():
                if total + t not in following or paid + price < following[total + t][0]:
                    following[total + t] = (paid + price, [*chosen, t])
        best = following
    return min((v for k, v in best.items() if k >= budget), default=(float("inf"), []))


def plan(n: int, share: np.ndarray, correlation: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The parts with thresholds of at least 0, of the cheapest number of parts."""
    options = []
    for count in range(1, distance + 2):
        parts = correlated_parts(correlation, count)
        cost, thresholds = allocate(max(1, n), share, parts, distance)
        if thresholds:
            options.append((cost, count, [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0]))
    return min(options)[2]


# ---------------------------------------------------------------- buckets


def _masks(width: int, upto: int) -> list[np.uint64]:
    return [np.uint64(sum(1 << i for i in chosen)) for d in range(1, upto + 1) for chosen in combinations(range(width), d)]


def signatures(prints: DataFrame, parts: list[tuple[list[int], int]], lanes: int, sets: bool = False, groups: bool = False) -> DataFrame:
    """``key, own, f0 .., size`` and, of sets, ``node`` (and its ``root``, of groups) for each row: its own value of each part, and its probes."""
    names = ["key", "own", *(f"f{i}" for i in range(lanes)), "size", *(["node"] if sets else []), *(["root"] if groups else [])]
    masks = [_masks(len(bits), t) for bits, t in parts]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f0 = batch.column(0).to_numpy().view(np.uint64)
            for i, (bits, _) in enumerate(parts):
                value = np.zeros(len(f0), np.uint64)
                for j, bit in enumerate(bits):
                    value |= ((f0 >> np.uint64(bit)) & np.uint64(1)) << np.uint64(j)
                for m, mask in enumerate([np.uint64(0), *masks[i]]):
                    # the part's number goes through the bits that its value leaves free
                    key = mix64((value ^ mask) + mix64(np.array([i + 1], np.uint64))) if len(bits) > 56 else (value ^ mask) | np.uint64(i << 56)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(f0), m == 0)), *batch.columns], names=names)

    kinds = ", ".join(f"f{i} long" for i in range(lanes))
    return prints.select(*names[2:]).mapInArrow(write, f"key long, own boolean, {kinds}, size int" + ", node long" * sets + ", root long" * groups)


def dealt_signatures(prints: DataFrame, parts: list[tuple[list[int], int]], lanes: int, sets: bool = False, groups: bool = False, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Signatures by bucket, sorted; those of very large buckets by pairs of tiles, in which a row meets the
    own values of the other tile. Only how rows are dealt hangs on the sample, not which of them meet."""
    rows = signatures(prints, parts, lanes, sets, groups)
    sampled = signatures(prints.filter(F.pmod(F.xxhash64("f0"), F.lit(HOT_SAMPLE)) == 0), parts, lanes, sets, groups)
    tiles = F.ceil(F.count(F.lit(1)) * HOT_SAMPLE / bucket_rows).cast("int")
    hot = write_table(sampled.groupBy("key").agg(tiles.alias("tiles")).filter("tiles > 1"), "hot-buckets")
    n = hot.count()
    if n:
        few = F.broadcast(hot) if n <= 1_000_000 else hot.hint("merge")
        warm = rows.join(few, "key").withColumn("tile", F.pmod(F.xxhash64("f0"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        cell = lambda of, by: F.xxhash64("key", of, by)
        probing = warm.withColumns({"key": cell("tile", "other"), "own": F.lit(False)})
        met = warm.filter("own").withColumn("key", cell("other", "tile"))
        rows = rows.join(few.select("key"), "key", "left_anti").unionByName(probing.unionByName(met).drop("tiles", "tile", "other"))
    return rows.repartition("key").sortWithinPartitions("key")


def _near(x: list[np.ndarray], y: list[np.ndarray], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Which differ in at most ``limit`` bits of all lanes, and in how many."""
    bits = sum(np.bitwise_count(a ^ b) for a, b in zip(x, y, strict=True))
    return bits <= limit, bits


def _bucket_links(limit: int, size_ratio: float, lanes: int, sets: bool = False, groups: bool = False, count: bool = False):
    """Links inside buckets: rows sorted by key come in, a forest of links goes out; with ``sets`` a
    minimum one, with the bits that differ; with ``groups`` all links between rows of two roots, or with
    ``count`` only how many each row has."""

    def reduce(a: np.ndarray, b: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        if groups:
            low, first = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0, return_index=True)
            if count:
                ends, links = np.unique(low[:, 0], return_counts=True)
                return ends, links, links
            return low[:, 0], low[:, 1], bits[first].astype(np.int64)
        return spanning(a, b, bits) if sets else forest(a, b)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            key = table.column(0).to_numpy()
            own = table.column(1).to_numpy()
            f = [table.column(2 + i).to_numpy().view(np.uint64) for i in range(lanes)]
            size = table.column(2 + lanes).to_numpy()
            node = table.column(3 + lanes).to_numpy() if sets else f[0].view(np.int64)
            root = table.column(4 + lanes).to_numpy() if groups else node
            starts = runs(key)
            length = np.diff(starts)
            owned = np.add.reduceat(own.astype(np.int64), starts[:-1]) if len(key) else np.zeros(0, np.int64)
            out: list[tuple[np.ndarray, ...]] = []

            def fits(i, j, size=size):
                return np.minimum(size[i], size[j]) >= size_ratio * np.maximum(size[i], size[j]) if size_ratio else True

            # short buckets, all at once: each row against the next, the one after, and so on
            short = np.repeat((length <= SHORT) & (length > 1) & (owned > 0), length)
            at = np.flatnonzero(short)
            for step in range(1, int(min(SHORT, length.max(initial=1)))):
                at = at[at + step < len(key)]
                at = at[key[at] == key[at + step]]
                if not len(at):
                    break
                i, j = at, at + step
                pick = (own[i] | own[j]) & (root[i] != root[j]) & fits(i, j)
                i, j = i[pick], j[pick]
                near, bits = _near([x[i] for x in f], [x[j] for x in f], limit)
                out.append((node[i[near]], node[j[near]], bits[near]))
            # long buckets, one by one: blocks of rows against the own values, by size
            for k in np.flatnonzero((length > SHORT) & (owned > 0)):
                rows = np.arange(starts[k], starts[k + 1])
                mine = rows[own[rows]]
                mine = mine[np.argsort(size[mine], kind="stable")]
                rows = rows[np.argsort(size[rows], kind="stable")]
                for r in range(0, len(rows), 512):
                    block = rows[r : r + 512]
                    lo, hi = 0, len(mine)
                    if size_ratio:
                        lo = np.searchsorted(size[mine], size[block[0]] * size_ratio, "left")
                        hi = np.searchsorted(size[mine], size[block[-1]] / size_ratio, "right")
                    for c in range(lo, hi, 4096):
                        other = mine[c : min(hi, c + 4096)]
                        near, bits = _near([x[block][:, None] for x in f], [x[other][None, :] for x in f], limit)
                        i, j = np.nonzero(near)
                        bits, i, j = bits[i, j], block[i], other[j]
                        pick = (root[i] != root[j]) & fits(i, j)
                        found = reduce(node[i[pick]], node[j[pick]], bits[pick])
                        if groups:  # pairs of a large bucket aren't held
                            yield made(found)
                            continue
                        out.append(found if sets else (*found, np.zeros(len(found[0]), np.int64)))
            if out and sum(len(o[0]) for o in out):
                found = reduce(*(np.concatenate(c) for c in zip(*out, strict=True)))
                yield made(found)

    def made(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["a", "b", "bits"][: len(found)])

    return links if groups else lambda batches: forest_of_batches(links(batches), spanning if sets else forest)


def linked_sets(links: DataFrame, docs: DataFrame, holders: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """``node, shingles`` of all ends of links. ``holders`` (``node, least``) says which document has a
    node's text; texts of linked nodes alone are fetched."""
    key, body = fresh_name(docs, "key"), fresh_name(docs, "body")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    asked = holders.join(ends.hint("merge"), "node").select(id_key("least").alias(key)).distinct()
    texts = docs.select(id_key(id_col).alias(key), F.col(text_col).alias(body)).join(asked.hint("merge"), key, "left_semi")
    return write_table(shingle_sets(texts, text_col=body, width=width).dropDuplicates(["node"]), "shingle-sets")


def similar_links(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``links`` (``a, b``) whose sets of shingles have at least this Jaccard similarity. Sets move once
    for a link; a node of many links is dealt to many tasks."""
    pairs = spread_join(links.select("a", "b"), sets.toDF("a", "mine"), "a", "inner")
    half = write_table(pairs, "half-pairs")
    whole = spread_join(half, sets.toDF("b", "theirs"), "b", "inner")
    common = F.size(F.array_intersect("mine", "theirs"))
    found = write_table(whole.filter(common >= similarity * (F.size("mine") + F.size("theirs") - common)).select("a", "b"), "similar-links")
    drop_table(half)
    return found


# ---------------------------------------------------------------- families


def _cell_links(similarity: float):
    """A forest of the similar pairs of each cell: all pairs of its rows, or of rows of its two sides.

    Common shingles are counted row by row, through an index of the cell's shingles."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            key, side, node, root = (table.column(i).to_numpy() for i in range(4))
            lists = table.column(4).combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            begin = lists.offsets.to_numpy().astype(np.int64)
            values, size = lists.values.to_numpy(), np.diff(begin)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            bounds = runs(key)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                rows = np.arange(a, b)
                first, second = rows[side[rows] == 0], rows[side[rows] == 1]
                inner = not len(second)
                others = first if inner else second
                at = stretches(begin[others], size[others])
                shingle, owner = values[at], np.repeat(np.arange(len(others)), size[others])
                order = np.argsort(shingle, kind="stable")
                shingle, owner = shingle[order], owner[order]
                for i, row in enumerate(first.tolist()):
                    own = values[begin[row] : begin[row + 1]]
                    low, high = np.searchsorted(shingle, own, "left"), np.searchsorted(shingle, own, "right")
                    common = np.bincount(owner[stretches(low, high - low)], minlength=len(others))
                    met = (common >= similarity * (size[row] + size[others] - common)) & (root[others] != root[row])
                    if inner:
                        met[: i + 1] = False
                    met = others[met]
                    if len(met):
                        out.append((np.full(len(met), node[row]), node[met]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest(*(np.concatenate(c) for c in zip(*out, strict=True)))], names=["a", "b"])

    return lambda batches: forest_of_batches(links(batches))


def family_links(members: DataFrame, sets: DataFrame, similarity: float, cell: int = CELL) -> DataFrame:
    """Similar pairs (a forest of each cell) of families: ``members`` has ``node, root, family`` and, of the
    family, ``n`` and ``shingles_of``, its numbers of nodes and shingles."""
    tiles = F.greatest(F.ceil(F.col("n") / cell), F.ceil(F.col("shingles_of") / CELL_SHINGLES)).cast("int")
    dealt = members.select("node", "root", "family", tiles.alias("tiles")).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    held = dealt.join(sets.hint("merge"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cells = held.select(F.xxhash64("family", F.least("tile", "other"), F.greatest("tile", "other")).alias("key"), (F.col("tile") > F.col("other")).cast("int").alias("side"), "node", "root", "shingles")
    return cells.repartition("key").sortWithinPartitions("key").mapInArrow(_cell_links(similarity), "a long, b long")


def left_out_links(links: DataFrame, good: DataFrame, sets: DataFrame, distinct: DataFrame, parts: list[tuple[list[int], int]], *, lanes: int, total: int, similarity: float, cell: int = CELL) -> DataFrame:
    """Similar pairs of families that good links don't join, from the pairs that forests left out."""
    family = components(links).select("node", F.col("root").alias("family"))
    known = components(good).select("node", F.col("root").alias("known"))
    every = distinct.join(family.hint("merge"), "node").join(known.hint("merge"), "node", "left").withColumn("root", F.coalesce("known", "node")).drop("known", "least")
    every = write_table(every, "families")
    sizes = every.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("long")).alias("shingles_of"), (F.min("root") != F.max("root")).alias("open")).filter("open").drop("open")
    members = write_table(spread_join(every, sizes.select("family", F.struct("n", "shingles_of").alias("of")), "family", "inner").select("*", "of.*").drop("of"), "members")
    drop_table(every)
    large = members.filter(F.col("n") > cell)
    if not large.take(1):
        return write_table(family_links(members, sets, similarity, cell), "family-links")
    # thinly connected ones have fewer found pairs than cells would compare
    lane = [f"f{i}" for i in range(lanes)]
    buckets = lambda rows, count: dealt_signatures(rows.select(*lane, "size", "node", "root"), parts, lanes, True, True).mapInArrow(_bucket_links(total, similarity, lanes, True, True, count), "a long, b long, bits long")
    met = buckets(large, True).groupBy("a").agg(F.sum("bits").alias("pairs")).withColumnRenamed("a", "node")
    thin = spread_join(large.select("node", "family", "n"), met, "node").groupBy("family", "n").agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs")).filter(F.col("pairs") * cell < F.col("n") * F.col("n"))
    thin = write_table(thin.select("family", F.lit(True).alias("thin")), "thin-families")
    parted = write_table(spread_join(members, thin, "family"), "parted")
    listed = write_table(buckets(parted.filter("thin"), False).select("a", "b").distinct(), "other-pairs")
    dense = write_table(family_links(parted.filter("thin IS NULL"), sets, similarity, cell), "family-links")
    return dense.union(similar_links(listed, sets, similarity))


def id_key(column: str):
    """An id as a join key that also meets null."""
    return F.coalesce(F.concat(F.lit("id "), F.col(column).cast("string")), F.lit("null"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, lanes: int = 1, total: int = 0, similarity: float = 0.0, cell: int = CELL
) -> DataFrame:
    """``id, f0.., size, component_id``: the smallest id that links reach, for every row.

    A link is at most ``distance`` differing bits. With a similarity (which ``lanes`` above 1 need),
    fingerprints are of distinct shingles, and a link is a similarity of the sets of at least that: all
    pairs within ``distance`` in the first lane are met, most beyond it also share a bucket, and those of
    them that differ in at most ``total`` bits of all lanes are held to the sets.
    """
    sets, lane = similarity > 0, [f"f{i}" for i in range(lanes)]
    node = "node" if sets else "f0"
    rows = write_table(fingerprints(docs, id_col=id_col, text_col=text_col, width=width, lanes=lanes, **({"sets": True} if sets else {})), "fingerprints")
    distinct = write_table(rows.groupBy(*lane, *(["node"] if sets else [])).agg(F.min("id").alias("least"), F.max("size").alias("size")), "distinct")
    n, share, correlation = bit_statistics(distinct)
    parts = plan(n, share, correlation, distance)
    links = dealt_signatures(distinct, parts, lanes, sets).mapInArrow(_bucket_links(total if sets else distance, similarity, lanes, sets), "a long, b long" + ", bits long" * sets)
    if sets:
        links = write_table(links.select("a", "b").distinct(), "bucket-links")
        shingles = linked_sets(links, docs, distinct.select("node", "least"), id_col=id_col, text_col=text_col, width=width)
        good = similar_links(links, shingles, similarity)
        if good.count() < links.count():
            good = good.union(left_out_links(links, good, shingles, distinct, parts, lanes=lanes, total=total, similarity=similarity, cell=cell))
        links = good
    found = components(links)
    named = distinct.select(F.col(node).alias("own"), "least")
    rooted = write_table(named.join(found, F.col("own") == F.col("node"), "left").select("own", "least", F.coalesce("root", "own").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("root", F.struct("least").alias("whole"))
    labelled = spread_join(rooted, smallest, "root").select("own", F.when(F.col("whole").isNull(), F.col("least")).otherwise(F.col("whole.least")).alias("component_id"))
    drop_table(distinct)
    return rows.join(labelled.withColumnRenamed("own", node), node).select("id", *lane, "size", "component_id")


def simhash_query(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, distance: int = 13, total: int = 32, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; repeated rows once.

    A group hangs together by pairs whose sets of shingles of five words have a similarity of 0.8 or
    more. Pairs are sought by 128 bits: at 0.8 two fingerprints are expected to differ in 19 or 20, with a
    deviation of 4, so 32 is three beyond; parts are planned for 13 of the first 64, where 9.7 are expected.
    No row goes by fingerprints alone.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, width=width, distance=distance, lanes=2, total=total, similarity=similarity)
    # both sides grow with the corpus, so neither is broadcast; one key deals rows for the join and
    # for the repeats, so texts are shuffled once
    key, text = fresh_name(docs, "key"), fresh_name(docs, "text")
    stays = write_table(found.select(id_key("component_id").alias(key)).distinct(), "stays")
    own = docs.withColumns({key: id_key(id_col), text: F.xxhash64(text_col)})
    return own.join(stays.hint("merge"), key, "left_semi").dropDuplicates([key, text]).select(*docs.columns)
