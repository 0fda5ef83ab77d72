"""Benchmark decontamination: one Aho-Corasick automaton, one scan of each text.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of bytes from 0x80 up. The
normalisation maps byte to byte before it squeezes separators, so a word's place in the original
text is known without a second parse.

A window is ``width`` consecutive words of an item. The automaton doesn't hold the windows, which
overlap, but the blocks that an item is cut into, of half as many words (rounded up): wherever a
window occurs, one of its item's blocks does. Where a block occurs, the words on both sides are
compared with the item's, and the whole run counts if it has at least ``width`` words. Its states
are thus no more than the bytes of the items, not ten times as many.

Defined results: a null or empty text has no words, no hits and no items; an item without words
matches nothing; repeated documents each get their own row; an item id that is null is named
``null``; equal items all count; an empty benchmark leaves every document clean. The input's other
columns are never looked at, whatever their names. Ids of documents are whole numbers.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import byte_views, drop_table, slices, write_table

#: A byte's normal form: a space for a separator.
_NORMAL = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
#: Bytes of normal words that one automaton holds at most; about 60 bytes of a worker's memory each.
AUTOMATON_BYTES = 4_000_000
#: Words of an item that go to one automaton; longer items are cut, with an overlap that keeps all windows.
ITEM_WORDS = 4096

_SCHEMA = "id long, n_words long, n_hit long, hit_words binary, items array<string>, spans array<struct<start:int,end:int>>"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """All blocks of all items. Keys begin and end with a space, so matches are whole words.

    The library's automaton works on code points; bytes are handed over as Latin-1, one each.
    """

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.width, block = width, (width + 1) // 2
        self.names: list[str] = []
        self.texts: list[list[bytes]] = []
        known: dict[bytes, bytes] = {}
        places: dict[bytes, list[tuple[int, int]]] = {}
        for name, text in items:
            words = [known.setdefault(w, w) for w in normal_words(text)]
            if not words:
                continue
            own, n = len(self.texts), len(words) if len(words) < width else block
            self.names.append(name)
            self.texts.append(words)
            for at in range(0, len(words) - n + 1, n):
                places.setdefault(b" ".join(words[at : at + n]), []).append((own, at))
        self.auto = ahocorasick.Automaton()
        while places:
            key, found = places.popitem()
            self.auto.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, found))
        self.empty = not self.texts
        self.auto.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie inside an occurrence, and the items that occur."""
        hit, found = np.zeros(len(words) + 1, dtype=np.int32), set()
        if self.empty or not words:
            return hit[:-1] > 0, found
        text = f" {b' '.join(words).decode('latin-1')} "
        gaps: list[int] | None = None
        seen: dict[tuple[int, int], int] = {}  # of an item and a shift, the end of the last run
        for end, (n, owners) in self.auto.iter(text):
            if gaps is None:
                gaps = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
            stop = bisect.bisect_left(gaps, end)
            first = stop - n
            for own, at in owners:
                if seen.get((own, first - at), 0) >= stop:
                    continue
                item = self.texts[own]
                a, b, shift = first, stop, at - first
                while a > 0 and a + shift > 0 and words[a - 1] == item[a + shift - 1]:
                    a -= 1
                while b < len(words) and b + shift < len(item) and words[b] == item[b + shift]:
                    b += 1
                seen[own, first - at] = b
                if b - a >= min(self.width, len(item)):
                    hit[a] += 1
                    hit[b] -= 1
                    found.add(own)
        return np.cumsum(hit[:-1]) > 0, found


_last: dict[str, Automaton] = {}


def _automaton(items, width: int) -> Automaton:
    """The automaton of a broadcast, kept for the tasks that a worker runs one after another."""
    token, own = items.value
    if token not in _last:
        _last.clear()
        _last[token] = Automaton(own, width)
    return _last[token]


def original_spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Code-point ranges of the original text that the runs of hit words cover."""
    if not hit.any():
        return []
    inside = np.frombuffer(text.translate(_NORMAL), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    turns = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[starts[a]]), "end": int(chars[ends[b - 1]])} for a, b in zip(turns[::2], turns[1::2], strict=True)]


def _scan_rows(items, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(items, width)
        for batch in slices(batches):
            out: list[tuple] = []
            for i, text in enumerate(byte_views(batch.column(1))):
                words = normal_words(text)
                hit, found = auto.scan(words)
                before = batch.column(2)[i].as_py() if batch.num_columns > 2 else None
                if before is not None:
                    hit = hit | np.unpackbits(np.frombuffer(before, dtype=np.uint8), count=len(words)).astype(bool)
                names = {auto.names[x] for x in found} | set(batch.column(3)[i].as_py() if batch.num_columns > 3 else ())
                out.append((len(words), int(hit.sum()), np.packbits(hit).tobytes(), sorted(names), original_spans(text, hit)))
            cols = list(zip(*out, strict=True)) if out else [(), (), (), (), ()]
            arrays = [
                batch.column(0),
                pa.array(cols[0], pa.int64()),
                pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.binary()),
                pa.array(cols[3], pa.list_(pa.string())),
                pa.array(cols[4], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ]
            columns = ["id", "n_words", "n_hit", "hit_words", "items", "spans"]
            if batch.num_columns > 4:  # a later round still needs the text
                arrays.append(batch.column(1))
                columns.append("text")
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return rows


def _rounds(benchmark: DataFrame, item_id: str, item_text: str, automaton_bytes: int, width: int) -> tuple[DataFrame, int]:
    """The items, long ones in portions, with the part of the benchmark that each belongs to, and the number of parts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(ITEM_WORDS, 2 * width)
        for batch in batches:
            names, bodies = [], []
            for name, text in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), strict=True):
                words = normal_words(text)
                for at in range(0, max(1, len(words) - width + 1), step):
                    names.append(name)
                    bodies.append(b" ".join(words[at : at + step + width - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], names=["name", "body"])

    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"), F.col(item_text).cast("string").alias("body"))
    items = write_table(items.mapInArrow(cut, "name string, body binary").distinct(), "benchmark")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    rounds = max(1, -(-total // automaton_bytes))
    return items.withColumn("part", F.pmod(F.xxhash64("name", "body"), F.lit(rounds))), rounds


def _items_of(items: DataFrame, part: int):
    """A part, broadcast; its size is bounded by what :func:`_rounds` was given."""
    own = [(r["name"], bytes(r["body"])) for r in items.filter(F.col("part") == part).collect()]
    return items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, own))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs; nothing is shuffled."""
    items, rounds = _rounds(benchmark, item_id, item_text, automaton_bytes, width)
    place, before = docs.columns.index(text_col), None
    for part in range(rounds):
        own = _items_of(items, part)

        def clean(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            auto = _automaton(own, width)
            for batch in slices(batches):
                yield batch.filter(pa.array([not auto.scan(normal_words(t))[1] for t in byte_views(batch.column(place))], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
        if part + 1 < rounds:
            docs = write_table(docs, "clean")
            if before is not None:
                drop_table(before)
            before = docs
    return docs


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """``id, n_words, n_hit, items, spans, contaminated`` for each document.

    The benchmark reaches the tasks as a broadcast of at most about ``automaton_bytes`` of item
    words. A larger benchmark is dealt into that many parts by hash and the documents are scanned
    once a part, with a written table between the rounds; hits add up, so the result is the same.
    """
    items, rounds = _rounds(benchmark, item_id, item_text, automaton_bytes, width)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    before = None
    for part in range(rounds):
        scan = _scan_rows(_items_of(items, part), width)
        if part + 1 == rounds and part == 0:
            rows = rows.mapInArrow(scan, _SCHEMA)
        else:
            if part == 0:
                rows = rows.select("id", "text", F.lit(None).cast("binary").alias("hit_words"), F.array().cast("array<string>").alias("items"), F.lit(0).alias("more"))
            rows = write_table(rows.select("id", "text", "hit_words", "items", F.lit(0).alias("more")).mapInArrow(scan, f"{_SCHEMA}, text string"), "decontaminate")
            if before is not None:
                drop_table(before)
            before = rows
    return rows.select("id", "n_words", "n_hit", "items", "spans").withColumn("contaminated", F.col("n_hit") > 0)


def contamination_query(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: Windows of every length an item has, joined to the documents' runs of as many words.
CONTAMINATION_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
