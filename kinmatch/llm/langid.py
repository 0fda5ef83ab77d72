"""Language identification: known words first, then ever shorter character n-grams.

A word seen in training adds its log frequency in each language. A word not seen adds the mean log
frequency of its longest n-grams that were seen (5 letters down to 1, with word ends marked). The
language with the largest sum wins; equal sums go to the first in alphabetical order. Words are
letters with their combining marks, as Unicode's categories have them; numerals are no letters.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text
when there was nothing to learn from. A null id counts as held out. Texts are read whole. Repeated
rows count once in training and are predicted each; an empty table gives no rows; columns of the
input that are called as the result's own are replaced.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import drop_table, fresh_name, slices, write_table



def _category(*kinds: str) -> str:
    """A character class of all code points whose category begins with one of ``kinds``."""
    held = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith(kinds)]
    ranges, first = [], held[0]
    for c, after in zip(held, [*held[1:], "\0"], strict=True):
        if ord(after) != ord(c) + 1:
            ranges.append(f"{first}-{c}")
            first = after
    return "".join(ranges)


_JOINERS = "\u200c\u200d"
#: A letter, then letters, marks, and the joiners that some scripts have inside words.
_WORD = re.compile(f"[{_category('L')}][{_category('L', 'M')}{_JOINERS}]*")
#: Without marks, joiners and numerals that aren't decimal digits, words are runs of what is neither digit nor line.
_PLAIN_WORD = re.compile(r"[^\W\d_]+")
#: Ranges that have such characters; Latin, Greek and Cyrillic letters and general punctuation are none of them.
_RARE = re.compile("[\u00b2\u00b3\u00b9\u00bc-\u00be\u0300-\u036f\u0483-\u1fff\u200c\u200d\u2070-\U0010ffff]")
ORDERS = (5, 4, 3, 2, 1)
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (_PLAIN_WORD if text.isascii() or not _RARE.search(text) else _WORD).findall(text)


def grams_of(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """``tables[0]`` holds words, ``tables[n]`` the n-grams: a row of log frequencies for each."""

    langs: list[str]
    tables: dict[int, dict[str, int]]
    rows: np.ndarray
    _seen: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self._reset()

    def _reset(self):
        self._seen = dict(self.tables.get(0, {}))
        self._matrix, self._used = np.concatenate([self.rows, np.zeros((1024, len(self.langs)), np.float32)]), len(self.rows)

    def _backoff(self, word: str) -> np.ndarray:
        for n in ORDERS:
            table = self.tables.get(n, {})
            known = [i for g in grams_of(word, n) if (i := table.get(g)) is not None]
            if known:
                return self.rows[known].mean(axis=0) if len(known) > 1 else self.rows[known[0]]
        return np.zeros(len(self.langs), np.float32)

    def _row(self, word: str) -> int:
        if self._used == len(self._matrix):
            self._matrix = np.concatenate([self._matrix, np.zeros_like(self._matrix)])
        self._matrix[self._used] = self._backoff(word)
        self._seen[word] = self._used
        self._used += 1
        return self._used - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.langs:
            return UNKNOWN, 0.0
        if len(self._seen) > len(self.tables.get(0, {})) + 300_000:  # a cache of backed-off words, not of results
            self._reset()
        get = self._seen.get
        at = [i if (i := get(w)) is not None else self._row(w) for w in words]
        total = self._matrix[at].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        tempered = (total - total[best]) / math.sqrt(len(words))
        return self.langs[best], float(1.0 / np.exp(tempered).sum())


def train(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_rows: int = 6000, min_count: int = 2) -> Model:
    """Fit on about ``max_rows`` labelled texts at most, all of them if there are no more rows.

    A row is in the sample if a hash of its text falls below the share that makes ``max_rows`` of
    different texts expected; equal rows count once, so a text on half of all rows is one row of the
    sample. The model, which goes to every task, doesn't grow with the corpus.
    """
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    n = rows.count()
    if n > max_rows:
        rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) < max_rows)
    rows = rows.distinct()

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally.update((lang, w) for w in words_of(text))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in tally], pa.string()), pa.array([k[1] for k in tally], pa.string()), pa.array(list(tally.values()), pa.int64())], names=["lang", "gram", "times"])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for lang, word, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for order in ORDERS:
                    for gram in grams_of(word, order):
                        tally[lang, order, gram] += times
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in tally], pa.string()), pa.array([k[1] for k in tally], pa.int32()), pa.array([k[2] for k in tally], pa.string()), pa.array(list(tally.values()), pa.int64())],
            names=["lang", "n", "gram", "times"],
        )

    words = write_table(rows.mapInArrow(count_words, "lang string, gram string, times long").groupBy("lang", "gram").agg(F.sum("times").alias("times")), "words")
    grams = words.mapInArrow(count_grams, "lang string, n int, gram string, times long").groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    counted = write_table(words.select("lang", F.lit(0).alias("n"), "gram", "times").union(grams), "grams")
    totals = {(r["lang"], r["n"]): r["total"] for r in counted.groupBy("lang", "n").agg(F.sum("times").alias("total")).collect()}
    langs = sorted({lang for lang, _ in totals})
    found = counted.filter(F.col("times") >= F.when(F.col("n") == 0, min_count).otherwise(2 * min_count)).toArrow()
    drop_table(words)
    drop_table(counted)
    return fit(list(zip(*(found.column(c).to_pylist() for c in ("lang", "n", "gram", "times")), strict=True)), totals, langs)


def fit(found: list[tuple[str, int, str, int]], totals: dict[tuple[str, int], int], langs: list[str]) -> Model:
    """Smoothed log frequencies, less their mean over the languages."""
    at = {lang: i for i, lang in enumerate(langs)}
    tables: dict[int, dict[str, int]] = {}
    size = 0
    for _, n, gram, _ in found:
        if gram not in tables.setdefault(n, {}):
            tables[n][gram] = size
            size += 1
    times = np.zeros((size, len(langs)))
    order = np.zeros(size, dtype=np.int64)
    for lang, n, gram, c in found:
        times[tables[n][gram], at[lang]] += c
        order[tables[n][gram]] = n
    whole = np.array([[totals.get((lang, n), 0) for lang in langs] for n in range(max(ORDERS) + 1)], dtype=np.float64).reshape(-1, max(1, len(langs)))
    if not langs:
        return Model([], {}, np.zeros((0, 0), np.float32))
    rows = np.log((times + 0.5) / (whole[order] + 0.5 * max(1, size)))
    return Model(langs, tables, (rows - rows.mean(axis=1, keepdims=True)).astype(np.float32))


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None, pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The columns ``keep`` of each row with the language and its score."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (pred_col, score_col)]
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.tables, model.rows))
    body, alike = fresh_name(docs, "text"), text_col in keep and dict(docs.dtypes)[text_col] == "string"
    rows = docs.select(*[F.col(c) for c in keep], *([] if alike else [F.col(text_col).cast("string").alias(body)]))
    place = keep.index(text_col) if alike else len(keep)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in slices(batches, 2048):
            made = [own.predict(t.as_py()) for t in batch.column(place)]
            columns = [*batch.columns[: len(keep)], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, pred_col, score_col])

    schema = docs.select(*[F.col(c) for c in keep]).schema.add(pred_col, "string").add(score_col, "double")
    return rows.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that nothing is learned from: those whose id, as text, has a CRC-32 divisible by five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def langid_query(spark, sf_dir: str) -> DataFrame:
    """Every document, by a model learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs, model, keep=["doc_id", "held_out"])
