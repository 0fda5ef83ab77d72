"""Hashed TF-IDF: document frequencies, sparse unit vectors, and the tokens that retrieval asks for.

With buckets, all that a record needs of the corpus is two arrays of weights, whose size the number of bits
bounds. So records are read once, in Arrow batches, without a shuffle of their terms; counts are combined in
each task. Vectors are packed: buckets as 32-bit and values as 64-bit numbers, which cross to Python as they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.functions import text as T
from kinmatch.functions.hashing import term_bucket

FIELDS = {"name": T.name_text, "address": T.address_text}
#: Terms whose buckets a task remembers.
KNOWN_TERMS = 1_000_000
VECTOR = "struct<i:binary,v:binary>"


@dataclass
class Tfidf:
    """``idf`` has ``field, bucket, df, idf`` for buckets that occur; all others share ``default``."""

    idf: DataFrame
    n: int
    bits: int
    hash_fn: str
    rows: int

    def arrays(self) -> dict[str, np.ndarray]:
        """The weights of all buckets of each field; their size is bounded by the number of bits."""
        found = self.idf.select("field", "bucket", "idf").toArrow()
        out = {}
        for field in FIELDS:
            own = found.filter(pc.equal(found.column("field"), field))
            out[field] = np.full(1 << self.bits, float(np.float32(np.log(self.n + 1.0) + 1)))
            out[field][own.column("bucket").to_numpy()] = own.column("idf").to_numpy()
        return out


# ---------------------------------------------------------------- records, one by one


def word_grams(text: str, n: int) -> Iterator[str]:
    for word in text.split():
        padded = f" {word} "
        yield from (padded[i : i + n] for i in range(len(padded) - n + 1))


def terms_of(text: str) -> list[str]:
    """As :func:`kinmatch.functions.text.terms`: words and 3- to 5-grams, marked by kind, with repeats."""
    return [f"w:{w}" for w in text.split()] + [f"{n}:{g}" for n in (3, 4, 5) for g in word_grams(text, n)]


def tokens_of(text: str) -> set[str]:
    """As :func:`kinmatch.functions.text.lexical_tokens`: distinct words and 3-grams."""
    return {f"w:{w}" for w in text.split()} | {f"3:{g}" for g in word_grams(text, 3)}


def _hasher(bits: int, hash_fn: str) -> Callable[[str], int]:
    """A term's bucket; a task hashes each term once."""
    known: dict[str, int] = {}

    def find(term: str) -> int:
        at = known.get(term)
        if at is None:
            if len(known) >= KNOWN_TERMS:
                known.clear()
            at = known[term] = term_bucket(term, bits, hash_fn)
        return at

    return find


def _texts(records: DataFrame, key: str, *more: Column) -> DataFrame:
    return records.select(key, *[text().alias(field) for field, text in FIELDS.items()], *more)


def indexed(records: DataFrame, model: Tfidf, limit: int, key: str = "entity_id", more: tuple[Column, ...] = ()) -> DataFrame:
    """``key, name_vector, address_vector, tokens, asked``: packed unit vectors, buckets ascending; all
    tokens by field; and of each field the ``limit`` rarest, by weight, then by token.

    ``more`` are further columns of the records, which go along. Nothing should be joined to the result for
    them: Spark takes its size from that of the texts and would send vectors of any size to the driver.
    """
    weights = records.sparkSession.sparkContext.broadcast(model.arrays())
    bits, hash_fn = model.bits, model.hash_fn
    listed = pa.list_(pa.struct([("field", pa.string()), ("token", pa.string())]))
    vector = pa.struct([("i", pa.binary()), ("v", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, idf = _hasher(bits, hash_fn), weights.value
        for batch in batches:
            vectors: dict[str, list] = {f: [] for f in FIELDS}
            every, asked = [], []
            for texts in zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True):
                tokens, rare = [], []
                for field, text in zip(FIELDS, texts, strict=True):
                    counts = Counter(map(find, terms_of(text)))
                    at = np.array(sorted(counts), dtype="<i4")
                    v = (1 + np.log(np.array([counts[i] for i in at.tolist()], dtype=np.float64))) * idf[field][at] if len(at) else np.zeros(0)
                    vectors[field].append({"i": at.tobytes(), "v": (v / np.sqrt((v * v).sum()) if len(at) else v).astype("<f8").tobytes()})
                    own = sorted(tokens_of(text), key=lambda t: (-idf[field][find(t)], t))  # noqa: B023
                    tokens += [{"field": field, "token": t} for t in own]
                    rare += [{"field": field, "token": t} for t in own[:limit]]
                every.append(tokens)
                asked.append(rare)
            columns = [batch.column(0), *(pa.array(v, vector) for v in vectors.values()), pa.array(every, listed), pa.array(asked, listed), *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names=[key, *(f"{f}_vector" for f in FIELDS), "tokens", "asked", *batch.schema.names[3:]])

    kind = dict(records.dtypes)[key]
    listing = "array<struct<field:string,token:string>>"
    texts = _texts(records, key, *more)
    along = "".join(f", {name} {kind}" for name, kind in texts.dtypes[3:])
    return texts.mapInArrow(read, f"{key} {kind}, name_vector {VECTOR}, address_vector {VECTOR}, tokens {listing}, asked {listing}{along}")


def _counted(records: DataFrame, bits: int, hash_fn: str) -> DataFrame:
    """``field, bucket, df``: records that have a term of the bucket, counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = _hasher(bits, hash_fn), {f: Counter() for f in FIELDS}
        for batch in batches:
            for i, tally in enumerate(seen.values(), 1):
                for text in batch.column(i).to_pylist():
                    tally.update(set(map(find, terms_of(text))))
        rows = [(field, at, n) for field, tally in seen.items() for at, n in tally.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["field", "bucket", "df"])

    return _texts(records, "entity_id").mapInArrow(count, "field string, bucket long, df long").groupBy("field", "bucket").agg(F.sum("df").alias("df"))


# ---------------------------------------------------------------- the model


def fit(references: DataFrame, *, bits: int = 18, hash_fn: str = "blake2b") -> Tfidf:
    """Fit on reference records alone; queries and test records use the weights as they are."""
    n = references.count()
    idf = _counted(references, bits, hash_fn).withColumn("idf", (F.log(F.lit(float(n + 1)) / (F.col("df") + 1)) + 1).cast("float").cast("double")).persist()
    return Tfidf(idf, n, bits, hash_fn, idf.count())


def vectors(records: DataFrame, model: Tfidf, key: str = "entity_id") -> DataFrame:
    """``key, name_vector, address_vector``, packed."""
    return indexed(records, model, 0, key).select(key, "name_vector", "address_vector")


def entries(vectors: DataFrame, key: str = "entity_id") -> DataFrame:
    """``key, field, bucket, value`` of packed vectors."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for field in FIELDS:
                packed = batch.column(f"{field}_vector").to_pylist()
                sizes = [len(x["i"]) // 4 for x in packed]
                at, v = (np.frombuffer(b"".join(x[part] for x in packed), kind) for part, kind in (("i", "<i4"), ("v", "<f8")))
                keys = batch.column(key).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([keys, pa.array([field] * len(at), pa.string()), pa.array(at.astype(np.int64), pa.int64()), pa.array(v, pa.float64())], names=[key, "field", "bucket", "value"])

    return vectors.mapInArrow(unpack, f"{key} {dict(vectors.dtypes)[key]}, field string, bucket long, value double")
