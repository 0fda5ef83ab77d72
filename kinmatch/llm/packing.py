"""Packing documents into fixed-length sequences: first-fit decreasing on a tournament tree.

A document's ids are cut into whole sequences and a rest. Pieces are dealt at random into groups;
in each group the pieces, longest first, go to the first sequence with room, which a tournament
tree of free room finds in the logarithm of the number of sequences.

Defined results: a null or empty text is a document of its end id alone; the string of a special token
in a text is read as that token; repeated rows are packed
each; an empty table gives no rows; other columns of the input are ignored; ids are whole numbers.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import slices, write_table

END_ID = 1
LENGTH = 2048
GROUP_PIECES = 4096

#: Texts of these characters alone take the fast encoder; the libraries' Unicode tables agree there.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ÿŒœ‘-”€]*")


class Encoder:
    """The ids that the ``tokenizers`` library gives for a byte-level BPE file.

    ``tiktoken`` gives the same ids from the same vocabulary, several times faster. It is used for
    plain texts, where the two split words alike; all others go to the library itself, and so do
    texts that hold the string of a special token, which the library reads as that token.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        special = {x["content"] for x in said.get("added_tokens", ())}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not self.special.search(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def tokenizer_path() -> str:
    """Where the public vocabulary lies; it is a file of an installed package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class RoomTree:
    """A tournament tree over bins: each inner node knows the most room below it."""

    def __init__(self, bins: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [0] * (2 * self.leaves)

    def set(self, bin_: int, room: int) -> None:
        tree, at = self.room, bin_ + self.leaves
        tree[at] = room
        while at > 1:
            at >>= 1
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                return
            tree[at] = best

    def first_with(self, need: int) -> int:
        """The first bin with room for ``need``, -1 if there is none."""
        tree, at = self.room, 1
        if tree[1] < need:
            return -1
        while at < self.leaves:
            at = 2 * at if tree[2 * at] >= need else 2 * at + 1
        return at - self.leaves


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; equal lengths go in the order given."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths == capacity).sum())
    bins[order[:full]] = np.arange(full)
    tree, used = RoomTree(max(1, n - full)), 0
    for i in order[full:].tolist():
        need = int(lengths[i])
        at = tree.first_with(need)
        if at < 0:
            at, used = used, used + 1
            room = capacity
        else:
            room = tree.room[at + tree.leaves]
        bins[i], offsets[i] = full + at, capacity - room
        tree.set(at, room - need)
    return bins, offsets


_PIECES = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("deal", pa.int64())])


def pieces(docs: DataFrame, *, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Each document's ids, cut; ``deal`` is a number to deal pieces by, other for equal rows too."""
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        count, task = 0, TaskContext.get().partitionId() << 40
        for batch in slices(batches, 4096):
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    out.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids), task + count, *([part.astype(np.int32)] if with_ids else ())))
                    count += 1
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    kinds = "id long, start long, length long, ids_crc32 long, doc_tokens long, deal long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(cut, kinds)


def pack(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for each piece.

    The pieces (numbers, no ids) are written first: their count sets the number of groups, which
    therefore hold about ``group_pieces`` each at any size.
    """
    cut = write_table(pieces(docs, path=path or tokenizer_path(), id_col=id_col, text_col=text_col, length=length), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("deal", F.lit(seed)), F.lit(groups)))

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("deal")
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        kept = table.select(["id", "start", "length", "ids_crc32", "doc_tokens"]).rename_columns(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array((key[0].as_py() << 31) + bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("group").applyInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def packing_query(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
