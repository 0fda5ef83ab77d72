"""Exact substring deduplication by a prefix-free parse.

Rolling-hash triggers cut each document into phrases: the trigger of a 50-byte string is its
smallest hash of 20 bytes, and a phrase is a run of strings with one trigger, so a phrase reaches
49 bytes into the next and equal strings lie at the same place of phrases with the same trigger,
whatever document they are in. The parse is the phrases of each document in order; the dictionary
is the distinct phrases, each with the smallest document that has it.

Phrases are dealt by their trigger, so all that could share a string meet in one group. There the
dictionary's suffixes are sorted to a depth of 50 bytes; equal neighbours are one string of the
corpus, and the smallest document of their phrases is the first in which it starts. What comes back
to a document is one bit for each of its strings.

Three passes over blocks of documents, which are written once, compressed: triggers are counted
first (a sorted list of 40-bit hashes a block), so that only phrases whose trigger is in two
documents are dealt at all. False alarms of those 40 bits cost time, not correctness. Phrases are
told apart by their bytes; hashes only bring equal ones together.

A phrase of very many blocks is hot (one block in ``HOT_SAMPLE`` tells which; the list is bounded by
``HOT_PHRASES``, most frequent first). Its first document is found with partial results, and only
the block that holds it deals the phrase; the others know that all of it starts earlier. So a group
isn't swollen by what a third of all documents share. Whether a phrase is hot changes no result.

The dealt method orders the whole corpus, by a suffix array of the parse beside the dictionary's.
Only the dictionary's is made here: a string of 50 bytes lies inside one phrase, so the parse would
only order strings that are equal, which nothing asks for. The README has the figures.

Defined results: a null text is empty; texts under 50 bytes lose nothing; documents of equal id
don't remove each other's bytes; a document with a null id neither loses nor removes; repeated rows
each get a row; an empty table gives no rows; other columns are ignored; ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import byte_views, drop_table, get_file, mix64, open_fs, put_file, runs, shared_dir, sliding_min, stretches, write_table

DEPTH = 50
TRIGGER = 20
BLOCK_BYTES = 2_000_000
GROUP_BYTES = 6_000_000
SORT_STRINGS = 500_000
#: Blocks from which a phrase is hot, as one block in ``HOT_SAMPLE`` tells, and how many are at most.
HOT_BLOCKS, HOT_SAMPLE, HOT_PHRASES = 1 << 14, 64, 200_000
_POS = 22  # bits of a place in a block
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 15


# ---------------------------------------------------------------- packing of arrays


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending whole numbers as compressed differences, byte planes apart."""
    step = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    width = 4 if not len(step) or int(step.max()) < 2**32 else 8
    planes = step.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(1).compress(planes)


def unpack_sorted(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(data[0], -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(f"<u{data[0]}").ravel().astype(np.uint64))


def rolling(text: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` bytes, put together from hashes of 1, 2, 4 .. bytes."""
    out, done, have, part = None, 0, 1, _TABLE[text]
    with np.errstate(over="ignore"):
        while True:
            if width & have:
                n = max(0, len(text) - done - have + 1)
                out = part if out is None else out[:n] * np.uint64(pow(_BASE, have, 2**64)) + part[done : done + n]
                done += have
            if have * 2 > width:
                return mix64(out)
            part = part[:-have] * np.uint64(pow(_BASE, have, 2**64)) + part[have:]
            have *= 2


def phrase_names(text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each phrase: of its first and last string, which cover it, and its length."""
    strings = np.empty((2, len(first)), np.uint64)
    for places, out in zip((first, last), strings, strict=True):
        cut = np.searchsorted(places, np.arange(0, len(text) + _CHUNK, _CHUNK))  # phrases come in order
        for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
            if b > a:
                out[a:b] = rolling(text[i * _CHUNK : (i + 1) * _CHUNK + DEPTH - 1], DEPTH)[places[a:b] - i * _CHUNK]
    return mix64(strings[0] ^ mix64(strings[1] + (last - first).astype(np.uint64)))


def alike(text: np.ndarray, one: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes from each place of ``one`` on are those from ``other`` on."""
    out = np.ones(len(one), bool)
    for a in range(0, len(one), 20_000):  # some megabytes at a time
        part = slice(a, a + 20_000)
        n = sizes[part]
        if len(n):
            equal = text[stretches(one[part], n)] == text[stretches(other[part], n)]
            out[part] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return out


# ---------------------------------------------------------------- blocks


class Hot:
    """First documents of hot phrases, which two hashes (128 bits together) name."""

    def __init__(self, trigger: np.ndarray, name: np.ndarray, first: np.ndarray):
        order = np.lexsort((name, trigger))
        self.trigger, self.name, self.first = trigger[order], name[order], first[order]

    def at(self, trigger: np.ndarray, name: np.ndarray) -> np.ndarray:
        """The place of each phrase among the hot ones, -1 if it is none."""
        out = np.full(len(trigger), -1)
        low, high = np.searchsorted(self.trigger, trigger, "left"), np.searchsorted(self.trigger, trigger, "right")
        while len(left := np.flatnonzero((out < 0) & (low < high))):
            out[left] = np.where(self.name[low[left]] == name[left], low[left], -1)
            low[left] += 1
        return out

    def first_of(self, trigger: np.ndarray, name: np.ndarray) -> np.ndarray:
        at = self.at(trigger, name)
        return np.where(at >= 0, self.first[at] if len(self.first) else 0, np.iinfo(np.int64).max)


class Parse:
    """The phrases of a block: where each begins and ends, its trigger, its document."""

    def __init__(self, text: bytes, lengths: np.ndarray, valid: np.ndarray):
        self.text = np.frombuffer(text, dtype=np.uint8)
        self.ends = np.cumsum(lengths)
        n = len(self.text) - DEPTH + 1
        empty = np.zeros(0, np.int64)
        self.first, self.last, self.doc, self.trigger = empty, empty, empty, np.zeros(0, np.uint64)
        if n <= 0:
            return
        hashes, at = np.empty(len(self.text) - TRIGGER + 1, np.uint64), np.empty(n, np.int64)
        for c in range(0, n, _CHUNK):  # portions that stay in the processor's cache
            own = rolling(self.text[c : c + _CHUNK + DEPTH - 1], TRIGGER)
            hashes[c : c + len(own)] = own
            least = sliding_min((own & ~np.uint64((1 << _POS) - 1)) | np.arange(len(own), dtype=np.uint64), DEPTH - TRIGGER + 1)
            at[c : c + len(least)] = (least & np.uint64((1 << _POS) - 1)).astype(np.int64) + c
        # a string must end in the document that it starts in, and the document must have an id
        room = np.repeat(self.ends, lengths)[:n] - np.arange(n) >= DEPTH
        room &= np.repeat(valid, lengths)[:n]
        start = np.flatnonzero(room)
        if not len(start):
            return
        doc = np.searchsorted(self.ends, start, side="right")
        cut = np.concatenate([[True], (at[start[1:]] != at[start[:-1]]) | (doc[1:] != doc[:-1]), [True]])
        bounds = np.flatnonzero(cut)
        self.first, self.last, self.doc = start[bounds[:-1]], start[bounds[1:] - 1], doc[bounds[:-1]]
        self.trigger = mix64(hashes[at[self.first]])  # least hashes are small: mixed again, they deal evenly

    def triggers(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's distinct triggers (40 bits, ascending), and which are in two documents."""
        short = self.trigger >> np.uint64(24)
        order = np.lexsort((self.doc, short))
        values, docs = short[order], self.doc[order]
        at = runs(values)
        return values[at[:-1]], docs[at[:-1]] != docs[at[1:] - 1]

    def shared(self, flags: np.ndarray) -> np.ndarray:
        """The phrases whose trigger was found in two documents."""
        values, _ = self.triggers()
        return np.flatnonzero(flags[np.searchsorted(values, self.trigger >> np.uint64(24))])

    def distinct(self, phrases: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct phrase one that lies in its smallest document; for each phrase, which one."""
        first, last = self.first[phrases], self.last[phrases]
        name = phrase_names(self.text, first, last)
        order = np.lexsort((ids[self.doc[phrases]], name, self.trigger[phrases]))
        new = np.ones(len(order), bool)
        new[1:] = (name[order[1:]] != name[order[:-1]]) | ((last - first)[order[1:]] != (last - first)[order[:-1]])
        again = np.flatnonzero(~new)
        new[again] = ~alike(self.text, first[order[again]], first[order[again - 1]], (last - first + DEPTH)[order[again]])
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        return phrases[order[new]], back

    def cold(self, phrases: np.ndarray, ids: np.ndarray, hot: Hot | None) -> np.ndarray:
        """Which of these phrases aren't a hot one that starts in a smaller document."""
        if hot is None or not len(phrases):
            return np.ones(len(phrases), bool)
        return ids[self.doc[phrases]] <= hot.first_of(self.trigger[phrases], self.names(phrases))

    def names(self, phrases: np.ndarray) -> np.ndarray:
        """The phrases' hashes, whatever their order."""
        order, out = np.argsort(self.first[phrases], kind="stable"), np.empty(len(phrases), np.uint64)
        out[order] = phrase_names(self.text, self.first[phrases[order]], self.last[phrases[order]])
        return out

    def take(self, phrases: np.ndarray) -> np.ndarray:
        """The phrases' bytes, one after the other."""
        return self.text[stretches(self.first[phrases], self.last[phrases] - self.first[phrases] + DEPTH)]


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Documents by blocks of about ``block_bytes``: ``block, ids, lengths, valid, text, size``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> pa.RecordBatch:
            row = {
                "block": number,
                "ids": np.array([0 if x is None else x for x in ids], dtype="<i8").tobytes(),
                "valid": np.array([x is not None for x in ids], dtype=np.uint8).tobytes(),
                "lengths": np.array([len(t) for t in texts], dtype="<i8").tobytes(),
                "text": zstandard.ZstdCompressor(1).compress(b"".join(texts)),
                "size": size,
            }
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("valid", pa.binary()), ("lengths", pa.binary()), ("text", pa.binary()), ("size", pa.int64())]))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), strict=True):
                if texts and size + len(text) > block_bytes:
                    yield close()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if texts:
            yield close()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return write_table(rows.mapInArrow(gather, "block long, ids binary, valid binary, lengths binary, text binary, size long"), "blocks")


def _open_block(row: dict) -> tuple[np.ndarray, np.ndarray, bytes, Parse]:
    ids, lengths = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
    text = zstandard.ZstdDecompressor().decompress(row["text"])
    return ids, lengths, text, Parse(text, lengths, np.frombuffer(row["valid"], np.uint8).astype(bool))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}


def _group_of(trigger: np.ndarray, groups: int) -> np.ndarray:
    """Ascending triggers have ascending groups, so a block's answers can be joined in their order."""
    return ((trigger.astype(np.uint64) * np.uint64(groups)) >> np.uint64(40)).astype(np.int64)


# ---------------------------------------------------------------- answers to blocks


def _publish(answers: DataFrame, folder: str) -> None:
    """Write ``block, group, answer`` to one file for the blocks of each task that wrote blocks."""

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("grp", "ascending")])
        data = zstandard.ZstdCompressor(1).compress(_to_ipc(table.select(["block", "answer"])))
        put_file(f"{folder}/{table.column('part')[0].as_py()}", data)
        return pa.table({"part": table.column("part")[:1]})

    answers.withColumn("part", F.shiftright("block", 32)).groupBy("part").applyInArrow(write, "part long").write.format("noop").mode("overwrite").save()


def _to_ipc(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


class _Answers:
    """The answers to a block, from the file of its part; the last file read is kept."""

    def __init__(self, folder: str):
        self.folder, self.part, self.by_block = folder, -1, {}

    def of(self, block: int) -> list[bytes]:
        if block >> 32 != self.part:
            self.part, self.by_block = block >> 32, {}
            fs, path = open_fs(f"{self.folder}/{self.part}")
            if fs.get_file_info(path).is_file:
                raw = zstandard.ZstdDecompressor().decompress(get_file(f"{self.folder}/{self.part}"))
                table = pa.ipc.open_stream(raw).read_all()
                for b, answer in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
                    self.by_block.setdefault(b, []).append(answer)
        return self.by_block.get(block, [])

    def flags(self, block: int, n: int) -> np.ndarray:
        parts = [np.unpackbits(np.frombuffer(x[4:], np.uint8), count=int.from_bytes(x[:4], "little")) for x in self.of(block)]
        out = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
        if len(out) != n:
            raise ValueError(f"block {block}: {len(out)} answers to {n} triggers")
        return out


# ---------------------------------------------------------------- the passes


def _count_triggers(groups: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            values, several = _open_block(row)[3].triggers()
            at = np.searchsorted(_group_of(values, groups), np.arange(groups + 1))
            out = [(g, row["block"], pack_sorted(values[a:b]), np.packbits(several[a:b]).tobytes(), int(b - a)) for g, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["grp", "block", "values", "several", "n"])

    return count


def _which_are_shared(table: pa.Table) -> pa.Table:
    """Of the triggers of a group, those that two blocks sent, or one from two documents."""
    values = [unpack_sorted(x) for x in table.column("values").to_pylist()]
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("several").to_pylist(), table.column("n").to_pylist(), strict=True)]).astype(bool)
    whole = np.concatenate(values)
    order = np.argsort(whole)
    equal = whole[order[1:]] == whole[order[:-1]]
    several[order[1:][equal]] = True
    several[order[:-1][equal]] = True
    cut = np.cumsum([len(v) for v in values])[:-1]
    answers = [len(x).to_bytes(4, "little") + np.packbits(x).tobytes() for x in np.split(several, cut)]
    return pa.table({"block": table.column("block"), "grp": table.column("grp"), "answer": pa.array(answers, pa.binary())})


_SEEN = pa.schema([("trigger", pa.int64()), ("name", pa.int64()), ("doc", pa.int64())])


def _phrases_of(hot=None):
    """``trigger, name, doc`` of a block's distinct phrases, or of those that are hot alone."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, _, _, parse = _open_block(row)
            one, _ = parse.distinct(np.arange(len(parse.first)), ids)
            trigger, name = parse.trigger[one], parse.names(one)
            doc = ids[parse.doc[one]]
            if hot is not None:
                mine = hot.value.at(trigger, name) >= 0
                trigger, name, doc = trigger[mine], name[mine], doc[mine]
            yield pa.RecordBatch.from_arrays([pa.array(trigger.view(np.int64)), pa.array(name.view(np.int64)), pa.array(doc)], schema=_SEEN)

    return find


def hot_phrases(stored: DataFrame, hot_blocks: int = HOT_BLOCKS):
    """The hot phrases as a broadcast, None if there are none."""
    kinds = "trigger long, name long, doc long"
    sample = stored.filter(F.pmod(F.xxhash64("block"), F.lit(HOT_SAMPLE)) == 0)
    n = F.count(F.lit(1))
    found = sample.mapInArrow(_phrases_of(), kinds).groupBy("trigger", "name").agg(n.alias("n")).filter(F.col("n") * HOT_SAMPLE > hot_blocks)
    named = found.orderBy(F.col("n").desc(), "trigger", "name").limit(HOT_PHRASES).select("trigger", "name").toArrow()
    if not named.num_rows:
        return None
    context = stored.sparkSession.sparkContext
    columns = lambda t: [t.column(c).to_numpy().view(np.uint64) for c in ("trigger", "name")]
    listed = context.broadcast(Hot(*columns(named), np.zeros(named.num_rows, np.int64)))
    first = stored.mapInArrow(_phrases_of(listed), kinds).groupBy("trigger", "name").agg(F.min("doc").alias("doc")).toArrow()
    listed.unpersist()
    return context.broadcast(Hot(*columns(first), first.column("doc").to_numpy()))


def _deal_phrases(groups: int, folder: str, hot=None):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = _Answers(folder)
        for row in _rows(batches):
            ids, _, _, parse = _open_block(row)
            if not len(parse.first):
                continue
            shared = parse.shared(answers.flags(row["block"], len(parse.triggers()[0])))
            one, _ = parse.distinct(shared, ids)
            one = one[parse.cold(one, ids, hot and hot.value)]
            at = np.searchsorted(_group_of(parse.trigger[one] >> np.uint64(24), groups), np.arange(groups + 1))
            out = []
            for g, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                if b > a:
                    mine = one[a:b]
                    packer = zstandard.ZstdCompressor(3)
                    out.append((g, row["block"], packer.compress(parse.take(mine).tobytes()), (parse.last[mine] - parse.first[mine]).astype(np.uint8).tobytes(), packer.compress(ids[parse.doc[mine]].astype("<i8").tobytes())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["grp", "block", "bytes", "more", "docs"])

    return deal


def sort_dictionary(text: np.ndarray, more: np.ndarray, docs: np.ndarray, at_once: int = SORT_STRINGS) -> np.ndarray:
    """For each suffix of each phrase (``more + 1`` of them): does its string start in a smaller document?

    ``text`` has the phrases one after the other. Suffixes are sorted to the depth of a string;
    neighbours that are equal to that depth are one string of the corpus. Strings with the same
    trigger are sorted together, as many triggers at once as make ``at_once`` strings.
    """
    begin = np.cumsum(more + DEPTH) - (more + DEPTH)
    trigger = triggers_of(text, begin)
    order = np.argsort(trigger, kind="stable")
    bounds = runs(trigger[order])
    strings = np.concatenate([[0], np.cumsum(more[order] + 1)])
    heads = _eight_bytes(text)
    answer_at = np.cumsum(more + 1) - (more + 1)
    out = np.empty(int(strings[-1]), bool)
    here = 0
    while here < len(bounds) - 1:
        upto = max(here + 1, int(np.searchsorted(strings[bounds], strings[bounds[here]] + at_once, "right")) - 1)
        own = order[bounds[here] : bounds[upto]]
        starts = stretches(begin[own], more[own] + 1)
        out[stretches(answer_at[own], more[own] + 1)] = _later(heads, starts, np.repeat(docs[own], more[own] + 1))
        here = upto
    return out


def triggers_of(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The trigger (40 bits) of the phrases that begin at these places: the least hash of their first string."""
    width, out = DEPTH - TRIGGER + 1, np.empty(len(begin), np.uint64)
    cut = np.searchsorted(begin, np.arange(0, len(text) + _CHUNK, _CHUNK))
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if b > a:
            out[a:b] = sliding_min(rolling(text[i * _CHUNK : (i + 1) * _CHUNK + DEPTH - 1], TRIGGER), width)[begin[a:b] - i * _CHUNK]
    return out >> np.uint64(24)


def _eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number whose order is theirs."""
    n = max(0, len(text) - 7)
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | text[i : i + n]
    return out


def _later(heads: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Sort the strings at ``starts``; which ones have an equal of a smaller owner?"""
    words = [heads[starts + i] for i in (0, 8, 16, 24, 32, 40, DEPTH - 8)]
    order = np.lexsort(words[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for word in words:
        ordered = word[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[order], at)
    out = np.empty(len(starts), bool)
    out[order] = np.repeat(least, np.diff(np.append(at, len(starts)))) < owner[order]
    return out


def _which_came_later(table: pa.Table) -> pa.Table:
    """Merge a group's dictionaries, sort their suffixes, answer each block's phrases."""
    unpack = zstandard.ZstdDecompressor().decompress
    more = [np.frombuffer(x, np.uint8).astype(np.int64) for x in table.column("more").to_pylist()]
    docs = np.concatenate([np.frombuffer(unpack(x), "<i8") for x in table.column("docs").to_pylist()])
    text = np.frombuffer(b"".join(unpack(x) for x in table.column("bytes").to_pylist()), np.uint8)
    counts = [len(m) for m in more]
    sizes = np.concatenate(more)
    begin = np.cumsum(sizes + DEPTH) - (sizes + DEPTH)
    # one entry for each distinct phrase, with its smallest document
    name, trigger = phrase_names(text, begin, begin + sizes), triggers_of(text, begin)
    order = np.lexsort((docs, name, trigger))
    new = np.ones(len(order), bool)
    new[1:] = (name[order[1:]] != name[order[:-1]]) | (trigger[order[1:]] != trigger[order[:-1]]) | (sizes[order[1:]] != sizes[order[:-1]])
    again = np.flatnonzero(~new)
    new[again] = ~alike(text, begin[order[again]], begin[order[again - 1]], (sizes + DEPTH)[order[again]])
    heads = order[new]
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    # a phrase that is alone with its trigger has no string in common with others
    bounds = runs(trigger[heads])
    several = np.flatnonzero(np.repeat(np.diff(bounds) > 1, np.diff(bounds)))
    bits = np.zeros(len(heads), np.uint64)
    if len(several):
        mine = heads[several]
        later = sort_dictionary(text[stretches(begin[mine], sizes[mine] + DEPTH)], sizes[mine], docs[mine])
        offset = stretches(np.zeros(len(mine), np.int64), sizes[mine] + 1).astype(np.uint64)
        bits[several] = np.bitwise_or.reduceat(later.astype(np.uint64) << offset, np.cumsum(sizes[mine] + 1) - (sizes[mine] + 1))
    whole = (np.uint64(2) << sizes.astype(np.uint64)) - np.uint64(1)
    answer = np.where(docs > docs[heads][entry], whole, bits[entry]).astype("<u4")
    cut = np.cumsum(counts)[:-1]
    return pa.table({"block": table.column("block"), "grp": table.column("grp"), "answer": pa.array([x.tobytes() for x in np.split(answer, cut)], pa.binary())})


def _cut(flag_folder: str, bit_folder: str, hot=None):
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, bits = _Answers(flag_folder), _Answers(bit_folder)
        for row in _rows(batches):
            ids, lengths, text, parse = _open_block(row)
            steps = np.zeros(len(text) + 1, np.int32)
            if len(parse.first):
                shared = parse.shared(flags.flags(row["block"], len(parse.triggers()[0])))
                one, group = parse.distinct(shared, ids)
                dealt = parse.cold(one, ids, hot and hot.value)
                answers = np.concatenate([np.frombuffer(x, "<u4") for x in bits.of(row["block"])] or [np.zeros(0, np.uint32)])
                if len(answers) != dealt.sum():
                    raise ValueError(f"block {row['block']}: {len(answers)} answers to {dealt.sum()} phrases")
                said = np.full(len(one), 2**32 - 1, np.uint32)  # of a hot phrase that starts earlier, all strings do
                said[dealt] = answers
                size = parse.last[shared] - parse.first[shared]
                mask = np.where(ids[parse.doc[shared]] > ids[parse.doc[one]][group], 2**32 - 1, said[group]) if len(shared) else said
                place = stretches(parse.first[shared], size + 1)
                offset = stretches(np.zeros(len(shared), np.int64), size + 1)
                hit = place[(np.repeat(mask.astype(np.uint64), size + 1) >> offset.astype(np.uint64)) & np.uint64(1) == 1]
                steps += np.bincount(hit, minlength=len(steps)).astype(np.int32)
                steps -= np.bincount(hit + DEPTH, minlength=len(steps)).astype(np.int32)
            gone = np.cumsum(steps[:-1]) > 0
            ends = np.cumsum(lengths)
            out = []
            valid = np.frombuffer(row["valid"], np.uint8)
            data = np.frombuffer(text, np.uint8)
            for i, (a, b) in enumerate(zip((ends - lengths).tolist(), ends.tolist(), strict=True)):
                lost = gone[a:b]
                n = int(lost.sum())
                kept = text[a:b] if not n else data[a:b][~lost].tobytes()
                spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum()) if n else 0
                out.append((int(ids[i]) if valid[i] else None, b - a, n, spans, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)

    return cut


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document."""
    spark = docs.sparkSession
    stored = blocks(docs, id_col, text_col, min(block_bytes, 1 << (_POS - 1)))
    total = stored.agg(F.sum("size")).first()[0] or 0
    groups = max(8, -(-total // group_bytes))
    flag_folder, bit_folder = shared_dir(spark, "trigger-flags"), shared_dir(spark, "string-bits")
    counted = stored.mapInArrow(_count_triggers(groups), "grp long, block long, values binary, several binary, n long")
    _publish(counted.groupBy("grp").applyInArrow(_which_are_shared, "block long, grp long, answer binary"), flag_folder)
    hot = hot_phrases(stored, hot_blocks)
    dealt = stored.mapInArrow(_deal_phrases(groups, flag_folder, hot), "grp long, block long, bytes binary, more binary, docs binary")
    _publish(dealt.groupBy("grp").applyInArrow(_which_came_later, "block long, grp long, answer binary"), bit_folder)
    out = write_table(stored.mapInArrow(_cut(flag_folder, bit_folder, hot), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "kept")
    drop_table(stored)
    if hot is not None:
        hot.unpersist()
    return out


def prefix_free_query(spark, sf_dir: str) -> DataFrame:
    """All documents against all others."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
