import hashlib
import random

import numpy as np
import pytest

from kinmatch.llm import prefix_free


def brute(rows, depth=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        if i is not None:
            for p in range(len(t) - depth + 1):
                w = t[p : p + depth]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        if i is not None:
            for p in range(len(t) - depth + 1):
                if first[t[p : p + depth]] < i:
                    gone[p : p + depth] = b"\1" * depth
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes,group_bytes", [(2_000_000, 24_000_000), (700, 500)])
def test_against_brute_force(spark, documents, block_bytes, group_bytes):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rng = random.Random(4)
    rows += [(200 + i, "ab" * rng.randint(20, 90)) for i in range(4)] + [(210, "z" * 300), (211, "z" * 49), (212, "y" + "z" * 50), (213, "\0" * 120), (214, "x" + "\0" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in prefix_free.remove_repeats(docs, block_bytes=block_bytes, group_bytes=group_bytes).collect()), key=str)
    want = brute(rows)
    assert got == want and sum(x[2] for x in want) > 1000


def test_hot_phrases_change_nothing(spark, documents, monkeypatch):
    rng = random.Random(6)
    popular = "".join(rng.choices("abcdef ", k=400))
    rows = [(i, f"{rng.random()} {popular[rng.randrange(60) : 400 - rng.randrange(60)] if i % 3 else ''} {rng.random()}" * (1 + i % 2)) for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, popular), rows[7]], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(prefix_free, "HOT_SAMPLE", 1)
    monkeypatch.setattr(prefix_free, "_CHUNK", 1 << 11)  # blocks of several portions
    for block_bytes, hot_blocks in ((700, 3), (8000, 1)):
        stored = prefix_free.blocks(docs, "doc_id", "text", block_bytes)
        hot = prefix_free.hot_phrases(stored, hot_blocks).value
        assert len(hot.first) > 5 and (hot_blocks == 1 or set(hot.first.tolist()) <= {1, 2, 4, 5})
        got = prefix_free.remove_repeats(docs, block_bytes=block_bytes, group_bytes=500, hot_blocks=hot_blocks)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute([*rows, (None, popular), rows[7]])


def test_names_in_any_order():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 100_000).astype(np.uint8).tobytes()
    parse = prefix_free.Parse(text, np.array([len(text)]), np.ones(1, bool))
    every = np.arange(len(parse.first))
    names, mixed = parse.names(every), rng.permutation(every)
    assert (parse.names(mixed) == names[mixed]).all() and len(np.unique(names)) > 1000


def test_equal_hashes_of_other_bytes(monkeypatch, spark, documents):
    """With names of two bits, phrases are still told apart."""
    few = prefix_free.phrase_names
    monkeypatch.setattr(prefix_free, "phrase_names", lambda *a: few(*a) & np.uint64(3))
    texts = [r["text"] for r in documents.collect() if r["text"]]
    text, lengths = "".join(texts).encode(), np.array([len(t.encode()) for t in texts])
    parse = prefix_free.Parse(text, lengths, np.ones(len(texts), bool))
    one, back = parse.distinct(np.arange(len(parse.first)), np.arange(len(texts)))
    of = lambda p: (int(parse.trigger[p]), parse.text[parse.first[p] : parse.last[p] + 50].tobytes())
    assert len({of(p) for p in one}) >= 0.9 * len(one) and all(of(one[back[p]]) == of(p) for p in range(len(parse.first)))


def test_nothing(spark, nothing):
    assert prefix_free.remove_repeats(nothing).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for top in (2**20, 2**40, 2**60):
        x = np.sort(rng.integers(0, top, 1000)).astype(np.uint64)
        assert (prefix_free.unpack_sorted(prefix_free.pack_sorted(x)) == x).all()
    assert len(prefix_free.unpack_sorted(prefix_free.pack_sorted(np.zeros(0, np.uint64)))) == 0


def test_rolling_hash_depends_on_the_bytes_alone():
    x = np.frombuffer(b"0123456789" * 30, np.uint8)
    h = prefix_free.rolling(x, 50)
    assert len(h) == len(x) - 49 and len(set(h.tolist())) == 10
    assert len(prefix_free.rolling(x[:49], 50)) == 0
