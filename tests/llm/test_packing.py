import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from kinmatch.llm.packing import encoder, first_fit_decreasing, pack, pieces, tokenizer_path


def test_tree_is_first_fit_decreasing():
    rng = random.Random(1)
    for _ in range(30):
        lengths = np.array([rng.randint(1, 50) for _ in range(rng.randint(0, 80))], dtype=np.int64)
        bins, offsets = first_fit_decreasing(lengths, 50)
        rooms, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            b = next((b for b, r in enumerate(rooms) if r >= lengths[i]), len(rooms))
            if b == len(rooms):
                rooms.append(50)
            want[i] = (b, 50 - rooms[b])
            rooms[b] -= lengths[i]
        assert {i: (int(bins[i]), int(offsets[i])) for i in range(len(lengths))} == want


def test_ids_are_the_librarys():
    t = Tokenizer.from_file(tokenizer_path())
    texts = ["", " ", "a  b\n\n c\t", "it's  you'LL", "naïve élan ß 12½ ²", "x y\x1cz\x85w᠎", "日本語 ٣٤ हिन्दी", "<|endoftext|> a", "hello <|endoftext|> world", "<|endoftext|><|endoftext|>é<|endof", "!!??  ...", "\r\n\r\n  x", "a b", "‘q’ “r” – €5", "\x00\x07"]
    rng = random.Random(2)
    texts += ["".join(rng.choices("aé 's\n\t1½!²ßÿ×÷«€–", k=40)) for _ in range(300)]
    fast = encoder(tokenizer_path())
    assert fast.ids("hello <|endoftext|> world").tolist() == [31373, 220, 50256, 995]
    for x in texts:
        assert fast.ids(x).tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_packed_whole_and_tight(spark, documents, nothing):
    rows = pack(documents, length=128, group_pieces=16).collect()
    ids = {}
    fast = encoder(tokenizer_path())
    for r in documents.collect():
        ids[r["doc_id"]] = np.append(fast.ids(r["text"] or ""), np.uint32(1)).astype("<u4")
    seen, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    times = defaultdict(int)
    for r in documents.collect():
        times[r["doc_id"]] += 1
    for doc, parts in seen.items():
        want = [(s, min(128, len(ids[doc]) - s)) for s in range(0, len(ids[doc]), 128)]
        assert sorted(parts) == sorted(want * times[doc])
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 128
    assert set(seen) == set(ids)
    assert len(bins) * 128 <= 1.25 * sum(len(x) for d, x in ids.items() for _ in range(times[d])) + 128 * 8
    assert pack(nothing).count() == 0
    with_ids = pieces(documents, path=tokenizer_path(), with_ids=True).filter("id = 30").collect()
    assert [x for r in with_ids for x in r["ids"]] == ids[30].tolist()
