import random

import numpy as np
import xxhash

from kinmatch.llm import simhash


def brute_print(text, width=3):
    w = bytes(text or "", "utf8").lower().split()
    shingles = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance):
    names = list(prints)
    low = {i: i for i in range(len(names))}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    ids = {}
    for i in range(len(names)):
        if prints[i][0] is not None:
            ids[root(i)] = min(ids.get(root(i), 10**9), prints[i][0])
    return sorted(((p[0], f"{p[1]:016x}", ids.get(root(i))) for i, p in enumerate(prints)), key=str)


def test_query_against_brute_force(spark, documents, nothing):
    prints = [(r["doc_id"], brute_print(r["text"])) for r in documents.collect()]
    got = simhash.near_duplicates(documents).collect()
    assert sorted(((r["id"], f"{r['f0'] & (2**64 - 1):016x}", r["component_id"]) for r in got), key=str) == brute_components(prints, 3)
    assert simhash.near_duplicates(nothing).count() == 0


def test_no_link_is_lost_at_any_plan(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        centre = rng.getrandbits(64)
        rows += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(12)]
    prints = list(enumerate(rows))
    table = spark.createDataFrame([(i, x - 2**64 if x >= 2**63 else x, 10) for i, x in prints], "id long, f0 long, size int").cache()
    monkeypatch.setattr(simhash, "fingerprints", lambda *a, **k: table)
    for distance in (0, 3, 5):
        want = brute_components(prints, distance)
        for cost in (1, 100, 100_000):  # from many parts to few
            monkeypatch.setattr(simhash, "ROW_COST", cost)
            for short in (2, 24):
                monkeypatch.setattr(simhash, "SHORT", short)
                got = simhash.near_duplicates(table, distance=distance).collect()
                assert sorted(((r["id"], f"{r['f0'] & (2**64 - 1):016x}", r["component_id"]) for r in got), key=str) == want


def test_allocation_keeps_the_pigeonhole_sum():
    share, correlation = np.full(64, 0.5), np.eye(64)
    correlation[3, 40] = correlation[40, 3] = 0.9
    for n in (10, 10**5, 10**8):
        for distance in (3, 8):
            parts = simhash.plan(n, share, correlation, distance)
            skipped = 64 - sum(len(b) for b, _ in parts)
            count = next(c for c in range(1, distance + 2) if len(simhash.correlated_parts(correlation, c)) == c and all(b in simhash.correlated_parts(correlation, c) for b, _ in parts))
            assert sum(t for _, t in parts) - (count - len(parts)) >= distance - count + 1
            assert skipped >= 0
    assert any({3, 40} <= set(b) for b in simhash.correlated_parts(correlation, 4))


def test_copies_go_and_others_stay(spark):
    rng = random.Random(8)
    make = lambda: [f"w{rng.randrange(5000)}" for _ in range(200)]
    base = [make() for _ in range(12)]
    near = [[*b[:100], "edited", *b[101:]] for b in base[:6]]
    rows = [(i, " ".join(x)) for i, x in enumerate([*base, *near, *base[:3]])]
    docs = spark.createDataFrame([*rows, rows[9]], "doc_id long, text string")
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(12)) and kept.columns == docs.columns


def jaccard(a, b, width=5):
    x, y = ({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} for w in (a, b))
    return len(x & y) / len(x | y)


def test_only_similar_copies_go(spark):
    rng = random.Random(17)
    rows, want = [], {}
    for i in range(120):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 400))]
        copy = list(words)
        for at in rng.sample(range(len(words)), max(1, int(len(words) * rng.uniform(0.002, 0.09)))):
            copy[at] = "edited"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
        want[i] = jaccard(words, copy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    gone = {i for i in want if 2 * i + 1 not in kept}
    assert kept >= {2 * i for i in want}
    assert not [want[i] for i in gone if want[i] < 0.8]
    near = [i for i in want if want[i] >= 0.8]
    assert len(near) > 20 and len(want) - len(near) > 20
    assert {i for i in near if want[i] >= 0.9} <= gone
    assert len(gone) >= 0.9 * len(near)


def test_copies_among_texts_that_look_alike_go(spark):
    rng = random.Random(5)
    texts, want = [], set()
    for _ in range(8):
        base = [f"w{rng.randrange(9000)}" for _ in range(424)]
        places = [rng.sample(range(3, 420, 5), 6) for _ in range(40)]
        places.append([*places[0][:2], *rng.sample([p for p in range(3, 420, 5) if p not in places[0]], 4)])
        for own in places:
            texts.append([f"own{len(texts)}" if at in own and not (own is places[-1] and at in places[0]) else w for at, w in enumerate(base)])
        for at in places[0][:2]:  # changes that the pair has in common
            texts[-1][at] = texts[-41][at]
        assert jaccard(texts[-1], texts[-41]) >= 0.8
        want.add(len(texts) - 1)
    family = [texts[i : i + 41] for i in range(0, len(texts), 41)]
    gone = set()
    for k, f in enumerate(family):
        least = list(range(41))
        for i, j in ((i, j) for j in range(41) for i in range(j) if jaccard(f[i], f[j]) >= 0.8):
            least = [min(least[i], least[j]) if x in (least[i], least[j]) else x for x in least]
        gone |= {41 * k + j for j in range(41) if least[j] < j}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert want <= gone and kept == set(range(len(texts))) - gone
    settings = {"width": 5, "distance": 13, "lanes": 2, "total": 32, "similarity": 0.8}
    for cell in (9, 2):  # families in many cells, and so thin by the limit that their pairs are listed
        found = simhash.near_duplicates(docs, cell=cell, **settings).collect()
        assert {r["id"] for r in found if r["component_id"] == r["id"]} == kept


def test_cells_find_all_similar_pairs(spark):
    from kinmatch.llm.components import components

    rng = random.Random(3)
    sets = [sorted({rng.randrange(60) for _ in range(rng.randint(10, 50))}) for _ in range(60)]
    sets += [s[: int(len(s) * 0.9)] for s in sets[:20]]
    rows = [(i, i % 7 if i < 40 else i, i % 2, len(s), s) for i, s in enumerate(sets)]
    held = spark.createDataFrame(rows, "node long, root long, family long, size int, shingles array<int>")
    for cell in (1024, 10, 3):
        members = held.selectExpr("node", "root", "family", "40L AS n", "1000L AS shingles_of")
        links = simhash.family_links(members, held.select("node", "shingles"), 0.8, cell)
        got = {r["node"]: r["root"] for r in components(links).collect()}
        label = list(range(len(sets)))
        for i, j in ((i, j) for j in range(len(sets)) for i in range(j) if i % 2 == j % 2 and rows[i][1] != rows[j][1]):
            x, y = set(sets[i]), set(sets[j])
            if len(x & y) >= 0.8 * len(x | y):
                label = [label[i] if v == label[j] else v for v in label]
        assert len(got) >= 20 and all((got.get(i, -1 - i) == got.get(j, -1 - j)) == (label[i] == label[j]) for i in range(len(sets)) for j in range(i))


def test_large_buckets_in_tiles(spark, monkeypatch):
    rng = random.Random(12)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(300)]
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, 1) for p in set(prints)], "f0 long, size int")
    parts = [(list(range(0, 32)), 1), (list(range(32, 64)), 1)]
    links = lambda **how: simhash.dealt_signatures(frame, parts, 1, **how).mapInArrow(simhash._bucket_links(3, 0.0, 1), "a long, b long")
    from kinmatch.llm.components import components

    groups = lambda found: sorted(sorted(g) for g in _grouped({r["node"]: r["root"] for r in components(found).collect()}).values())
    want = groups(links())
    monkeypatch.setattr(simhash, "HOT_SAMPLE", 1)
    assert groups(links(bucket_rows=20)) == want and len(want) >= 1 and max(map(len, want)) > 5


def _grouped(roots):
    out = {}
    for node, root in roots.items():
        out.setdefault(root, set()).add(node)
    return out


def test_spanning_forest_keeps_every_threshold():
    from kinmatch.llm.components import forest, spanning

    rng = np.random.default_rng(4)
    for n in (2, 10, 60):
        a, b, w = rng.integers(0, n, 4 * n) - 7, rng.integers(0, n, 4 * n) - 7, rng.integers(0, 30, 4 * n)
        x, y, v = spanning(a, b, w)
        given = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), w.tolist(), strict=True))
        assert {(int(min(p)), int(max(p)), int(q)) for *p, q in zip(x, y, v, strict=True)} <= given and len(x) < n
        for limit in (3, 12, 30):
            part = lambda p, q, k: [t.tolist() for t in forest(p[k <= limit], q[k <= limit])]  # noqa: B023, E731
            assert part(a, b, w) == part(x, y, v)
