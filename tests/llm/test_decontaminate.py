import random
import re
import subprocess
import sys

from kinmatch.llm import decontaminate
from kinmatch.llm.decontaminate import Automaton, drop_contaminated, find_contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, width=10):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, body in items:
            b = words(body)
            for a in range(max(1, len(b) - width + 1)) if b else ():
                g = b[a : a + width]
                for k in range(len(w) - len(g) + 1):
                    if w[k : k + len(g)] == g:
                        hit |= set(range(k, k + len(g)))
                        names.add(name)
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out, key=str)


def test_against_brute_force(spark, documents, nothing):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    long = next(t for i, t in docs if t and len(t.split()) > 250)
    items = [("1", " ".join(long.split()[5:40]).upper()), ("2", "changed"), ("3", ""), ("4", None), ("10", "the...ON--er"), ("5", " ".join(long.split()[30:39])), ("null", "nowhere"), ("6", "ré é")]
    bench = spark.createDataFrame([(None if n == "null" else int(n), t, "q") for n, t in items], "item_id long, text string, doc_id string")
    want = brute(docs, items)
    assert sum(x[2] > 0 for x in want) >= 3
    for size in (8_000_000, 60):  # one automaton, and several rounds
        got = find_contamination(documents, bench, automaton_bytes=size)
        assert sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str) == want
        left = drop_contaminated(documents, bench, automaton_bytes=size)
        assert left.columns == documents.columns
        assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted((x[0] for x in want if not x[2]), key=str)
    assert find_contamination(nothing, bench).count() == 0
    assert find_contamination(documents, bench.limit(0)).filter("contaminated").count() == 0


def test_automaton_against_brute_force():
    rng = random.Random(14)
    for width in (1, 2, 3, 5, 10):
        for _ in range(60):
            letters = "abc"[: rng.randint(1, 3)]
            some = lambda n: " ".join(rng.choices(letters, k=n))  # noqa: B023, E731
            items = [(str(i), some(rng.randint(0, 25))) for i in range(rng.randint(1, 5))]
            text = some(rng.randint(0, 60))
            auto = Automaton([(n, t.encode()) for n, t in items], width)
            hit, found = auto.scan(text.encode().split())
            [(_, n, hits, names)] = brute([(0, text)], items, width)
            assert (len(hit), int(hit.sum()), sorted({auto.names[x] for x in found})) == (n, hits, names)


def test_long_items_are_cut(spark, documents, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(str(i), f"{t} {i} {t}") for i, t in docs if t and i is not None and i % 9 == 0]
    bench = spark.createDataFrame([(int(n), t) for n, t in items], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 30)
    got = find_contamination(documents, bench)
    assert sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str) == brute(docs, items)


def test_memory_of_a_full_automaton():
    """At its limit an automaton of random words takes less than 300 MB of its worker."""
    code = """
import random, resource
from kinmatch.llm.decontaminate import AUTOMATON_BYTES, ITEM_WORDS, Automaton
rng, items, size = random.Random(1), [], 0
while size < AUTOMATON_BYTES:
    items.append((str(len(items)), " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(ITEM_WORDS)).encode()))
    size += len(items[-1][1])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
auto = Automaton(items, 10)
assert auto.scan(items[3][1].split())[1] == {3}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    used = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    print(f"{used:.0f} MB")
    assert used < 300


def test_spans_are_places_in_the_original(spark):
    docs = spark.createDataFrame([(1, "Été -- One,TWO\tthree; fin")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two THREE")], "item_id long, text string")
    row = find_contamination(docs, bench).first()
    assert [("Été -- One,TWO\tthree; fin")[s["start"] : s["end"]] for s in row["spans"]] == ["One,TWO\tthree"]
