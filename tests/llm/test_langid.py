import random
import sys

from pyspark.sql import functions as F

from kinmatch.llm import langid


def corpus(n=400, seed=6):
    rng = random.Random(seed)
    parts = {"en": ["the", "ing", "tion", "er", "nd"], "fr": ["ère", "eau", "que", "é", "ment"], "de": ["sch", "ung", "ü", "keit", "der"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame([*rows, (1000, None, "en"), (1001, "", "fr"), (1002, "12 !?  ", "de"), (None, "the the", None), (1003, "the thing ", None)], "doc_id long, text string, lang string").withColumn("out", langid.held_out())
    model = langid.train(docs.filter("NOT out"))
    assert model.langs == ["de", "en", "fr"]
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["lang_pred"] == "und" for i in (1000, 1001, 1002))
    held = [r for r in got.values() if r["out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 40 and sum(r["lang_pred"] == r["lang"] for r in held) > 0.97 * len(held)
    assert got[1003]["lang_pred"] == "en"


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(200).select(F.col("id").alias("doc_id"), langid.held_out().alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_backoff_goes_from_words_to_letters():
    model = langid.fit([("a", 0, "word", 9), ("b", 3, "rds", 5), ("a", 3, "wor", 1), ("b", 1, "q", 4)], {("a", 0): 9, ("b", 3): 5, ("a", 3): 1, ("b", 1): 4}, ["a", "b"])
    assert model.predict("word")[0] == "a" and model.predict("zrds")[0] == "b" and model.predict("qq")[0] == "b"
    assert model.predict("yy") == ("a", 0.5)  # nothing known: a tie, the first


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()] == [("und", 0.0)]
    clashing = docs.selectExpr("*", "1 AS score", "2 AS __text", "3 AS lang_pred")
    assert [r.asDict() for r in langid.identify(clashing, model).collect()] == [{"doc_id": 1, "text": "hello", "lang": None, "__text": 2, "lang_pred": "und", "score": 0.0}]
    assert langid.identify(clashing, model, pred_col="p", score_col="q").columns == [*clashing.columns, "p", "q"]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_letters_are_told_by_category():
    assert langid.words_of("½ ² Ⅷ ٣ 12") == []
    assert langid.words_of("हिन्दी भाषा; Été d’été e\u0301te\u0301 x² می\u200cخواهم") == ["हिन्दी", "भाषा", "été", "d", "été", "e\u0301te\u0301", "x", "می\u200cخواهم"]
    every = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000 and not langid._RARE.match(c))
    assert langid._PLAIN_WORD.findall(every) == langid._WORD.findall(every)  # the two agree where the plain one is used
    model = langid.fit([("a", 0, "word", 9)], {("a", 0): 9}, ["a"])
    assert model.predict("½ ² \u0301 42") == ("und", 0.0) and model.predict("भाषा")[0] == "a"


def brute_predict(train, text, orders=(5, 4, 3, 2, 1), min_count=2):
    """The same scores from plain dictionaries, one word at a time."""
    import math
    from collections import Counter

    counts, totals, langs = {n: Counter() for n in (0, *orders)}, Counter(), sorted({lang for _, lang in train})
    parts = lambda w, n: [w] if n == 0 else list(w) if n == 1 else [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]
    for body, lang in set(train):
        for w in body.lower().split():
            for n in (0, *orders):
                for g in parts(w, n):
                    counts[n][lang, g] += 1
                    totals[lang, n] += 1
    kept = {n: {k: c for k, c in counts[n].items() if c >= (min_count if n == 0 else 2 * min_count)} for n in counts}
    size = sum(len({g for _, g in kept[n]}) for n in kept)

    def row(n, g):
        logs = [math.log((kept[n].get((lang, g), 0) + 0.5) / (totals[lang, n] + 0.5 * size)) for lang in langs]
        return [x - sum(logs) / len(logs) for x in logs]

    total = [0.0] * len(langs)
    for w in text.lower().split():
        for n in (0, *orders):
            known = [g for g in parts(w, n) if any((lang, g) in kept[n] for lang in langs)]
            if known:
                total = [t + sum(row(n, g)[i] for g in known) / len(known) for i, t in enumerate(total)]
                break
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp((t - total[best]) / math.sqrt(len(text.split()))) for t in total)


def test_against_brute_force(spark):
    rows = corpus(120)
    docs = spark.createDataFrame([*rows, *rows[:30]], "doc_id long, text string, lang string")
    learned = [(text, lang) for i, text, lang in rows if i % 2]
    model = langid.train(docs.filter("doc_id % 2 = 1"))
    new = [("zzz", 0), ("thetion sch", 0), ("keitqu eauxyz", 0)] + [(text, i) for i, text, _ in rows[::2]]
    got = langid.identify(spark.createDataFrame(new, "text string, n int"), model).collect()
    for r in got:
        lang, score = brute_predict(learned, r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3, r


def test_bounded_sample(spark):
    docs = spark.createDataFrame(corpus(300), "doc_id long, text string, lang string")
    assert langid.train(docs, max_rows=60).langs == ["de", "en", "fr"]
    # a text on most rows is one row of the sample, or none
    popular = docs.union(docs.filter("doc_id = 1").crossJoin(spark.range(5000)).select(docs.columns))
    for limit in (60, 10**6):
        model = langid.train(popular, max_rows=limit)
        assert model.predict("zzzz")[1] < 1 and len(model.tables.get(0, {})) <= len(langid.train(docs).tables[0])
