import random

import corpus_pipeline
from kinmatch.llm.common import write_table


def test_stages(spark, tmp_path):
    rng = random.Random(21)
    parts = {"en": ["the", "ing", "tion", "er", "nd", "ow"], "fr": ["ère", "eau", "que", "é", "ment", "oi"]}
    make = lambda lang, n: [f"{''.join(rng.choices(parts[lang], k=3))}{rng.choice('abcdefgh')}" for _ in range(n)]
    rows = [(i, make("en" if i % 2 else "fr", 150), "en" if i % 2 else "fr") for i in range(40)]
    passage, leak = make("en", 70), make("en", 25)
    rows += [(100, [*make("en", 60), *passage, *make("en", 40)], "en"), (101, [*make("en", 90), *passage], "en"), (102, [*make("en", 50), *leak, *make("en", 50)], "en"), (103, [*rows[5][1][:70], "edited", *rows[5][1][71:]], "en"), (104, rows[6][1], "fr")]
    table = [(i, " ".join(w), lang, "s", len(" ".join(w))) for i, w, lang in rows] + [(105, "123 !!", "en", "s", 6), (106, None, None, None, None)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, at = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = write_table(stage(spark, at, str(tmp_path)), name)
        assert at.columns == docs.columns
        kept[name] = {r["doc_id"] for r in at.collect()}
    clean = set(range(40)) | {100, 101}
    assert kept["language"] == clean | {102, 103, 104}
    assert kept["near_duplicates"] == clean | {102} == kept["repeated_passages"]
    assert kept["decontamination"] == clean
    text = {r["doc_id"]: r["text"].split() for r in at.collect()}
    assert len(text[100]) == 170 and len(text[101]) == 90
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == clean


EDGES = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, doc string, __text int, __lang int, seed int"


def edge_rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices(["the", "ing", "er", "nd", "on"], k=3))
    make = lambda n: " ".join(word() for _ in range(n))
    passage, rows = make(80), []
    for i in range(30):
        rows.append((i, f"{make(40)} {passage} {make(30)}" if i in (4, 9) else make(rng.randint(40, 120))))
    rows += [rows[3], rows[3], (40, None), (41, ""), (42, "12 ... !"), (None, make(50)), (43, make(5000)), (44, rows[6][1])]
    return [(i, t, "en" if i is None or i % 2 else None, None, None, 0.1, "x", "y", 1, 2, 3) for i, t in rows]


def test_edges_of_every_stage(spark, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeated rows and columns of the operators' names."""
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGES)
    spark.createDataFrame([(1, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: str((r["doc_id"], r["text"]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        got = left.collect()
        assert left.columns == docs.columns, name
        assert all(r["score"] == 0.1 and r["lang_pred"] == "x" and r["__text"] == 1 and r["__lang"] == 2 for r in got)
        ids = sorted((r["doc_id"] for r in got), key=str)
        every = sorted((r[0] for r in rows), key=str)
        if name == "language":
            assert ids == sorted((r[0] for r in rows if r[0] not in (40, 41, 42)), key=str)
        elif name == "near_duplicates":
            assert ids == sorted([*range(30), 40, 42, 43, None], key=str)
        elif name == "repeated_passages":
            texts = {r["doc_id"]: r for r in got}
            assert ids == [i for i in every if i != 44] and len(texts[9]["text"].split()) == 70 and texts[9]["n_chars"] == len(texts[9]["text"])
            assert all(texts[r[0]]["text"] == r[1] for r in rows if r[0] not in (9, 44))
        else:
            assert sorted(map(key, got)) == sorted(str((r[0], r[1])) for r in rows)
    packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in rows} and sum(r["start"] == 0 for r in packed) == len(rows)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], EDGES)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, str(tmp_path))
        assert left.count() == 0 and (name == "packing" or left.columns == docs.columns)
