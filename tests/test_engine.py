"""The engine end to end on a small linkage fixture, with expected values, and operators by hand-made cases."""

import gzip
import json
import math
import shutil
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinmatch.functions import hashing, similarity, text
from kinmatch.functions.constants import FEATURES, INDEX_COLUMNS
from kinmatch.operators import blocking, cleaning, evaluation, features, guards, labeling, modeling, sampling, tfidf
from kinmatch.plans import cli, pipeline
from kinmatch.plans.config import Preparation
from kinmatch.sources import readers, sinks


def record(entity_id, name="", address="", country="US"):
    filled = {c: "" for c in INDEX_COLUMNS} | {c: name for c in ("name_basic", "name_expanded", "name_without_suffix", "name_latin_folded")} | {c: address for c in ("address_normalized", "address_latin_folded")}
    return filled | {"entity_id": entity_id, "country_key": country, "name_missing": int(not name), "address_missing": int(not address)}


def frame(spark, rows):
    kinds = ", ".join(f"{c} {'int' if c.endswith('missing') else 'string'}" for c in INDEX_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in INDEX_COLUMNS) for r in rows], kinds)


def linkage(spark):
    return {
        1: frame(spark, [record("S1-a", "abc motors", "105 elm street"), record("S1-empty"), record("S1-missed")]),
        2: frame(spark, [record("S2-a", "abc motors", "105 elm street"), record("S2-unseen", "unrelated"), record("S2-fr", "abc motors", "105 elm street", "FR")]),
        3: frame(spark, [record("S3-a", "abc motors", "105 elm street")]),
    }


def linkage_truth(spark):
    return spark.createDataFrame([("S1-a", "S2-a,S3-a"), ("S1-empty", ""), ("S1-missed", "S2-unseen")], "source1_entity_id string, matched_entity_ids string")


SMALL = Preparation(hash_bits=12, block_limit=1, lexical_pool=5, lexical_top_k=5, max_candidates=5)


@pytest.mark.parametrize("retrieval", ["rowid", "bm25"])
def test_linkage(spark, tmp_path, retrieval):
    config = Preparation.load(None, **(SMALL.as_dict() | {"retrieval": retrieval}))
    work = pipeline.prepare(spark, linkage(spark), str(tmp_path / "w"), config, truth=linkage_truth(spark))
    pairs = work.table("candidate_pairs").collect()
    assert {p["candidate_entity_id"] for p in pairs} == {"S2-a", "S3-a"} and len(pairs) == 2
    overall = next(r for r in labeling.recall_report(work.table("query_labels")).collect() if r["grouping"] == 3)
    assert overall["candidate_recall"] == pytest.approx(2 / 3) and overall["oracle_macro_f05_ceiling"] == pytest.approx(2 / 3)
    lines = (tmp_path / "w" / "candidate_pairs.tsv").read_text().splitlines()
    assert len(lines) == 4 and lines[2] == "S1-empty\t" and lines[3] == "S1-missed\t"
    made = work.table("pair_features").collect()
    assert all(p["label"] == 1 for p in made) and all(f in made[0] for f in FEATURES)
    labels = work.table("query_labels").withColumn("dataset_split", F.lit("validation"))
    scores = work.table("candidate_pairs").select(*evaluation.PAIR, F.lit(0.9).alias("match_probability"))
    found = evaluation.evaluate(labels, work.table("pair_features"), scores, [0.5, 0.95])
    assert found["best"]["macro_f05"] == pytest.approx(2 / 3) and found["queries"] == 3
    for bad in (scores.limit(0), scores.union(scores), scores.withColumn("match_probability", F.lit(1.5))):
        with pytest.raises(ValueError):
            evaluation.evaluate(labels, work.table("pair_features"), bad, [0.5])
    made = {p.name for p in (tmp_path / "w").iterdir()}
    assert {"train_features.parquet", "validation_features.parquet", "tables_report.json", "query_labels.tsv.gz"} <= made
    assert len(gzip.open(tmp_path / "w" / "query_labels.tsv.gz", "rt").read().splitlines()) == 4
    other = linkage(spark) | {3: frame(spark, [record("S3-a", "abc motors", "106 elm street")])}
    for tables, settings in ((linkage(spark), Preparation()), (other, config)):  # other settings, other inputs
        with pytest.raises(ValueError, match="other settings"):
            pipeline.prepare(spark, tables, str(tmp_path / "w"), settings, truth=linkage_truth(spark))
    if retrieval == "bm25":
        return
    assert pipeline.prepare(spark, linkage(spark), str(tmp_path / "w"), config, truth=linkage_truth(spark)).manifest == work.manifest  # nothing runs again
    part = pipeline.prepare(spark, linkage(spark), str(tmp_path / "part"), config, truth=linkage_truth(spark), max_queries=1, stages=("index", "block"))
    with pytest.raises(ValueError, match="every query"):
        pipeline.submit(part, scores, 0.5, str(tmp_path / "none.tsv"))
    with pytest.raises(ValueError, match="are gone"):
        shutil.rmtree(tmp_path / "part" / "queries.parquet")
        pipeline.prepare(spark, linkage(spark), str(tmp_path / "part"), config, truth=linkage_truth(spark), max_queries=1, stages=("index", "block"))
    assert pipeline.submit(work, scores, 0.5, str(tmp_path / "out.tsv")) == 3
    assert (tmp_path / "out.tsv").read_text().splitlines()[1] == "S1-a\tS2-a,S3-a"


def brute_candidates(queries, references, limits, bits):
    """Every step by definition, a query at a time."""
    import collections

    def name(r):
        return r["name_latin_folded"] or r["name_without_suffix"] or r["name_basic"]

    def address(r):
        return r["address_latin_folded"] or r["address_normalized"]

    def terms(s):
        out = []
        for w in s.split():
            p = f" {w} "
            out += [f"w:{w}"] + [f"{n}:{p[i : i + n]}" for n in (3, 4, 5) for i in range(len(p) - n + 1)]
        return out

    def tokens(s):
        return {f"w:{w}" for w in s.split()} | {f"3:{p[i : i + 3]}" for w in s.split() for p in [f" {w} "] for i in range(max(1, len(p) - 2))}

    def keys(r):
        n, out = name(r), collections.defaultdict(set)
        for kind, v in (("basic", r["name_basic"]), ("core", n), ("sorted", " ".join(sorted(n.split())))):
            if v:
                out["A"].add((kind, v))
        prefix = "".join(n.split())[:3]
        if len(prefix) == 3:
            out["B"].add(prefix)
            if r["house_number_zero_normalized"]:
                out["D"].add((r["house_number_zero_normalized"], prefix))
        if r["state_candidate"] and r["postal_code_candidate"]:
            out["C"].add(("postal", r["state_candidate"], r["postal_code_candidate"]))
        if city := r["city_candidate"]:
            for t in set(address(r).split()) - {"road", "street", "avenue", "lane", "block", "near", "and", "the"} - set(city.split()):
                if len(t) >= 3 and not t.isdigit():
                    out["C"].add(("token", city, t))
            if n.split():
                out["C"].add(("name", city, " ".join(n.split()[:3])))
        return out

    df = {f: collections.Counter(b for r in references for b in {hashing.term_bucket(t, bits) for t in terms(g(r))}) for f, g in (("name", name), ("address", address))}
    import numpy as np

    idf = lambda f, t: float(np.float32(math.log((len(references) + 1) / (df[f][hashing.term_bucket(t, bits)] + 1)) + 1))

    def vector(s, f):
        tf = collections.Counter(hashing.term_bucket(t, bits) for t in terms(s))
        weights = {hashing.term_bucket(t, bits): idf(f, t) for t in terms(s)}
        v = {b: (1 + math.log(c)) * weights[b] for b, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {b: x / norm for b, x in v.items()}

    def cosine(a, b):
        return min(1.0, max(0.0, sum(x * b.get(i, 0) for i, x in a.items()))) if a and b else None

    refs = [(i, r, keys(r), {("name", t) for t in tokens(name(r))} | {("address", t) for t in tokens(address(r))}, vector(name(r), "name"), vector(address(r), "address")) for i, r in enumerate(references)]
    found = {}
    for q in queries:
        asked = {f: {(f, t) for t in sorted(tokens(g(q)), key=lambda t, f=f: (-idf(f, t), t))[: limits.query_terms]} for f, g in (("name", name), ("address", address))}
        pool = [r for r in refs if not q["country_key"] or r[1]["country_key"] in (q["country_key"], "")]
        qk, qn, qa, chosen, over = keys(q), vector(name(q), "name"), vector(address(q), "address"), collections.defaultdict(set), set()
        for c in "ABCD":
            hits = [r for r in pool if qk[c] & r[2][c]]
            if len(hits) > limits.block_limit:
                over.add(c)
                hits = [r for r in hits if (asked["name"] | asked["address"]) & r[3]][: limits.block_limit]
            for r in hits:
                chosen[r[0]].add(c)
        for c, f, k, mine in (("E", "name", 4, qn), ("F", "address", 5, qa)):
            hits = [r for r in pool if asked[f] & r[3]][: limits.lexical_pool]
            for r in sorted(hits, key=lambda r: (-(cosine(mine, r[k]) or 0.0), r[1]["entity_id"]))[: limits.lexical_top_k]:
                chosen[r[0]].add(c)
        ranked = []
        for i, channels in chosen.items():
            r = refs[i]
            same = bool(q["name_basic"]) and q["name_basic"] == r[1]["name_basic"]
            score = 0.55 * (cosine(qn, r[4]) or 0) + 0.3 * (cosine(qa, r[5]) or 0) + 0.1 * same + 0.01 * len(channels)
            ranked.append((-round(score, 9), r[1]["entity_id"], "".join(sorted(channels))))
        found[q["entity_id"]] = (sorted(ranked)[: limits.max_candidates], "".join(sorted(over)))
    return found


def test_blocking_against_brute_force(spark):
    import random

    rng = random.Random(17)
    vocabulary = ["acme", "sons", "blue", "motor", "delta", "río", "x1", "of"]
    rows = []
    for i in range(90):
        s = 1 if i < 25 else 2 if i < 60 else 3
        r = record(f"S{s}-{i:03d}", " ".join(rng.choices(vocabulary, k=rng.randint(0, 3))), " ".join(rng.choices(["12", "elm", "oak", "street", "main", "lake"], k=rng.randint(0, 4))), rng.choice(["US", "US", "FR", ""]))
        r |= {"city_candidate": rng.choice(["", "lake town"]), "state_candidate": rng.choice(["", "TX"]), "postal_code_candidate": rng.choice(["", "78701"]), "house_number_zero_normalized": rng.choice(["", "12"])}
        rows.append(r)
    queries, references = rows[:25], rows[25:]
    for limits in (blocking.Limits(4, 6, 3, 9, 5), blocking.Limits(100, 120, 25, 80, 16)):
        refs = frame(spark, references).withColumn("source", F.substring("entity_id", 2, 1).cast("int")).withColumn("rid", F.substring("entity_id", 4, 3).cast("long"))
        model = tfidf.fit(refs, bits=14)
        pairs, manifest = blocking.Blocker(refs, model, limits).candidates(frame(spark, queries))
        want = brute_candidates(queries, references, limits, 14)
        got = {q["entity_id"]: [] for q in queries}
        for p in pairs.orderBy("source1_entity_id", "candidate_rank").collect():
            got[p["source1_entity_id"]].append((p["candidate_entity_id"], "".join(c for c in "ABCDEF" if p[f"block_{c}"])))
        over = {r["source1_entity_id"]: r["overflow_blocks"].replace(",", "") for r in manifest.collect()}
        assert over == {k: v[1] for k, v in want.items()}
        for sid, (ranked, _) in want.items():
            assert sorted(got[sid]) == sorted((e, c) for _, e, c in ranked), sid


def test_cleaner(spark):
    rows = [("S1-1", "M/s. A.B.C. Pvt. Ltd.", "105 Elm St, Austin, TX 78701", "United States"), ("S1-2", "Acme & Sons (ID: 42) Inc", "<null>, Nr Temple, MG Rd, Mumbai, Maharashtra, 400001", "ind"), ("S1-3", "N/A", "12 av Foch, 75001 Paris", "France"), ("S1-4", "Straße &amp; Café Co", None, "Peru")]
    got = {r["entity_id"]: r for r in cleaning.clean_records(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")).collect()}
    a, b, c, d = (got[f"S1-{i}"] for i in (1, 2, 3, 4))
    assert (a["name_basic"], a["name_expanded"], a["name_without_suffix"], a["name_token_key"], a["name_compact"], a["name_missing"], a["name_had_id_tag"]) == ("m s abc pvt ltd", "m s abc private limited", "m s abc", "abc m s", "msabc", 0, 0)
    assert (a["country_key"], a["address_basic"], a["address_normalized"], a["address_numbers"], a["house_number_candidate"], a["postal_code_candidate"], a["state_candidate"], a["city_candidate"], a["street_candidate"]) == ("US", "105 elm st austin tx 78701", "105 elm street austin tx 78701", "105|78701", "105", "78701", "TX", "austin", "105 elm street")
    assert (b["name_basic"], b["name_expanded"], b["name_without_suffix"], b["name_had_id_tag"]) == ("acme and sons id 42 inc", "acme and sons incorporated", "acme and sons", 1)
    assert (b["country_key"], b["address_normalized"], b["postal_code_candidate"], b["state_candidate"], b["city_candidate"], b["address_component_missing"], b["house_number_candidate"]) == ("IN", "near temple mg road mumbai maharashtra 400001", "400001", "maharashtra", "mumbai", 1, "")
    assert (c["name_normalized_unicode"], c["name_missing"], c["name_basic"], c["country_key"], c["address_normalized"], c["postal_code_candidate"], c["house_number_candidate"], c["city_candidate"], c["street_candidate"]) == ("n/a", 1, "", "FR", "12 avenue foch 75001 paris", "75001", "12", "", "12 avenue foch")
    assert (d["name_basic"], d["name_latin_folded"], d["country_key"], d["address_missing"]) == ("strasse and café co", "strasse and cafe", "PERU", 1)
    few = spark.createDataFrame([("0012-b007", "éà भारतीय"), ("०१२ x0 00", "ế ø ﬁ"), ("٠٣", "e\u0301 ι\u0308\u0301")], "n string, t string").select(text.zero_normalize("n"), text.latin_fold("t")).collect()
    assert [tuple(r) for r in few] == [("12-b7", "ea भारतीय"), ("12 x0 0", "e ø ﬁ"), ("3", "e ΐ")]
    with pytest.raises(ValueError):
        cleaning.clean_records(spark.createDataFrame([("a",)], "entity_id string"))


def test_folding(spark):
    """Of each kind of character, in Python and in the JVM."""
    rows = ["A.B.C. x.y a.b.cd é.b.", "Tom &amp; &lt;Co&gt; & AT&T", "a\u200cb\u200bc\x07d\u00a0e\u2003f", "ﬁ ½ ² Ⅷ ß İ", "12/3-b -x- a/ 7--8", "हिन्दी-தமிழ்", "", " \t\n ", "x_y.z"]
    got = spark.createDataFrame([(r,) for r in rows], "s string").select("s", text.unicode_normalize("s").alias("u"), text.basic("s").alias("b"), text.basic("s", True).alias("a")).collect()
    found = {r["s"]: (r["u"], r["b"], r["a"]) for r in got}
    assert found["A.B.C. x.y a.b.cd é.b."] == ("a.b.c. x.y a.b.cd é.b.", "abc x y abcd é b", "abc x y abcd é b")
    assert found["Tom &amp; &lt;Co&gt; & AT&T"][:2] == ("tom & <co> & at&t", "tom and co and at and t")
    assert found["a\u200cb\u200bc\x07d\u00a0e\u2003f"][:2] == ("a\u200cbc d e f",) * 2
    assert found["ﬁ ½ ² Ⅷ ß İ"][0] == "fi 1⁄2 2 viii ss i̇"
    assert found["12/3-b -x- a/ 7--8"][1:] == ("12 3 b x a 7 8", "12/3-b x a 7 8")
    assert found["हिन्दी-தமிழ்"][1:] == ("हिन्दी தமிழ்", "हिन्दी-தமிழ்") or found["हिन्दी-தமிழ்"][2] == "हिन्दी தமிழ்"
    assert found[""] == ("", "", "") == found[" \t\n "] and found["x_y.z"][1] == "x y z"


def test_hash_parity():
    assert hashing.split_share(42, "US", True, "S1-a") == pytest.approx(0.630782667, abs=1e-8)
    assert hashing.split_share(42, "US", False, "S1-empty") == pytest.approx(0.594050097, abs=1e-8)
    assert hashing.split_share(42, "US", True, "S1-missed") == pytest.approx(0.165457283, abs=1e-8)
    assert [hashing.term_bucket(t, b) for t, b in (("w:abc", 12), ("w:abc", 18), ("3: ab", 12), ("3: ab", 18), ("w:भारतीय", 12), ("w:भारतीय", 18))] == [2218, 194730, 2963, 11155, 2124, 18508]


def test_cosine_of_reordered_words(spark):
    refs = frame(spark, [record("S2-a", "holloway peak seafood"), record("S3-a", "seafood holloway peak"), record("S3-b", "भारतीय தமிழ்"), record("S3-c")])
    model = tfidf.fit(refs, bits=12)
    v = tfidf.vectors(refs, model).cache()
    a = v.filter("entity_id = 'S2-a'").select(F.col("name_vector").alias("x"))
    got = {r["entity_id"]: r["c"] for r in v.crossJoin(a).select("entity_id", similarity.sparse_cosine("x", "name_vector").alias("c")).collect()}
    assert got["S3-a"] == pytest.approx(1) and got["S3-c"] is None and got["S3-b"] < 0.2
    assert len(v.filter("entity_id = 'S3-b'").first()["name_vector"]["i"]) > 0
    norms = tfidf.entries(v).groupBy("entity_id", "field").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()
    assert len(norms) == 3 and all(r["n"] == pytest.approx(1) for r in norms)


def test_f05_and_missing_evidence(spark):
    cases = [(0, 0, 0, 1.0), (0, 1, 0, 0.0), (1, 1, 2, 5 / 6), (1, 2, 1, 5 / 9)]
    got = spark.createDataFrame([c[:3] for c in cases], "tp int, p int, t int").select(evaluation.f05(F.col("tp"), F.col("p"), F.col("t"))).collect()
    assert [r[0] for r in got] == pytest.approx([c[3] for c in cases])
    pair = spark.createDataFrame([("S1-a", "S2-a", 1.0, None)], "source1_entity_id string, candidate_entity_id string, name_retrieval_cosine float, address_retrieval_cosine float")
    a, b = frame(spark, [record("S1-a", "abc")]), frame(spark, [record("S2-a", "abc", "road")])
    row = features.extract(pair, a, b).first()
    assert row["address_levenshtein"] is None and row["postal_code_exact"] is None and row["name_address_similarity_product"] is None
    assert row["address_missing"] == 1 and row["address_missing_left"] == 1 and row["address_missing_both"] == 0 and row["name_exact"] == 1
    assert math.isnan(features.extract(pair, a, b, nan=True).first()["address_levenshtein"])


def test_string_similarities(spark):
    assert similarity.jaro_winkler_of("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert similarity.jaro_winkler_of("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert similarity.jaro_winkler_of("abc", "xyz") == 0 and similarity.jaro_winkler_of("a", "a") == 1
    df = spark.createDataFrame([("éa b", "ea b"), ("", "x")], "a string, b string")
    rows = df.select(similarity.levenshtein_ratio(F.col("a"), F.col("b")).alias("l"), similarity.sequence_ratio(F.col("a"), F.col("b")).alias("s"), similarity.gram_jaccard(F.col("a"), F.col("b")).alias("g")).collect()
    assert rows[0]["l"] == 0.75 and rows[0]["s"] == 0.75 and rows[0]["g"] == pytest.approx(1 / 5) and tuple(rows[1]) == (None, None, None)
    t = spark.createDataFrame([("ab a",)], "t string").select(text.terms("t").alias("t"), text.grams("t").alias("g")).first()
    assert sorted(t["t"]) == sorted(["w:ab", "3: ab", "3:ab ", "4: ab ", "w:a", "3: a "]) and t["g"] == [" ab", "ab ", " a "]


def model_rows(spark):
    rows = []
    for i in range(72):
        split = "train" if i < 60 else "validation"
        for label in (1, 0):
            rows.append((f"S1-{i:03d}", f"S{2 if label else 3}-{i:03d}", float(label), float("nan") if i % 3 == 0 else (0.9 if label else 0.1), label, split))
    return spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, name_exact float, address_levenshtein float, label byte, dataset_split string")


def test_model(spark, tmp_path):
    table, names = model_rows(spark), ["name_exact", "address_levenshtein"]
    config = modeling.Training(num_boost_round=5, max_train_pairs=80, max_early_stopping_pairs=10)
    train, validation = table.filter("dataset_split = 'train'"), table.filter("dataset_split = 'validation'")
    assert modeling.training_rows(train, names, 80, 42, "train").count() == 80 and modeling.training_rows(validation, names, 10, 43, "validation").count() == 10
    model = modeling.train(train, validation, names, config)
    again = modeling.train(train, validation, names, config)
    assert modeling.model_identity(model, config) == modeling.model_identity(again, config)
    modeling.save(model, str(tmp_path / "m"))
    model = modeling.load(spark, str(tmp_path / "m"))
    scores = modeling.predict(model, validation, names)
    labels = [(f"S1-{i:03d}", "US", "validation", f"S2-{i:03d}") for i in range(60, 72)] + [("S1-singleton", "US", "validation", ""), ("S1-missed", "FR", "validation", "S2-gone")]
    found = evaluation.evaluate(spark.createDataFrame(labels, "source1_entity_id string, country string, dataset_split string, matched_entity_ids string"), validation, scores)
    assert found["queries"] == 14 and found["best"]["macro_f05"] == pytest.approx(13 / 14) and found["best"]["by_country"]["FR"] == 0
    assert modeling.importance(model)[0][0] == "name_exact" and modeling.importance(model)[0][2] >= 1
    curve = modeling.learning_curve(model, modeling.training_rows(validation, names, 10, 43, "validation"))
    assert len(curve) == model.stages[1].getNumTrees and curve == sorted(curve, reverse=True)
    assert modeling.summary(train, 80) == {"available_pairs": 120, "selected_pairs": 80, "available_positive_pairs": 60, "available_negative_pairs": 60, "sampled": True}
    assert modeling.predict(model, table.limit(0), names).count() == 0
    for bad in (lambda: modeling.predict(model, validation, names[::-1]), lambda: modeling.train(table, validation, names, config), lambda: modeling.check_features(table, ["label"]), lambda: modeling.Training(max_train_pairs=0), lambda: modeling.Training.load(None, nonsense=1)):
        with pytest.raises(ValueError):
            bad()


def test_sampler(spark):
    rows = spark.range(12_400).select(F.when(F.col("id") % 2 == 0, "India").otherwise("US").alias("country"), F.format_string("S1-%05d", "id").alias("entity_id"))
    got = sampling.sample_per_group(rows, "country", "entity_id", 5000).collect()
    assert len({r["entity_id"] for r in got}) == 10_000 and sum(r["country"] == "US" for r in got) == 5000
    assert sorted(r["entity_id"] for r in got)[:5000] != [f"S1-{i:05d}" for i in range(5000)]
    assert sampling.cap_rows(rows, ["entity_id"], 7).count() == 7


def test_guards(spark):
    df = spark.createDataFrame([("S1-a",), ("S1-a",), ("",)], "entity_id string")
    for bad in (lambda: guards.require_unique(df, ["entity_id"], "x"), lambda: cleaning.check_ids(df), lambda: cleaning.check_ids(df.limit(1), 2), lambda: guards.require_rows(df.limit(0), "x"), lambda: guards.require_columns(df, ["y"], "x"), lambda: evaluation.check_thresholds([1.2]), lambda: Preparation(hash_bits=30), lambda: Preparation.load(None, foo=1)):
        with pytest.raises(ValueError):
            bad()
    truth = lambda s: spark.createDataFrame([("S1-a", s)], "source1_entity_id string, matched_entity_ids string")
    for s in ("S2-a,S2-a", "S1-b"):
        with pytest.raises(ValueError):
            labeling.parse_truth(truth(s))
    assert labeling.parse_truth(truth(" S2-a, ,S3-b ")).first()["ids"] == ["S2-a", "S3-b"]


def raw_folder(root: Path):
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for split in ("train", "test"):
        for n in (1, 2, 3):
            rows = []
            for i in range(40):
                tag = {1: "", 2: " Ltd", 3: " Inc"}[n]
                rows.append(f'S{n}-{i}\t"Firm ""{i}"" Number{i * 37}{tag}"\t{i} Oak St, Austin, TX 787{i:02d}\tUS\n')
            data = "﻿" + header + "".join(rows)
            if n == 3:
                with gzip.open(root / f"{split}_source{n}.tsv.gz", "wt", encoding="utf-8") as f:
                    f.write(data)
            else:
                (root / f"{split}_source{n}.tsv").write_text(data, encoding="utf-8")
    (root / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\t{f'S2-{i},S3-{i}' if i % 5 else ''}\n" for i in range(40)))


def check_model_identity(spark, out):
    """A model's folder says what it is of; anything else is refused."""
    metadata = json.loads((out / "model" / "model_metadata.json").read_text())
    assert metadata["status"] == "complete" and metadata["train_rows"]["selected_pairs"] > 0 and metadata["trees"] == 3
    assert (out / "model" / "feature_importance.tsv").read_text().startswith("feature\tgain\tsplits\n")
    assert len(json.loads((out / "model" / "learning_curve.json").read_text())["validation_log_loss"]) == 3
    beside = json.loads((out / "test" / "probabilities.metadata.json").read_text())
    assert beside["model_sha256"] == metadata["model_sha256"] and beside["threshold"] == metadata["decision_threshold"]
    first, settings = pipeline.Work(spark, str(out / "train")), modeling.Training(num_boost_round=3, max_depth=2)
    assert pipeline.train(first, str(out / "model"), settings) == metadata  # complete: read, not fitted
    with pytest.raises(ValueError, match="new model folder"):
        pipeline.train(first, str(out / "model"), modeling.Training(num_boost_round=4, max_depth=2))
    for change, message in (({"status": "running"}, "complete"), ({"model_sha256": "0"}, "trees"), ({"features": metadata["features"][::-1]}, "order"), ({"signature": metadata["signature"] | {"tfidf": {}}}, "TF-IDF")):
        (out / "other").mkdir(exist_ok=True)
        (out / "other" / "model_metadata.json").write_text(json.dumps(metadata | change))
        shutil.copytree(out / "model" / "trees", out / "other" / "trees", dirs_exist_ok=True)
        with pytest.raises(ValueError, match=message):
            pipeline.load_model(spark, first, str(out / "other"))


def test_baseline_sample_and_cli(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    raw_folder(raw)
    (raw / "validator.py").write_text("pass")
    sinks.zip_files({f"data/{p.name}": str(p) for p in raw.iterdir()}, str(tmp_path / "raw.zip"))
    with pytest.raises(FileExistsError):
        sinks.zip_files({}, str(tmp_path / "raw.zip"))
    frame_ = readers.read_tsv(spark, str(raw / "train_source1.tsv"))
    assert frame_.columns[0] == "entity_id" and frame_.filter("entity_id = 'S1-1'").first()["business_name"] == 'Firm "1" Number37'
    found = pipeline.baseline(spark, str(tmp_path / "raw.zip"), str(tmp_path / "out"), Preparation(hash_bits=12, hash_fn="md5"), modeling.Training(num_boost_round=3, max_depth=2))
    assert found["queries"] == 40 and 0 <= found["best"]["macro_f05"] <= 1
    assert len((tmp_path / "out" / "matching_results.tsv").read_text().splitlines()) == 41
    assert (tmp_path / "out" / "cleaned" / "train_ground_truth.tsv").read_bytes() == (raw / "train_ground_truth.tsv").read_bytes()
    check_model_identity(spark, tmp_path / "out")
    summary = cli.main(["sample", "--input", str(raw), "--output", str(tmp_path / "s.zip"), "--per-country", "10", "--distractors", "3"], spark)
    assert summary["train_source1.tsv"] == 10 and 3 <= summary["train_source2.tsv"] <= 13
    with zipfile.ZipFile(tmp_path / "s.zip") as z:
        assert {"dataset/train/train_ground_truth.tsv", "dataset/test/test_source3.tsv", "utils/validator.py", "SAMPLE_README.txt"} <= set(z.namelist())
        said = json.loads(z.read("sample_summary.json"))["full_dataset"]
        assert said["train_source2.tsv"]["rows"] == 40 and said["train_source2.tsv"]["country_counts"] == {"US": 40} and said["train_source2.tsv"]["bytes"] == (raw / "train_source2.tsv").stat().st_size
        assert said["train_ground_truth.tsv"]["matches_per_entity_histogram"] == {"0": 8, "2": 32}
    evaluated = cli.main(["evaluate", "--work", str(tmp_path / "out" / "train"), "--probabilities", str(tmp_path / "out" / "train" / "validation_probabilities.parquet"), "--thresholds", "0.5"], spark)
    assert evaluated["best"]["threshold"] == 0.5
    with pytest.raises(ValueError):
        readers.Inputs(str(tmp_path / "out" / "model")).require()
    (raw / "x").mkdir()
    (raw / "x" / "train_source1.tsv").write_text("")
    with pytest.raises(ValueError):
        readers.Inputs(str(raw))


def test_short_and_long_rows_are_refused(spark, tmp_path):
    for body in ("a\tb\n", "a\tb\tc\td\te\n"):
        (tmp_path / "t.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + body)
        with pytest.raises(Exception, match="(?i)malformed"):
            readers.read_tsv(spark, str(tmp_path / "t.tsv")).collect()


def test_stream(spark, tmp_path):
    from kinmatch.streaming.scoring import match_stream

    raw = spark.createDataFrame([(f"S1-{i}", "Abc Motors Ltd", "105 Elm Street", "US") for i in range(3)], "entity_id string, business_name string, business_address string, country string")
    raw.write.parquet(str(tmp_path / "in"))
    refs = cleaning.clean_records(spark.createDataFrame([("S2-1", "abc motors", "105 elm st", "US"), ("S3-9", "other", "9 x", "FR")], raw.schema)).withColumn("source", F.substring("entity_id", 2, 1).cast("int")).withColumn("rid", F.monotonically_increasing_id())
    blocker = blocking.Blocker(refs, tfidf.fit(refs, bits=12))
    match_stream(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")), blocker, None, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["source1_entity_id"], r["candidate_entity_id"]) for r in got.collect()) == [(f"S1-{i}", "S2-1") for i in range(3)]

def test_vectors_are_never_sent_to_the_driver(spark, tmp_path, monkeypatch):
    """Spark takes the vectors for as small as the texts, and exploded tokens for as small as their compressed file."""
    made = []
    write = blocking.staged
    monkeypatch.setattr(blocking, "staged", lambda df, name: made.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    refs = frame(spark, [record("S2-a", "abc motors", "105 elm street"), record("S3-b", "abc lights", "7 oak road")]).withColumns({"rid": F.monotonically_increasing_id(), "source": F.lit(2)})
    for table, at in ((refs, "refs"), (frame(spark, [record("S1-a", "abc motors", "105 elm street")]), "asked")):
        table.write.parquet(f"{tmp_path}/{at}")
    refs = spark.read.parquet(f"{tmp_path}/refs")
    pairs, _ = blocking.Blocker(refs, tfidf.fit(refs, bits=12), blocking.Limits(block_limit=1)).candidates(spark.read.parquet(f"{tmp_path}/asked"))
    assert {r["candidate_entity_id"] for r in pairs.collect()} == {"S2-a", "S3-b"}
    assert len(made) > 5 and not [line for plan in made for line in plan.splitlines() if "BroadcastHashJoin" in line]


def test_bm25_scores_full_lists_in_parts(spark, monkeypatch):
    """Each part of the references meets every query; with parts of few rows as with one, as by hand."""
    import random
    from collections import Counter
    from math import log

    from kinmatch.operators import bm25

    rng = random.Random(5)
    draw = lambda words, n: sorted(rng.sample(words, rng.randint(0, n)))
    refs = [(i, rng.sample(["US", "FR", "*"], 2), [("name", w) for w in draw("abcdef", 5)] + [("address", w) for w in draw("abxy", 4)], [("B", k) for k in draw("pqr", 2)]) for i in range(60)]
    asks = [(f"S1-{i}", rng.sample(["US", "FR", "*"], 1), [("name", w) for w in draw("abcdefz", 4)] + [("address", w) for w in draw("abxy", 2)], [(c, k) for c in "AB" for k in draw("pqr", 2)]) for i in range(20)]
    pairs = "array<struct<{}:string,{}:string>>".format
    tables = [spark.createDataFrame(rows, f"{key}, classes array<string>, {terms} {pairs('field', 'token')}, keys {pairs('channel', 'key')}") for rows, key, terms in ((refs, "rid long", "tokens"), (asks, "sid string", "asked"))]
    mean = sum(len(t) + len(k) + 1 for *_, t, k in refs) / len(refs)
    n = Counter(t for r in refs for t in r[2])

    def score(ref, tokens):
        return round(sum(max(log((60 - n[t] + 0.5) / (n[t] + 0.5)), 1e-6) for t in tokens) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * (len(ref[2]) + len(ref[3]) + 1) / mean)), 9)

    want = {False: set(), True: set()}
    for sid, classes, asked, keys in asks:
        for by_key, groups in ((False, {f for f, _ in asked}), (True, {c for c, _ in keys})):
            for g in groups:
                found = []
                for ref in refs:
                    shared = [t for t in asked if t in ref[2] and (by_key or t[0] == g)]
                    if shared and set(classes) & set(ref[1]) and (not by_key or {k for k in keys if k[0] == g} & set(ref[3])):
                        found.append((-score(ref, shared), ref[0]))
                want[by_key] |= {(sid, g, rid) for _, rid in sorted(found)[:7]}
    assert len(want[False]) > 100 and len(want[True]) > 40
    for size in (7, 1 << 16):
        monkeypatch.setattr(bm25, "PART_ROWS", size)
        for by_key in want:
            got = [tuple(r) for r in bm25.best(*tables, 7, by_key).collect()]
            assert len(got) == len(set(got)) and set(got) == want[by_key]


def test_cosines_of_pairs_go_by_parts(spark, monkeypatch):
    """As a join of both vectors gives them, each pair once, over parts of few rows as over one."""
    import random

    from kinmatch.operators import cosine

    rng = random.Random(3)
    draw = lambda: " ".join(rng.choices(["acme", "sons", "blue", "río", "delta"], k=rng.randint(0, 3)))
    refs = frame(spark, [record(f"S2-{i}", draw(), draw()) for i in range(40)]).withColumns({"rid": F.substring("entity_id", 4, 3).cast("long") * 7, "source": F.lit(2)})
    asked = frame(spark, [record(f"S1-{i}", draw(), draw()) for i in range(12)])
    blocker = blocking.Blocker(refs, tfidf.fit(refs, bits=12))
    read = blocker.read(asked)
    pairs = spark.createDataFrame([(f"S1-{rng.randrange(12)}", rng.randrange(41) * 7) for _ in range(300)], "sid string, rid long")
    theirs = blocker.index.select("rid", "eid", "rname", F.col("name_vector").alias("rn"), F.col("address_vector").alias("ra"))
    joined = pairs.distinct().join(read, "sid").join(theirs, "rid")
    shown = ["sid", "rid", "qname", "eid", "rname", "nc", "ac"]
    want = sorted(map(str, joined.withColumns({"nc": similarity.sparse_cosine("qn", "rn"), "ac": similarity.sparse_cosine("qa", "ra")}).select(*shown).collect()))
    assert len(want) > 150 and any("nc=None" in r for r in want)
    for part, out in ((7, 5), (1 << 15, 1 << 15)):
        monkeypatch.setattr(cosine, "PART_ROWS", part)
        monkeypatch.setattr(cosine, "OUT_ROWS", out)
        assert sorted(map(str, blocker.with_cosines(pairs, read).select(*shown).collect())) == want


def test_written_tables_leave_no_shuffle_files(spark):
    """Each written table would leave its shuffles until the driver collects its garbage."""
    from kinmatch.sources import staging

    files = lambda: {x for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines() if "/shuffle_" in x}
    before = files()
    made = staging.staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), "counts")
    assert made.count() == 7 and not [x for x in files() - before if x.endswith(".data")][1:]  # of the count itself there is one


def test_candidates_in_portions_are_those_of_one(spark, monkeypatch):
    import random

    rng = random.Random(6)
    draw = lambda n: " ".join(rng.choices(["acme", "sons", "blue", "delta", "motors"], k=rng.randint(1, n)))
    refs = frame(spark, [record(f"S2-{i}", f"the {draw(3)}", f"{i % 4} {draw(2)} street") for i in range(60)]).withColumns({"rid": F.substring("entity_id", 4, 3).cast("long") * 7, "source": F.lit(2)})
    asked = frame(spark, [record(f"S1-{i}", f"the {draw(3)}", f"{i % 4} {draw(2)} street") for i in range(20)])
    limits = blocking.Limits(block_limit=5, lexical_pool=12, lexical_top_k=4, max_candidates=9)

    def found():
        return [sorted(map(str, t.collect())) for t in blocking.Blocker(refs, tfidf.fit(refs, bits=12), limits).candidates(asked)]

    want = found()
    assert len(want[0]) > 100 and any("overflow_blocks='B" in r for r in want[1])
    monkeypatch.setattr(blocking, "PORTION_ROWS", 7)
    assert found() == want


def test_vectors_of_references_are_read_from_files_of_their_parts(spark, monkeypatch):
    """Their copies in shuffles, one for each task of each portion, were most of the disk that retrieval took."""
    from kinmatch.operators import cosine

    refs = frame(spark, [record(f"S2-{i}", f"acme {i % 9} sons", f"{i} blue street") for i in range(40)]).withColumns({"rid": F.substring("entity_id", 4, 3).cast("long") * 7, "source": F.lit(2)})
    asked = frame(spark, [record(f"S1-{i}", f"acme {i} sons", f"{i} blue street") for i in range(12)])
    pairs = spark.createDataFrame([(f"S1-{i % 12}", i * 7) for i in range(41)], "sid string, rid long")
    shown = ["sid", "rid", "eid", "rname", "nc", "ac"]
    found = {}
    for size in (1 << 15, 7):
        monkeypatch.setattr(cosine, "PART_ROWS", size)
        blocker = blocking.Blocker(refs, tfidf.fit(refs, bits=12))
        scored = blocker.with_cosines(pairs, blocker.read(asked)).select(*shown)
        found[size] = sorted(map(str, scored.collect())), len(cosine.files_of(blocker.index))
        read = {f for f in blocker.index.inputFiles() if f in set(scored.inputFiles())}
        assert not read  # no plan scans them for the cosines
    assert found[7][0] == found[1 << 15][0] and len(found[7][0]) == 40 and found[1 << 15][1] == 1 and found[7][1] > 3


def test_checks_leave_no_shuffle_files(spark):
    from kinmatch.operators import guards

    files = lambda: {x for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines() if "/shuffle_" in x}
    before = files()
    guards.forbid(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), (F.col("n") > 1000, "too many"))
    assert not [x for x in files() - before if x.endswith(".data")]
