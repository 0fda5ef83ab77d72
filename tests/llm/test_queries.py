"""The registered queries on the small tables: against SQL, brute force, or what a contract says."""

import hashlib
import zlib

import duckdb
import pytest

import corpus_pipeline
from kinmatch.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(db):
    return db.execute("SELECT doc_id, text, lang FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, db, name):
    got = queries.queries()[name](spark, SF)
    found = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(found.fetchall(), key=key)


def test_media(spark, docs):
    got = {r["doc_id"]: r for r in queries.queries()["op5_media"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc, text, _ in docs:
        raw = (text or "").encode()
        padded = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = got[doc]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))


def test_packing_leaves_little_padding(spark):
    rows = queries.queries()["op6_packing"](spark, SF).collect()
    used = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) * 2048 < 1.05 * used


def test_simhash(spark, docs):
    from test_simhash import brute_components, brute_print

    got = queries.queries()["op7_simhash"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == brute_components([(d, brute_print(t)) for d, t, _ in docs], 3)


def test_prefix_free(spark, docs):
    from test_prefix_free import brute

    got = queries.queries()["op8_prefix_free"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(d, t) for d, t, _ in docs])


def test_langid(spark, docs):
    got = {r["doc_id"]: r for r in queries.queries()["op9_langid"](spark, SF).collect()}
    held = [(got[d]["lang_pred"], lang) for d, _, lang in docs if got[d]["held_out"]]
    assert len(got) == len(docs) and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_chain_finds_shared_passages(spark, docs):
    """Each document whose first 60 words an earlier one has, word for word, is joined to an earlier one."""
    got = {r["doc_id"] for r in queries.queries()["op3_chain"](spark, SF).collect()}
    words = {d: (t or "").lower().split() for d, t, _ in docs}
    joined = {d: f" {' '.join(w)} " for d, w in words.items()}
    want = {d for d, w in words.items() if len(w) >= 60 and any(e < d and f" {' '.join(w[:60])} " in joined[e] for e in words)}
    assert want <= got


def test_html(spark, db):
    rows = queries.queries()["op10_html"](spark, SF).collect()
    assert len(rows) == db.execute("SELECT count(*) FROM pages").fetchone()[0] and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_pipeline_keeps_whole_documents(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    tokens = {}
    for r in rows:
        tokens.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for (_, n), parts in tokens.items():
        assert sum(x for _, x in parts) == n
