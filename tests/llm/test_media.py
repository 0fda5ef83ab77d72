import hashlib
import zlib

import pytest

from kinmatch.llm import media
from kinmatch.llm.common import shared_dir


def test_png_round_trip():
    for text in (b"", b"a", b"x" * 192, bytes(range(256)) * 40):
        samples = media.samples_of(text)
        assert len(samples) % 192 == 0 and samples and samples[: len(text)] == text
        assert media.decode_png(media.encode_png(samples)) == samples
    broken = bytearray(media.encode_png(b" " * 192))
    broken[45] ^= 1
    with pytest.raises(ValueError):
        media.decode_png(bytes(broken))


def test_interleaving_keeps_order_and_captions():
    html = "<p>one &amp; two<script>x<p></script><figure><img src='sha256:ab' alt=old><figcaption>The <b>caption</b></figcaption></figure>three<img src='http://x/y.png' alt='alt'><p>"
    assert media.interleave(html) == [
        {"position": 0, "kind": "text", "text": "one & two", "digest": None, "caption": None},
        {"position": 1, "kind": "media", "text": None, "digest": "ab", "caption": "The caption"},
        {"position": 2, "kind": "text", "text": "three", "digest": None, "caption": None},
        {"position": 3, "kind": "media", "text": None, "digest": None, "caption": "alt"},
    ]
    assert media.interleave(None) == [] == media.interleave("")


def said(html):
    return [(x["kind"], x["text"] or x["digest"], x["caption"]) for x in media.interleave(html)]


def test_open_and_stray_captions():
    assert said('<figure><img src="sha256:a"><figcaption>cap</figure><p>text') == [("media", "a", "cap"), ("text", "text", None)]
    assert said('<img src="sha256:a" alt=one><figcaption>stray</figcaption><img src="sha256:b">') == [("media", "a", "one"), ("text", "stray", None), ("media", "b", None)]
    assert said('<figure><img src="sha256:a"><figcaption>one<figure><img src="sha256:b"><figcaption>two</figcaption>x') == [("media", "a", "one"), ("media", "b", "two"), ("text", "x", None)]
    assert said("<figure><figcaption>only<p>words</figcaption></figure>") == [("text", "only words", None)]
    assert said('before<figure><img src="sha256:a"><figcaption>to the<br>end') == [("text", "before", None), ("media", "a", "to the end")]


def test_sequences_of_pages(spark):
    """Real pages, with a figure put before the article's second paragraph, resolved by digest."""
    import re

    import duckdb

    stored = media.store_texts(spark.createDataFrame([(7, "a payload")], "doc_id long, text string"), shared_dir(spark, "m"))
    digest = stored.first()["digest"]
    figure = f'<figure><img src="sha256:{digest}"><figcaption>A &lt;map&gt;</figcaption></figure><img src="https://x.example/y.png" alt="far">'
    rows = []
    for page, html in duckdb.connect().execute("SELECT page_id, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall():
        at = [m.start() for m in re.finditer("<p>", html)]
        rows.append((page, html[: at[1]] + figure + html[at[1] :] if len(at) > 1 else html, len(at) > 1, html))
    pages = spark.createDataFrame(rows, "page_id long, html string, has boolean, plain string").selectExpr("*", "'x' AS digest")
    got = {r["id"]: r["sequence"] for r in media.sequences(pages, id_col="page_id", html_col="html").collect()}
    assert len(got) == len(rows) and any(has for *_, has, _ in rows)
    for page, _, has, plain in rows:
        parts, words = got[page], [x["text"] for x in media.interleave(plain)]
        assert [x["position"] for x in parts] == list(range(len(parts)))
        assert [(x["digest"], x["caption"]) for x in parts if x["kind"] == "media"] == ([(digest, "A <map>"), (None, "far")] if has else [])
        assert " ".join(x["text"] for x in parts if x["kind"] == "text") == " ".join(words)
    from pyspark.sql import functions as F

    references = media.sequences(pages, id_col="page_id", html_col="html").select("id", F.explode("sequence").alias("x")).filter("x.kind = 'media'").select("id", "x.digest", "x.position")
    found = media.resolve(references, media.read_media(stored)).collect()
    assert sum(r["payload_bytes"] == 192 for r in found) == sum(has for *_, has, _ in rows) == sum(r["payload_bytes"] is None for r in found)


def brute_feature(text):
    raw = (text or "").encode()
    raw += b" " * ((-len(raw)) % 192 if raw else 192)
    return "-".join(str(sum(b // 16 == i for b in raw) * 1000 // len(raw)) for i in range(16))


def test_features_against_brute_force(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    stored = media.store_texts(documents, shared_dir(spark, "m"))
    found = {r["digest"]: r["feature"] for r in media.read_media(stored).collect()}
    assert all(found[r["digest"]] == brute_feature(texts[r["id"]]) for r in stored.collect())


def test_stored_texts(spark, documents, nothing):
    stored = media.store_texts(documents, shared_dir(spark, "m"), container_bytes=2000)
    found = {r["digest"]: r for r in media.read_media(stored, stretch=500).collect()}
    rows = stored.collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert sorted((r["id"] for r in rows), key=str) == sorted((r["doc_id"] for r in documents.collect()), key=str)
    for r in rows:
        want, got = media.samples_of((texts[r["id"]] or "").encode()), found[r["digest"]]
        assert got["payload_sha256"] == hashlib.sha256(want).hexdigest() and got["tail_crc32"] == zlib.crc32(want[-16:]) and got["payload_bytes"] == len(want)
        assert got["media_bytes"] == r["n"] and media.interleave(r["html"])[1]["digest"] == got["media_sha256"]
    references = spark.createDataFrame([(1, "none", "cap"), (2, rows[0]["digest"], "cap")], "doc_id long, digest string, caption string")
    resolved = {r["doc_id"]: r["payload_bytes"] for r in media.resolve(references, media.read_media(stored)).collect()}
    assert resolved[1] is None and resolved[2] > 0
    assert media.store_texts(nothing, shared_dir(spark, "m")).count() == 0
