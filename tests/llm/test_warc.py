import hashlib
import io
import zipfile

import pytest

from kinmatch.llm import warc
from kinmatch.llm.common import shared_dir


@pytest.mark.parametrize("zip64", [False, True, None])
def test_zip_round_trip(zip64):
    data = warc.zip_stored([("a/b", b"x" * 1000), ("é", b""), ("c", b"PK\x05\x06" * 9)], zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.read("a/b") == b"x" * 1000
    found = warc.zip_members(lambda at, n: data[at : at + n], len(data))
    assert {k: data[at : at + n] for k, (at, n, _) in found.items()} == {"a/b": b"x" * 1000, "é": b"", "c": b"PK\x05\x06" * 9}


def test_zip_written_by_others_and_damage():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z, z.open("big", "w", force_zip64=True) as f:
        f.write(b"hello")
    data = out.getvalue() [:-22] + out.getvalue()[-22:-2] + b"\x03\x00abc"
    at, n, method = warc.zip_members(lambda a, k: data[a : a + k], len(data))["big"]
    assert (data[at : at + n], method) == (b"hello", 0)
    with pytest.raises(ValueError):
        warc.zip_members(lambda a, k: data[a : a + k][:10], 10)


def test_record_round_trip_and_check():
    member = warc.encode_record(7, "http://x/\r\nEvil: 1", b"\r\n\r\npayload", hashlib.sha256(b"\r\n\r\npayload").hexdigest(), False, None)
    got = warc.decode_record(member)
    assert got["payload"] == b"\r\n\r\npayload" and got["page_id"] == 7 and "Evil: 1" in got["url"]
    with pytest.raises(ValueError):
        warc.decode_record(warc.encode_record(7, None, b"a", "00", False, None))


def test_archives(spark):
    long, short = "é" * 80, "s" * 10
    rows = [(5, "u", long), (3, "u", long), (3, "u", long), (9, None, long), (None, "n", long), (1, "u", short), (2, "u", short), (4, "u", None), (6, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "3 AS salt")
    archives = warc.write_archives(warc.with_revisits(pages), shared_dir(spark, "t"), archive_bytes=300)
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.read_archives(archives, range_bytes=100).collect())
    d = {t: hashlib.sha256(t.encode()).hexdigest() for t in (long, short, "")}
    assert got == [
        (-1, "revisit", 3, 160, d[long]),
        (1, "response", None, 10, d[short]),
        (2, "response", None, 10, d[short]),
        (3, "response", None, 160, d[long]),
        (3, "response", None, 160, d[long]),
        (4, "response", None, 0, d[""]),
        (5, "revisit", 3, 160, d[long]),
        (6, "response", None, 0, d[""]),
        (9, "revisit", 3, 160, d[long]),
    ]


def test_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(warc.with_revisits(pages), shared_dir(spark, "t"))).count() == 0
