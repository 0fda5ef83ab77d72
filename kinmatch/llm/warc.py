"""WARC archives packed in ZIP files, read by ranges.

A packed archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``
(one gzip member a record) and ``indexes/index.cdxj`` (one JSON line a record with its offset and
length in that member). The reader takes the end of the file, the ZIP or ZIP64 central directory
and the index, and then only the byte ranges of records; nothing is unpacked to disk.

Defined results: a null payload is empty; of records with equal payloads of at least
``min_revisit`` bytes, those with the smallest id are responses and all others revisit it; ids that
are null revisit the smallest id, or are responses if there is none; an empty table writes nothing
and reads nothing; ids are whole numbers; a null URL leaves the field out; line ends in a URL are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import drop_table, open_fs, put_file, shared_dir, write_table

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


# ---------------------------------------------------------------- ZIP


def zip_stored(members: list[tuple[str, bytes]], zip64: bool | None = None) -> bytes:
    """A ZIP file of stored members; ZIP64 records where sizes need them, or always if asked for."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        big = zip64 if zip64 is not None else max(len(data), at) >= _FULL32
        size = _FULL32 if big else len(data)
        local_extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        out += _LOCAL + struct.pack("<HHHHHIIIHH", 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(local_extra)) + raw + local_extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if big else b""
        directory += _CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, _FULL32 if big else at) + raw + extra
    at, n = len(out), len(members)
    out += directory
    if zip64 or (zip64 is None and (at >= _FULL32 or n >= _FULL16)):
        end = len(out)
        out += _END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(directory), at)
        out += _LOCATOR + struct.pack("<IQI", 0, end, 1)
        out += _END + struct.pack("<HHHHIIH", 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0)
    else:
        out += _END + struct.pack("<HHHHIIH", 0, 0, n, n, len(directory), at, 0)
    return bytes(out)


def zip_members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """``{name: (first byte of its data, stored size, method)}``; ``read(offset, length)`` gives bytes."""
    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(_END)
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(_END, 0, end)  # those bytes were part of a comment
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut short")
    n, length, at = struct.unpack_from("<HII", tail, end + 10)
    if n == _FULL16 or length == _FULL32 or at == _FULL32:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != _LOCATOR:
            raise ValueError("a ZIP64 locator is missing")
        record = read(int.from_bytes(locator[8:16], "little"), 56)
        if record[:4] != _END64:
            raise ValueError("a ZIP64 end of central directory is missing")
        n, length, at = struct.unpack_from("<QQQ", record, 32)
    directory, found, here = read(at, length), {}, 0
    for _ in range(n):
        if directory[here : here + 4] != _CENTRAL:
            raise ValueError("a damaged central directory")
        method, _, _, _, stored, full, a, b, c = struct.unpack_from("<HHHIIIHHH", directory, here + 10)
        start = int.from_bytes(directory[here + 42 : here + 46], "little")
        name = directory[here + 46 : here + 46 + a].decode("utf-8", "replace")
        extra, x = directory[here + 46 + a : here + 46 + a + b], 0
        while x + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, x)
            if kind == 1:  # only the fields that overflowed are there, in this order
                wide = [int.from_bytes(extra[i : i + 8], "little") for i in range(x + 4, x + 4 + width - width % 8, 8)]
                if full == _FULL32:
                    full = wide.pop(0)
                if stored == _FULL32:
                    stored = wide.pop(0)
                if start == _FULL32:
                    start = wide.pop(0)
            x += 4 + width
        head = read(start, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"{name}: no local header at {start}")
        found[name] = (start + 30 + sum(struct.unpack_from("<HH", head, 26)), stored, method)
        here += 46 + a + b + c
    return found


# ---------------------------------------------------------------- WARC


def _one_line(x: str) -> str:
    return x.replace("\r", "%0D").replace("\n", "%0A")


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None, level: int = 1) -> bytes:
    """One gzip member with one record. A revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        fields.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        fields += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _page(urn: str | None) -> int | None:
    return int(x) if urn and (x := urn.strip("<>").rpartition(":")[2]) != "null" else None


def decode_record(member: bytes) -> dict:
    """A record's fields, its URL and, for a response, its payload as read."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = field["WARC-Type"] == "revisit"
    digest = field["WARC-Payload-Digest"].partition(":")[2]
    if not revisit and (len(payload) != said or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{field['WARC-Record-ID']}: the payload isn't the one that was written")
    return {"page_id": _page(field["WARC-Record-ID"]), "url": field.get("WARC-Target-URI"), "record_type": field["WARC-Type"], "refers_to": _page(field.get("WARC-Refers-To")), "payload_bytes": said, "payload_digest": digest, "payload": None if revisit else payload}


# ---------------------------------------------------------------- write


def with_revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 100, salts: int = 16) -> DataFrame:
    """``page_id, url, payload, digest, first``: ``first`` is the id that the record refers to, if any.

    Only digests that occur twice are joined back, each to ``salts`` buckets of pages, so a payload
    that a third of the pages share is spread.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
    shared = shared.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(shared, ["digest", "salt"], "left")
    return rows.select("page_id", "url", "payload", "digest", F.when(F.coalesce(F.col("page_id") != F.col("first"), F.lit(True)), F.col("first")).alias("first"))


def write_archives(records: DataFrame, folder: str, *, archive_bytes: int = 32_000_000) -> DataFrame:
    """Write records to archives below ``folder``; a row for each: ``uri, bytes, records``.

    A file appears under its name only when it is whole, and names are new each time, so an
    attempt that is lost leaves at most a file that the returned table doesn't list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index = bytearray(), []

        def close() -> pa.RecordBatch:
            lines = "".join(json.dumps({"page": p, "offset": at, "length": n}) + "\n" for p, at, n in index).encode()
            packed, uri = zip_stored([(DATA, bytes(data)), (INDEX, lines)]), f"{folder}/{uuid.uuid4().hex}.wacz"
            put_file(uri, packed)
            row = pa.RecordBatch.from_pylist([{"uri": uri, "bytes": len(packed), "records": len(index)}])
            data.clear()
            index.clear()
            return row

        for batch in batches:
            for row in range(batch.num_rows):
                page, url, payload, digest, first = (c[row].as_py() for c in batch.columns)
                member = encode_record(page, url, payload, digest, first is not None, first)
                index.append((page, len(data), len(member)))
                data += member
                if len(data) >= archive_bytes:
                    yield close()
        if index:
            yield close()

    return write_table(records.select("page_id", "url", "payload", "digest", "first").mapInArrow(write, "uri string, bytes long, records long"), "warc-archives")


# ---------------------------------------------------------------- read


def _index(batches: Iterator[pa.RecordBatch], range_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, path = open_fs(uri)
            with fs.open_input_file(path) as f:

                def read(at: int, n: int, f=f) -> bytes:
                    return f.read_at(n, at)

                members = zip_members(read, size)
                if members[DATA][2] or members[INDEX][2]:
                    raise ValueError(f"{uri}: members must be stored")
                base, lines = members[DATA][0], read(*members[INDEX][:2]).splitlines()
            out, start, ends = [], 0, []
            for line in lines:
                x = json.loads(line)
                ends.append(x["offset"] + x["length"])
                if ends[-1] - start >= range_bytes:
                    out.append({"uri": uri, "start": base + start, "lengths": [b - a for a, b in zip([start, *ends], ends, strict=False)]})
                    start, ends = ends[-1], []
            if ends:
                out.append({"uri": uri, "start": base + start, "lengths": [b - a for a, b in zip([start, *ends], ends, strict=False)]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("uri", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]))


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read_archives(archives: DataFrame, *, payload: bool = True, range_bytes: int = 2_000_000, task_bytes: int = 64_000_000) -> DataFrame:
    """The records of packed archives, by central directory, index and byte ranges.

    ``archives`` has ``uri`` and ``bytes``. Ranges of about ``range_bytes`` are dealt to tasks of
    about ``task_bytes``, so a large archive is spread.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_fs(row["uri"])
                with fs.open_input_file(path) as f:
                    data = f.read_at(sum(row["lengths"]), row["start"])
                out, at = [], 0
                for n in row["lengths"]:
                    out.append(decode_record(data[at : at + n]))
                    at += n
                made = pa.RecordBatch.from_pylist(out, schema=_RECORD)
                yield made if payload else made.select([n for n in _RECORD.names if n != "payload"])

    total = archives.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))
    ranges = archives.select("uri", "bytes").mapInArrow(lambda b: _index(b, range_bytes), "uri string, start long, lengths array<long>").repartition(tasks, "uri", "start")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return ranges.mapInArrow(read, schema + ", payload binary" if payload else schema)


def warc_query(spark, sf_dir: str) -> DataFrame:
    """Write all pages to archives, read them back."""
    records = with_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    archives = write_archives(records, shared_dir(spark, "warc"))
    out = write_table(read_archives(archives, payload=False), "warc-read")
    drop_table(archives)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
