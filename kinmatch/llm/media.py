"""Interleaved sequences of text and media.

:func:`interleave` parses HTML into ordered structs of text and of media references with their
captions. Payloads live in containers in the shared folder, many to a file; a table of digests says
where. :func:`resolve` joins references to that table by digest, so only places move, never bytes,
and a payload that many documents use is stored and read once a task.

The query stores a text as an image: 8-bit greyscale PNG, 192 samples to a line.

Defined results: a null or empty text is one line of spaces; a reference to a digest that no
container holds keeps its position and caption with a null payload; equal texts give equal values;
an empty table gives no rows; other columns are ignored; ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import byte_views, open_fs, put_file, shared_dir, slices, spread_join, write_table

LINE = 192
SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_MEDIA = {"img", "video", "audio", "source", "embed"}
_BREAKS = {"p", "div", "figure", "figcaption", "article", "section", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "table", "tr", "td", "blockquote", "pre", "br"}


# ---------------------------------------------------------------- HTML


class _Interleaver(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.caption: list[str] | None = None
        self.skip = 0
        self.figure: int | None = None

    def flush(self):
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.items.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def end_caption(self):
        """The open caption goes to the media of its figure; of a figure without any it is text."""
        if self.caption is None:
            return
        text, self.caption = " ".join("".join(self.caption).split()), None
        media = [x for x in self.items[self.figure :] if x["kind"] == "media"]
        for item in media:
            item["caption"] = text or item["caption"]
        if text and not media:
            self.items.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def end_figure(self):
        self.flush()
        self.end_caption()
        self.figure = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "figure":
            self.end_figure()
            self.figure = len(self.items)
        elif tag == "figcaption":
            self.flush()
            self.end_caption()
            if self.figure is not None:
                self.caption = []
        elif tag in _MEDIA:
            self.flush()
            said = dict(attrs)
            source = said.get("src") or ""
            self.items.append({"kind": "media", "text": None, "digest": source.removeprefix("sha256:") if source.startswith("sha256:") else None, "caption": said.get("alt") or None})
        elif tag in _BREAKS:
            self.flush()
            if self.caption is not None:
                self.caption.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "figure":
            self.end_figure()
        elif tag in _BREAKS:
            self.flush()
            if tag == "figcaption":
                self.end_caption()
            elif self.caption is not None:
                self.caption.append(" ")

    def handle_data(self, data):
        if not self.skip:
            (self.words if self.caption is None else self.caption).append(data)


def interleave(html: str | None) -> list[dict]:
    """Text and media references in page order; a figure's caption belongs to the media before it there.

    A caption ends with its element, its figure, or the next one; outside of a figure, or in one
    without media, it is text.
    """
    parser = _Interleaver()
    parser.feed(html or "")
    parser.close()
    parser.end_figure()
    return [{"position": i, **x} for i, x in enumerate(parser.items)]


def sequences(pages: DataFrame, *, id_col: str, html_col: str) -> DataFrame:
    """``id, sequence`` with the structs of :func:`interleave`."""
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([interleave(h) for h in batch.column(1).to_pylist()], kind)], names=["id", "sequence"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string")).mapInArrow(parse, f"id {dict(pages.dtypes)[id_col]}, sequence {SEQUENCE}")


# ---------------------------------------------------------------- PNG


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode_png(samples: bytes, width: int = LINE, level: int = 1) -> bytes:
    """Samples, a whole number of lines, as a greyscale image without line filters."""
    height = len(samples) // width
    lines = np.zeros((height, width + 1), dtype=np.uint8)
    lines[:, 1:] = np.frombuffer(samples, dtype=np.uint8).reshape(height, width)
    return _SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> bytes:
    """The samples of an image that :func:`encode_png` made."""
    if not data.startswith(_SIGNATURE):
        raise ValueError("not a PNG file")
    at, packed, width, height = len(_SIGNATURE), [], 0, 0
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if zlib.crc32(body, zlib.crc32(kind)) != int.from_bytes(data[at + 8 + n : at + 12 + n], "big"):
            raise ValueError("a damaged chunk")
        if kind == b"IHDR":
            width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", body)
            if (depth, colour, laced) != (8, 0, 0):
                raise ValueError("only 8-bit greyscale without interlace")
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("line filters aren't used here")
    return lines[:, 1:].tobytes()


def samples_of(text: bytes) -> bytes:
    """The text with spaces up to a positive number of whole lines."""
    return text + b" " * (max(LINE, -(-len(text) // LINE) * LINE) - len(text))


def feature_of(samples: bytes) -> str:
    """A histogram of the samples in 16 steps, as whole thousandths."""
    counts = np.bincount(np.frombuffer(samples, dtype=np.uint8) >> 4, minlength=16)
    return "-".join(map(str, (counts * 1000 // len(samples)).tolist()))


# ---------------------------------------------------------------- containers


_STORED = "id long, html string, digest string, uri string, at long, n long, n_bytes long"


def store_texts(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", container_bytes: int = 32_000_000) -> DataFrame:
    """Store each text as an image; a row for each document with the HTML that refers to it.

    Equal texts of a task are stored once. As with archives, only whole files get a name.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, rows, known = bytearray(), [], {}
        uri = f"{folder}/{uuid.uuid4().hex}.media"

        def close() -> pa.RecordBatch:
            put_file(uri, bytes(data))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=schema)

        schema = pa.schema([("id", pa.int64()), ("html", pa.string()), ("digest", pa.string()), ("uri", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("n_bytes", pa.int64())])
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), strict=True):
                key = hashlib.sha256(text).digest()
                if key not in known:
                    image = encode_png(samples_of(text))
                    known[key] = (hashlib.sha256(image).hexdigest(), len(data), len(image))
                    data += image
                digest, at, n = known[key]
                caption = escape(f"{len(text)} bytes as an image")
                html = f'<article><p>A text of</p><figure><img src="sha256:{digest}"><figcaption>{caption}</figcaption></figure></article>'
                rows.append((doc, html, digest, uri, at, n, len(text)))
                if len(data) >= container_bytes:
                    yield close()
                    data, rows, known, uri = bytearray(), [], {}, f"{folder}/{uuid.uuid4().hex}.media"
        if rows:
            yield close()

    return write_table(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(store, _STORED), "media-places")


_FEATURES = pa.schema([("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def read_media(places: DataFrame, *, stretch: int = 4_000_000, task_bytes: int = 64_000_000) -> DataFrame:
    """Read stored images back, in order of their place, and compute what is asked of them.

    ``places`` has ``digest, uri, at, n``. A stretch of a container is one unit of work.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["uri"] != uri:
                    if file is not None:
                        file.close()
                    fs, path = open_fs(row["uri"])
                    uri, file = row["uri"], fs.open_input_file(path)
                image = file.read_at(row["n"], row["at"])
                found = hashlib.sha256(image).hexdigest()
                if found != row["digest"]:
                    raise ValueError(f"{uri}: bytes at {row['at']} aren't those that were stored")
                samples = decode_png(image)
                out.append((found, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(image), found, feature_of(samples)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FEATURES, strict=True)], schema=_FEATURES)
        if file is not None:
            file.close()

    spots = places.select("digest", "uri", "at", "n").distinct()
    total = places.agg(F.sum("n")).first()[0] or 0
    tasks = max(places.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))
    spots = spots.repartition(tasks, "uri", F.floor(F.col("at") / stretch)).sortWithinPartitions("uri", "at")
    return spots.mapInArrow(read, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def resolve(references: DataFrame, media: DataFrame) -> DataFrame:
    """References by digest, left join; ``media`` may list a digest more than once."""
    once = media.groupBy("digest").agg(*[F.first(c).alias(c) for c in media.columns if c != "digest"])
    return spread_join(references, once, "digest")


def media_query(spark, sf_dir: str) -> DataFrame:
    """All documents as images in containers, found again through their HTML."""
    stored = store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "media"))
    parsed = sequences(stored.withColumn("key", F.struct("id", "n_bytes")), id_col="key", html_col="html")
    references = parsed.select("id.*", F.explode("sequence").alias("x")).filter("x.kind = 'media'").select(F.col("id").alias("doc_id"), "n_bytes", "x.digest", "x.position", "x.caption")
    references = write_table(references, "references")
    found = resolve(references, read_media(stored))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
