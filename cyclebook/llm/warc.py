"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with a group of whole records, and a seek
table in a last skippable frame. The index maps a record's identifier to its bundle, frame and
offset in the frame, so that reading one record decompresses one frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import new_folder, open_file, staged, utf8, write_file

# Fixed values of the seekable format and of the WARC 1.1 standard.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"


def record_id(page_id, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}"


def _field(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record: a response with its payload, or a revisit that only names the response."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_field(url or 'about:blank')}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}",
                 f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload of the record at an offset, and the offset behind it."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start, size = end + 4, int(headers["Content-Length"])
    block = data[start:start + size]
    return headers, block[block.index(b"\r\n\r\n") + 4:], start + size + 4


class Bundle:
    """Collects records into frames; ``finish`` gives the parts of the file."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset in the frame where the record lies."""
        if self.open and self.filled + len(data) > FRAME_BYTES:
            self._close()
        place = len(self.frames), self.filled
        self.open.append(data)
        self.filled += len(data)
        return place

    def _close(self) -> None:
        raw = b"".join(self.open)
        packed = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(raw)
        self.frames.append(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(packed)
        self.open, self.filled = [], 0

    def finish(self) -> list[bytes]:
        if self.open:
            self._close()
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        foot = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE_MAGIC)
        return [*self.frames, struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(foot)), table, foot]


class BundleReader:
    """Frames of a bundle by number, found through its seek table."""

    def __init__(self, uri: str) -> None:
        self.src = open_file(uri)
        size = self.src.size()
        self.src.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", self.src.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        width = 12 if flags & CHECKSUMS else 8
        self.src.seek(size - 9 - n * width)
        table = self.src.read(n * width)
        self.entries = [struct.unpack_from("<II", table, i * width) for i in range(n)]
        self.starts = [0]
        for packed, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, k: int) -> bytes:
        self.src.seek(self.starts[k])
        packed, raw = self.entries[k]
        return zstandard.ZstdDecompressor().decompress(self.src.read(packed), max_output_size=raw)

    def records(self):
        for k in range(len(self.entries)):
            data, at = self.frame(k), 0
            while at < len(data):
                headers, payload, at = parse(data, at)
                yield headers, payload


def read_record(uri: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index; only its frame is decompressed."""
    headers, payload, _ = parse(BundleReader(uri).frame(frame), offset)
    return headers, payload


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record for each row of ``pages(page_id, url, html)`` and returns the staged index.

    The index has ``record_id, page_id, record_type, file, frame, offset, length``. Of records
    with equal payloads of at least 100 bytes, those with the smallest page_id are responses and
    the others revisit it; shorter payloads are always responses. Rows that repeat the smallest
    page_id are all responses. A null html is an empty payload, a null url ``about:blank``; rows
    without page_id are revisits where another row of the payload has one. No row, no file.
    Other columns are not read. A payload shared by a third of all pages is one row after
    partial aggregation, and the join that spreads it is one that adaptive execution splits.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    firsts = (rows.filter(F.octet_length("html") >= MIN_REVISIT).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    planned = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches):
        bundle, rows_out, uri = Bundle(), [], f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"

        def flush():
            write_file(uri, bundle.finish())
            columns = list(zip(*rows_out))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([uri] * len(rows_out))], names=[
                "record_id", "page_id", "record_type", "frame", "offset", "length", "file"])

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("page_id", "url", "digest", "refers_to"))
            for page, url, digest, refers, payload in zip(*columns, utf8(batch["html"])):
                data = record(page, url, payload, digest, refers)
                frame, offset = bundle.add(data)
                rows_out.append((record_id(page, digest), page, "response" if refers is None else "revisit",
                                 frame, offset, len(data)))
                if bundle.size >= BUNDLE_BYTES:
                    yield flush()
                    bundle, rows_out, uri = Bundle(), [], f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        if rows_out:
            yield flush()

    ddl = ("record_id string, page_id long, record_type string, frame long, offset long, length long,"
           " file string")
    planned.mapInArrow(write, ddl).write.parquet(f"{folder}/index")
    return spark.read.schema(ddl).parquet(f"{folder}/index")


def read_archives(index: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Read from the bundles that the index names, a frame at a time. A response's size and digest
    are those of the payload that was read; a revisit has those of the response it refers to.
    """
    files = index.select("file").distinct()
    files = files.repartition(max(1, files.count()))  # a few names, but each is a bundle to unpack

    def read(batches):
        for batch in batches:
            for uri in batch["file"].to_pylist():
                out = []
                for headers, payload in BundleReader(uri).records():
                    number = lambda name: int(headers[name]) if name in headers else None
                    response = headers["WARC-Type"] == "response"
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    out.append((number("Page-ID"), len(payload) if response else None,
                                hashlib.sha256(payload).hexdigest() if response else stated,
                                headers["WARC-Type"], number("Refers-To-Page-ID"),
                                headers.get("WARC-Refers-To", headers["WARC-Record-ID"])))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target"])

    found = staged(files.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string,"
                                    " record_type string, refers_to long, target string"), "records")
    responses = found.filter("record_type = 'response'")
    known = responses.groupBy("target", "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
    revisits = (found.filter("record_type = 'revisit'").drop("payload_bytes")
                .join(known, ["target", "payload_digest"], "left")
                .withColumnRenamed("full_bytes", "payload_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionAll(revisits.select(*columns))
