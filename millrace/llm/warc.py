"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Tasks write the archives into the shared folder and report those they finished in a manifest table, so files of lost attempts
are never read. The reader streams an archive frame by frame, with the dictionary from its own first frame, and
validates version, headers, lengths and payload digests.

Of rows with equal payloads of at least ``revisit_bytes`` bytes the smallest page_id is the response and the others are revisits
of it, which hold headers only; all others are responses. Defined results: null html is the empty payload; rows without page_id are
responses; rows of equal page_id and payload are all of one kind; a very long payload is one record, held whole by one task; the dictionary is trained on the first 131,072 bytes of
each sampled page, which bounds the driver and loses no payload; an empty table gives an empty manifest. Extra columns are not written.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut, scratch_path

# Skippable frame magic of the dictionary, Zstandard frame and dictionary magics, record headers
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


class BadRecord(ValueError):
    """A record or frame that breaks the format."""


def _clean(value: str | None) -> str:
    return "".join(" " if c in "\r\n" else c for c in value or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit keeps the response's headers and leaves its payload out."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"), ("WARC-Date", date),
             ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        lines.append(("WARC-Target-URI", _clean(url)))
    if refers_to is not None:
        lines += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8").split("\r\n"):
        if line:
            name, colon, value = line.partition(":")
            if not colon:
                raise BadRecord(f"header line without colon: {line[:80]!r}")
            out[name.strip().lower()] = value.strip()
    return out


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "none") else int(value)


def parse(raw: bytes) -> tuple:
    """Columns of ``RECORD``; raises ``BadRecord`` where the record breaks the format."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if first != VERSION or not gap:
        raise BadRecord("no version line or header end")
    h = _headers(lines)
    for name in REQUIRED:
        if name.lower() not in h:
            raise BadRecord(f"{name} is missing")
    n = int(h["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadRecord(f"block of {len(rest) - 4} bytes, Content-Length {n}")
    http, gap, body = rest[:n].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/") or not gap:
        raise BadRecord("the block is no HTTP response")
    size, digest = int(_headers(lines)["content-length"]), h["warc-payload-digest"].removeprefix("sha256:")
    kind = h["warc-type"]
    if kind == "response":
        if len(body) != size or hashlib.sha256(body).hexdigest() != digest:
            raise BadRecord("payload does not match its length or digest")
    elif kind != "revisit" or body or "warc-refers-to" not in h:
        raise BadRecord(f"record of type {kind}")
    return (_page(h["warc-record-id"]), h.get("warc-target-uri"), kind, _page(h.get("warc-refers-to")) if kind == "revisit" else None,
            body if kind == "response" else None, size, digest)


def train_dictionary(pages: DataFrame, sample_pages: int = 1_000, size: int = 1 << 16) -> bytes:
    """Dictionary from about ``sample_pages`` pages taken by hash, or nothing where the sample is too small to train on."""
    import zstandard

    step = max(1, pages.count() // sample_pages)
    rows = pages.where(F.col("html").isNotNull()).where(F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0).select("html").limit(2 * sample_pages)
    samples = [r[0].encode()[:1 << 17] for r in rows.toLocalIterator()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, revisit_bytes: int = 100) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``; only ids and digests of long payloads are compared."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_ones = rows.where(F.octet_length("payload") >= revisit_bytes).select("page_id", "digest")
    first = long_ones.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    refs = cut(long_ones.join(first, "digest").where("page_id <> first").distinct())
    if refs.isEmpty():
        return rows.withColumn("refers_to", F.lit(None).cast("long"))
    return rows.join(refs, ["page_id", "digest"], "left").withColumnRenamed("first", "refers_to")


def write_archives(rows: DataFrame, folder: str, dictionary: bytes, date: str = "2024-01-01T00:00:00Z", level: int = 3,
                   file_bytes: int = 1 << 28) -> DataFrame:
    """``(path, records)`` of the archives written from ``(page_id, url, payload, digest, refers_to)``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs
        import zstandard

        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
        out, done, name, n = None, [], "", 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    name, n = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = fs.open_output_stream(f"{base}/{name}")
                    if dictionary:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                out.write(pack.compress(record(page_id, url, payload, digest, refers_to, date)))
                n += 1
                if out.tell() >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([k for _, k in done], pa.int64())], ["path", "records"])

    return cut(rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(task, "path string, records long"))


def frames(stream, piece: int = 1 << 16) -> Iterator[bytes]:
    """Decoded frames of an archive, with the dictionary of its leading skippable frame."""
    import zstandard

    held, shared = stream.read(8), None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", held[4:])[0]
        raw = stream.read(size)
        if len(raw) != size:
            raise BadRecord("the dictionary frame is cut off")
        if raw[:4] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        shared, held = zstandard.ZstdCompressionDict(raw), b""
    unpack = zstandard.ZstdDecompressor(dict_data=shared)
    while True:
        held = held or stream.read(piece)
        if not held:
            return
        frame = unpack.decompressobj()
        parts = [frame.decompress(held)]
        while not frame.eof:
            more = stream.read(piece)
            if not more:
                raise BadRecord("the last frame is cut off")
            parts.append(frame.decompress(more))
        held = frame.unused_data
        yield b"".join(parts)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives of a manifest, validated: ``RECORD``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                held, weight, n = [], 0, 0
                with fs.open_input_stream(name) as stream:
                    for raw in frames(stream):
                        held.append(parse(raw))
                        n, weight = n + 1, weight + len(raw)
                        if weight >= 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names)
                            held, weight = [], 0
                if n != expected:
                    raise BadRecord(f"{path} has {n} records of {expected}")
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names)

    files = manifest.count()
    return manifest.repartition(max(1, min(files, 100_000)), "path").mapInArrow(task, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, revisit_bytes: int = 100) -> DataFrame:
    """``pages (page_id, url, html)`` written as archives in the shared folder and read back."""
    import pyarrow.fs

    folder = scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    manifest = write_archives(with_revisits(pages, revisit_bytes), folder, train_dictionary(pages))
    return read_archives(manifest)
