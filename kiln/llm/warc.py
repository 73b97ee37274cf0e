"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame per record.

Payload digests come from Spark's own functions. Payloads of at least ``REVISIT_BYTES`` that several records share are stored
once, in the record with the smallest id; the others become revisit records that refer to it. The groups of a digest meet only
in a count and a minimum, which combine before the shuffle, and only digests that occur twice are joined back.

Each task writes its records into archives of about ``ARCHIVE_BYTES`` of payload. An archive's dictionary is trained on its
first records. Files carry a random name and reach the reader only through the stored list of what finished tasks wrote, so
a lost or repeated task leaves no trace. The reader streams an archive frame by frame and raises on a bad header, length or digest.

Defined results: null payload counts as empty; a null id is kept as null and is never the first of its group unless all
ids are null; rows with equal id and payload that come first are all response records; an empty table writes nothing
and reads as no rows; of further columns only url is read, null as empty.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stored, table

REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20
#: What an archive's dictionary is trained on, and its size.
SAMPLE_BYTES, DICT_BYTES = 1 << 20, 16 << 10
LEVEL = 3
#: Magic number of the skippable frame that holds a dictionary.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 18


def record(page_id: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. The HTTP head states the payload's full length, a revisit leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record. Raises ValueError for anything that isn't as ``record`` writes it."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon or key.lower() in fields:
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[key.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"headers missing: {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    http, sep, payload = rest[:size].partition(b"\r\n\r\n")
    stated = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind = fields["warc-type"]
    if not sep or len(stated) != 1 or kind not in ("response", "revisit") or (kind == "revisit") != ("warc-refers-to" in fields):
        raise ValueError("bad record block or type")
    algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    if algorithm != "sha256" or len(digest) != 64:
        raise ValueError("bad digest")
    if kind == "response" and (len(payload) != stated[0] or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit record holds no payload")

    def number(name: str) -> int | None:
        if not name.startswith("<urn:page:") or not name.endswith(">"):
            raise ValueError("bad record id")
        return int(name[10:-1]) if name != "<urn:page:>" else None

    return {"page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri", ""), "payload": payload if kind == "response" else None, "payload_bytes": stated[0], "payload_digest": digest, "record_type": kind, "refers_to": number(fields["warc-refers-to"]) if kind == "revisit" else None}


def dictionary(samples: list[bytes]) -> bytes:
    """Trained on the samples; empty where they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of an archive: the dictionary's skippable frame, then a frame per record."""
    sample, held = [], 0
    for r in records:
        if held >= SAMPLE_BYTES:
            break
        sample.append(r[: 64 << 10])
        held += len(sample[-1])
    trained = dictionary(sample)
    yield struct.pack("<II", DICT_MAGIC, len(trained)) + trained
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, write_checksum=True)
    for r in records:
        yield compressor.compress(r)


def frames(read) -> Iterator[bytes]:
    """Records of an archive, one frame each; ``read(n)`` gives up to n bytes, none at the end."""
    head = read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != DICT_MAGIC:
        raise ValueError("no dictionary frame at the archive's start")
    size = struct.unpack("<II", head)[1]
    stored_dict = b""
    while len(stored_dict) < size:
        more = read(size - len(stored_dict))
        if not more:
            raise ValueError("dictionary frame is cut short")
        stored_dict += more
    if stored_dict[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
        stored_dict = zstandard.ZstdDecompressor().decompressobj().decompress(stored_dict)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stored_dict) if stored_dict else None)
    rest = read(CHUNK)
    while rest:
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data or read(CHUNK)
                break
            rest = read(CHUNK)
            if not rest:
                raise ValueError("a record's frame is cut short")
        yield b"".join(parts)


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), digest, refers_to, record_type."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= REVISIT_BYTES
    groups = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("g"), "first")
    joined = rows.join(groups, large & (F.col("digest") == F.col("g")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, "revisit").otherwise("response").alias("record_type"))


def write_archives(roles: DataFrame, folder: str) -> DataFrame:
    """Write all records; the list of archives (path, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                for part in archive(held):
                    f.write(part)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(held)], pa.int64())], names=["path", "records"])

        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                held.append(record(r["page_id"], r["url"], r["payload"], r["digest"], r["record_type"], r["refers_to"]))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return stored(roles.mapInArrow(write, "path string, records long"), "archives", folder)


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the listed archives; ``payload`` is null for revisits. Raises if an archive holds another number of records than listed."""
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                store, at = fs.FileSystem.from_uri(path)
                rows, size, seen = [], 0, 0
                with store.open_input_stream(at, compression=None) as f:
                    for data in frames(f.read):
                        rows.append(parse(data))
                        size += len(data)
                        seen += 1
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                            rows, size = [], 0
                if seen != expected:
                    raise ValueError(f"{path} holds {seen} records instead of {expected}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return archives.select("path", "records").repartition(parts, "path").mapInArrow(read, RECORDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(with_roles(table(spark, sf_dir, "pages")), shared_dir(spark))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
g AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
FROM g
"""
