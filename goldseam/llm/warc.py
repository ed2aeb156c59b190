"""Seekable Zstandard bundles of WARC records.

An archive is one file of independent Zstandard frames, each with whole records of about
``frame_bytes``, then a skippable frame that maps record ids to (frame, offset in the frame, length),
then the footer seek table of the seekable format with every frame's compressed and plain size. Any
Zstandard tool reads the file as one plain WARC file; a reader with the table decodes only the frames it wants.

Spark's text sink writes the files, one per task, one row per frame, so that a task holds one frame
at a time and the commit protocol covers lost executors. That sink ends every row with a
separator. Ours is the last four bytes of a seek table; after a frame they are the content of a
skippable frame of four bytes that the row has opened, and count as part of the frame before.

Of records with equal payloads of at least ``least_bytes`` the one with the largest page_id is a response and the
others are revisits that refer to it and hold no payload. Rows that share page_id and payload are alike: if
theirs is the largest id, all of them are responses. A null page_id sorts below all others, and among nulls
only all are responses. Null html is an empty payload; a null url leaves out the header.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import salted_join

SEEK_MAGIC = struct.pack("<I", 0x8F92EAB1)
PAD_HEAD = struct.pack("<II", 0x184D2A50, len(SEEK_MAGIC))
PAD_SIZE = len(PAD_HEAD) + len(SEEK_MAGIC)
INDEX_ID, TABLE_ID = 0x184D2A51, 0x184D2A5E


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, in SQL functions: 15 hexadecimal digits make 12 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, size), 16, 32), size * 4 // 5, "0") for at, size in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of every page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.col("payload")))
    chosen = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("chosen"), F.count("*").alias("n"))
    )
    joined = salted_join(rows, chosen, "payload_digest", "n", F.xxhash64("page_id", "url"), "left")
    revisit = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("chosen")).alias("refers_to"),
    )


def _record(page_id, url, payload, size, digest, kind, refers_to, date) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{record_id(refers_to)}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def _page(uri: str) -> int | None:
    text = uri.strip("<>").removeprefix("urn:x-page:")
    return int(text) if text else None


def archive_rows(records: Iterable[tuple[str, bytes]], frame_bytes: int, level: int) -> Iterator[bytes]:
    """The rows of one archive, each to be followed by SEEK_MAGIC; none without records."""
    packer = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
    table, index, frame, plain = [], [], [], 0

    def close() -> bytes:
        packed = packer.compress(b"".join(frame))
        table.append((len(packed) + PAD_SIZE, plain))
        return packed + PAD_HEAD

    for name, record in records:
        if frame and plain + len(record) > frame_bytes:
            yield close()
            frame, plain = [], 0
        index.append(f"{name}\t{len(table)}\t{plain}\t{len(record)}")
        frame.append(record)
        plain += len(record)
    if not frame:
        return
    yield close()
    places = packer.compress("\n".join(index).encode())
    table.append((len(places) + 8, 0))
    entries = b"".join(struct.pack("<II", *entry) for entry in table)
    footer = struct.pack("<IB", len(table), 0)
    size = len(entries) + len(footer) + len(SEEK_MAGIC)
    yield struct.pack("<II", INDEX_ID, len(places)) + places + struct.pack("<II", TABLE_ID, size) + entries + footer


def write_archives(records: DataFrame, path: str, frame_bytes: int = 1 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write planned records below ``path``, one archive per partition that has any."""
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def packed(batches):
        def made():
            for batch in batches:
                for begin in range(0, batch.num_rows, 64):
                    for row in zip(*(column.to_pylist() for column in batch.slice(begin, 64).columns)):
                        yield record_id(row[0]), _record(*row, date)

        for row in archive_rows(made(), frame_bytes, level):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])

    rows = records.select(*names).mapInArrow(packed, "value binary").select(F.col("value").cast("string"))
    rows.write.option("encoding", "ISO-8859-1").option("lineSep", SEEK_MAGIC.decode("latin-1")).text(path)


def frames_of(archive: bytes) -> tuple[list[tuple[int, int]], list[tuple[str, int, int, int]]]:
    """From the footer backwards: begin and size of every frame, and (id, frame, offset, length) of every record."""
    if archive[-4:] != SEEK_MAGIC:
        raise ValueError("an archive without a seek table")
    count, _ = struct.unpack("<IB", archive[-9:-4])
    begin = len(archive) - 9 - 8 * count
    if struct.unpack("<II", archive[begin - 8 : begin]) != (TABLE_ID, 8 * count + 9):
        raise ValueError("a seek table of the wrong size")
    places, at = [], 0
    for k in range(count):
        size, _ = struct.unpack_from("<II", archive, begin + 8 * k)
        places.append((at, size))
        at += size
    at, size = places.pop()
    lines = zstandard.ZstdDecompressor().decompress(archive[at + 8 : at + size]).decode().split("\n")
    return places, [(n, int(f), int(o), int(s)) for n, f, o, s in (line.rsplit("\t", 3) for line in lines)]


def parse_record(record: bytes) -> dict:
    """Header fields and payload of one record; a response's payload must have its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None, "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    }


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(),
}
_DDL = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where(F.col("length") > 0)


def _read(spark: SparkSession, path: str, columns: list[str], wanted: frozenset[str] | None) -> DataFrame:
    ddl = ", ".join(part for part in _DDL.split(", ") if part.split()[0] in columns)

    def parsed(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                archive = batch["content"][k].as_py()
                frames, places = frames_of(archive)
                by_frame: dict[int, list] = {}
                for name, frame, offset, size in places:
                    if wanted is None or name in wanted:
                        by_frame.setdefault(frame, []).append((offset, size))
                for frame, inside in by_frame.items():
                    at, size = frames[frame]
                    plain = unpack.decompress(archive[at : at + size - PAD_SIZE])
                    rows = [parse_record(plain[o : o + s]) for o, s in inside]
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _FIELDS[c]) for c in columns], columns)

    return _archives(spark, path).select("content").mapInArrow(parsed, ddl)


def read_records(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All records below ``path``, payloads checked against their digests; ``columns`` in the order of the full set."""
    names = list(_FIELDS)
    return _read(spark, path, names if columns is None else [n for n in names if n in columns], None)


def fetch(spark: SparkSession, path: str, page_ids: Iterable[int | None]) -> DataFrame:
    """The records of a few pages (the ids go to every task); only frames that hold one of them are decoded."""
    return _read(spark, path, list(_FIELDS), frozenset(map(record_id, page_ids)))


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """page_id, archive, frame, frame_begin, frame_size, offset, length of every record, without decoding any."""

    def indexed(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                frames, places = frames_of(batch["content"][k].as_py())
                yield pa.RecordBatch.from_pydict({
                    "page_id": pa.array([_page(p[0]) for p in places], pa.int64()),
                    "archive": pa.array([batch["path"][k].as_py()] * len(places), pa.string()),
                    "frame": pa.array([p[1] for p in places], pa.int32()),
                    "frame_begin": pa.array([frames[p[1]][0] for p in places], pa.int64()),
                    "frame_size": pa.array([frames[p[1]][1] for p in places], pa.int64()),
                    "offset": pa.array([p[2] for p in places], pa.int64()),
                    "length": pa.array([p[3] for p in places], pa.int64()),
                })

    ddl = "page_id bigint, archive string, frame int, frame_begin bigint, frame_size bigint, offset bigint, length bigint"
    return _archives(spark, path).select("path", "content").mapInArrow(indexed, ddl)
