import base64
import hashlib
import io
from pathlib import Path

import pytest
import zstandard

from goldseam.llm import warc

DDL = "page_id bigint, url string, html string, payload string, n int"


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a/ b\r\n", "same"), (2, None, "same"), (3, "u", "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 70_000),
            (None, "u", "same"), (None, "u", "only nulls"), (None, "u", "only nulls"), (7, "u", "WARC/1.1\r\n\r\n")]
    return spark.createDataFrame([(*r, "p", 1) for r in rows], DDL)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, pages, tmp_path):
    warc.write_archives(warc.plan_records(pages), str(tmp_path / "a"), frame_bytes=500)
    found = [r.asDict() for r in warc.read_records(spark, str(tmp_path / "a")).collect()]
    assert len(found) == 11
    original = {(r.page_id, sha(r.html)): r.html or "" for r in pages.collect()}
    for r in found:
        html = original[r["page_id"], r["payload_digest"]]
        assert r["payload_bytes"] == len(html.encode())
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == html and r["refers_to"] is None
    kinds = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found), key=str)
    assert kinds == sorted(
        [(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (3, "response", None), (0, "revisit", 3), (0, "response", None),
         (0, "response", None), (4, "revisit", 5), (5, "response", None), (6, "response", None), (7, "response", None)], key=str)


def test_small_payloads_are_no_revisits(pages):
    rows = warc.plan_records(pages, least_bytes=5).where("payload_digest = '%s'" % sha("same")).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_archives_are_plain_zstandard_and_seekable(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archives(warc.plan_records(pages).coalesce(1), path, frame_bytes=300)
    (file,) = Path(path).glob("part-*")
    data = file.read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\nWARC-Type") == 11
    frames, places = warc.frames_of(data)
    assert len(frames) > 3 and len(places) == 11
    assert [begin for begin, _ in frames] == [sum(size for _, size in frames[:k]) for k in range(len(frames))]
    index = {r.page_id: r for r in warc.record_index(spark, path).collect()}
    place = index[6]
    frame = zstandard.ZstdDecompressor().decompress(data[place.frame_begin : place.frame_begin + place.frame_size - warc.PAD_SIZE])
    assert warc.parse_record(frame[place.offset : place.offset + place.length])["payload"].decode() == "é" * 70_000
    fetched = warc.fetch(spark, path, [6, 2]).collect()
    assert sorted((r.page_id, r.record_type) for r in fetched) == [(2, "revisit"), (6, "response")]


def test_damage_is_noticed(spark, pages, tmp_path):
    record = warc._record(1, "u", b"abc", 3, sha("abd"), "response", None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record)
    with pytest.raises(ValueError, match="seek table"):
        warc.frames_of(b"0123456789abcdef")


def test_hot_payload_and_empty_table(spark, tmp_path):
    rows = [(k, "u", "hot" if k % 3 else str(k), "p", 1) for k in range(3_000)]
    planned = warc.plan_records(spark.createDataFrame(rows, DDL))
    assert planned.count() == 3_000
    assert {(r.record_type, r.refers_to) for r in planned.where("payload_bytes = 3 AND page_id % 3 > 0").collect()} == {("revisit", 2999), ("response", None)}
    empty = spark.createDataFrame([], DDL)
    warc.write_archives(warc.plan_records(empty), str(tmp_path / "e"))
    assert warc.read_records(spark, str(tmp_path / "e")).count() == 0
