import random
import struct

import pytest
import zstandard

from colsieve.llm import warc_zstd as wz

PAGES = "page_id long, url string, html string"


def archive(records, samples=()):
    writer = wz.Writer(list(samples))
    for r in records:
        writer.add(r)
    return writer.close()


def test_archives_start_with_a_dictionary_and_hold_one_frame_per_record():
    rng = random.Random(1)
    bodies = [(f"<p>page {k} " + "common words again " * rng.randint(0, 30)).encode() for k in range(200)]
    content = archive([wz.page_record(k, f"http://x/{k}", b, wz.digest(b), None) for k, b in enumerate(bodies)], bodies)
    assert struct.unpack_from("<I", content)[0] == wz.SKIPPABLE
    at, frames = 8 + struct.unpack_from("<I", content, 4)[0], 0
    while at < len(content):
        end = wz.frame_end(memoryview(content), at)
        assert content[at:at + 4] == struct.pack("<I", wz.FRAME)
        at, frames = end, frames + 1
    assert frames == 200
    assert [wz.parse_record(r)[1].partition(b"\r\n\r\n")[2] for r in wz.read_archive(content)] == bodies


@pytest.mark.parametrize("size", [0, 1, 255, 256, 65_535, 70_000, 300_000, 2_000_000])
@pytest.mark.parametrize("options", [{}, {"write_checksum": True}, {"write_content_size": False}])
def test_frame_end_equals_the_library(size, options):
    for body in (b"a" * size, random.Random(size).randbytes(size)):
        frame = zstandard.ZstdCompressor(**options).compress(body)
        assert wz.frame_end(memoryview(frame + b"next"), 0) == len(frame)
        for cut in (3, len(frame) // 2, len(frame) - 1):
            with pytest.raises(wz.WarcError):
                wz.frame_end(memoryview(frame[:cut]), 0)


def test_reads_plain_and_missing_dictionaries():
    whole = wz.record([("WARC-Type", "x"), ("WARC-Record-ID", "<a>"), ("WARC-Date", "d")], b"body")
    plain = zstandard.ZstdCompressor().compress(whole)
    assert list(wz.read_archive(plain)) == [whole] and list(wz.read_archive(b"")) == []
    raw = b"WARC/1.1\r\nWARC-Type: response " * 9
    held = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(whole)
    assert list(wz.read_archive(struct.pack("<II", wz.SKIPPABLE, len(raw)) + raw + held)) == [whole]


@pytest.mark.parametrize("broken", [
    b"WARC/9\r\nA: b\r\n\r\n\r\n\r\n",
    b"WARC/1.1\r\nno colon\r\n\r\n\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: a\r\nWARC-Record-ID: b\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: a\r\nWARC-Record-ID: b\r\nWARC-Date: c\r\nContent-Length: 5\r\n\r\n1234\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: a\r\nWARC-Record-ID: b\r\nWARC-Date: c\r\nContent-Length: x\r\n\r\n\r\n\r\n",
])
def test_broken_records_are_refused(broken):
    with pytest.raises(wz.WarcError):
        wz.parse_record(broken)


def test_wrong_digest_and_length_are_refused():
    good = wz.page_record(1, None, b"abc", wz.digest(b"abc"), None)
    assert wz._fields(*wz.parse_record(good))[-1] == b"abc"
    for bad in (wz.page_record(1, None, b"abc", wz.digest(b"abd"), None), good.replace(b"Payload-Length: 3", b"Payload-Length: 4")):
        with pytest.raises(wz.WarcError):
            wz._fields(*wz.parse_record(bad))


def test_round_trip_keeps_every_byte(spark, monkeypatch):
    monkeypatch.setattr(wz, "ARCHIVE_BYTES", 2000)
    rng = random.Random(3)
    pages = [(k, f"http://h/{k}\r\nX: y", "".join(rng.choices("ab é中\r\n\0", k=rng.randint(0, 3000)))) for k in range(150)]
    frame = spark.createDataFrame(pages, PAGES)
    archives = wz.write_archives(frame)
    assert archives.count() > 20
    out = {r.page_id: r for r in wz.read_archives(archives).collect()}
    for k, _, body in pages:
        r = out[k]
        if r.record_type == "response":
            assert bytes(r.payload) == body.encode()
        assert r.payload_bytes == len(body.encode()) and r.payload_digest == wz.digest(body.encode())


def test_skipping_broken_archives(spark):
    good = archive([wz.page_record(1, "u", b"abc", wz.digest(b"abc"), None)])
    frame = spark.createDataFrame([("a", good), ("b", good[:-5]), ("c", None)], "archive string, content binary")
    assert [r.archive for r in wz.read_archives(frame, "skip").collect()] == ["a"]
    with pytest.raises(Exception, match="b: archive ends inside a frame"):
        wz.read_archives(frame).collect()


def test_awkward_rows(spark):
    long = "<p>" + "x y " * 200_000
    rows = [(1, "u", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", long), (5, "u", long),
            (None, "u", "same"), (6, "u", "same"), (6, "u", "same")]
    frame = spark.createDataFrame([(*r, 1.5, "z") for r in rows], PAGES + ", sha1 double, holder string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in wz.round_trip(frame).collect()), key=repr)
    want = [(1, 4, "revisit", 6), (2, 4, "revisit", 6), (3, 0, "revisit", 4), (4, 0, "response", None),
            (5, len(long), "response", None), (5, len(long), "response", None), (None, 4, "response", None),
            (6, 4, "response", None), (6, 4, "response", None)]
    assert got == sorted(want, key=repr)
    assert wz.round_trip(spark.createDataFrame([], PAGES)).count() == 0
