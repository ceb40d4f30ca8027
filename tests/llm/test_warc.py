"""Archives: a round trip, and each fault that the reader must find."""

import base64
import hashlib
import io
import struct

import pytest
import zstandard

from permeate.llm import warc
from tests.llm.data import empty

PAGES = [
    (3, "http://a/3", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (5, "http://a/5\r\nX: y", "<p>été 文</p>" * 50),
    (6, "http://a/6", None),
    (4, "http://a/4", ""),
    (7, "http://a/7", "long " * 200_000),
    (8, "http://a/8", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (9, "http://a/9", "only once"),
    (9, "http://a/9", "only once"),
    (None, "http://a/none", "<p>same</p>"),
    (None, "http://a/none", "without id"),
]


def pages(spark, rows=None):
    rows = PAGES if rows is None else rows
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, URL2 int")


def test_pages_come_back(spark):
    got = warc.pages_archived(pages(spark)).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        payload = (h or "").encode()
        of = first.get(h or "")
        revisit = of is not None and of != i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((i, len(payload), digest, "revisit" if revisit else "response", of if revisit else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.pages_archived(empty(spark, "page_id long, url string, html string")).count() == 0


def test_payloads_and_urls_come_back(spark):
    folder = warc.new_folder(spark)
    archives = warc.write(pages(spark), folder)
    got = {(r.page_id, r.record_type): r for r in warc.read(spark, archives, folder).collect()}
    assert got["7", "response"].payload == ("long " * 200_000).encode()
    assert got["8", "response"].payload == b"\r\n\r\nWARC/1.1\r\n\r\n"
    assert got["5", "response"].url == "http://a/5X: y" and got["2", "revisit"].url == "urn:none"
    assert got["3", "revisit"].payload is None and got["3", "revisit"].refers_to == "1"


def test_small_payloads_need_not_be_revisits(spark):
    folder = warc.new_folder(spark)
    found = warc.read(spark, warc.write(pages(spark), folder, least=20), folder)
    assert {r.record_type for r in found.collect()} == {"response"}


WORDS = warc.record("0", "u", b"payload 0", warc.digest_of(b"payload 0"), None)


def archive(words=WORDS):
    out = io.BytesIO()
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    out.write(struct.pack("<II", warc.SKIPPABLE, len(words)) + words)
    for i in range(3):
        payload = b"payload %d" % i
        out.write(coder.compress(warc.record(str(i), "u", payload, warc.digest_of(payload), None)))
    return out.getvalue()


def test_frames_hold_one_record_each():
    assert [warc.parse(r, "x")["page_id"] for r in warc.records(io.BytesIO(archive()), "x")] == ["0", "1", "2"]


@pytest.mark.parametrize("read", [1, 7, 1 << 20])
def test_frames_across_reads(monkeypatch, read):
    monkeypatch.setattr(warc, "READ_BYTES", read)
    assert len(list(warc.records(io.BytesIO(archive()), "x"))) == 3


@pytest.mark.parametrize("fault", ["no frame", "cut dictionary", "cut record", "bad frame", "no dictionary"])
def test_faulty_archives(fault):
    data = archive()
    if fault == "no frame":
        data = data[8:]
    elif fault == "cut dictionary":
        data = data[:100]
    elif fault == "cut record":
        data = data[:-5]
    elif fault == "bad frame":
        data = data[:-40] + b"\xff" * 40
    else:
        data = struct.pack("<II", warc.SKIPPABLE, 0) + data[8 + len(WORDS) :]
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(data), "x"))


GOOD = warc.record("1", "u", b"payload", warc.digest_of(b"payload"), None)


@pytest.mark.parametrize(
    "bad",
    [
        GOOD.replace(b"WARC/1.1", b"WARC/0.9"),
        GOOD.replace(b"WARC-Type", b"WARC-Kind"),
        GOOD.replace(b"WARC-Date: ", b"WARC-Date "),
        GOOD[:-4],
        GOOD[:-1] + b"x",
        GOOD.replace(b"payload\r\n", b"paylaod\r\n"),
        GOOD.replace(b"payload\r\n", b"payloads\r\n"),
        GOOD.replace(b"response", b"revisit", 1),
        GOOD.replace(b"\r\nContent-Length: 7\r\n", b"\r\nContent-Length: 8\r\n"),
        b"",
    ],
)
def test_faulty_records(bad):
    assert warc.parse(GOOD, "x")["payload"] == b"payload"
    with pytest.raises(warc.WarcError):
        warc.parse(bad, "x")


def test_missing_records_are_found(spark):
    folder = warc.new_folder(spark)
    archives = warc.write(pages(spark), folder)
    more = archives.selectExpr("archive", "records + 1 as records")
    with pytest.raises(Exception, match="written were"):
        warc.read(spark, more, folder).collect()


