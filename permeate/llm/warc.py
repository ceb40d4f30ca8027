"""WARC archives of zstandard frames with a dictionary: writing pages, reading and validating.

An archive begins with a skippable frame that holds the dictionary; then follows one frame per
record. The reader loads the dictionary from that frame, decodes frame by frame and checks each
record: version line, needed headers, Content-Length against the block, the two line ends behind
it, and the payload's digest and length. A faulty record or archive raises an error that names it.

Pages with equal payloads (of ``least`` bytes or more) are written once, as the response of the
smallest page_id; the others are revisit records, which hold the HTTP headers only and refer to it.

Defined cases: a null html is an empty payload; rows repeating the smallest page_id are all
responses; a page without an id is a response only if no page with an id has its payload; a null
url is ``urn:none``; line ends in a url are dropped; an empty table gives empty archives and no
rows; other columns are ignored. Archives go to the shared folder, whole: each is written under a
name of its own first and then renamed, so a repeated task leaves one. Names depend on the
task's rows only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permeate.llm.tables import BROADCAST_ROWS, pick, stored
from permeate.storage import shared_folder

#: Fixed values of the format: magic numbers of the dictionary's frame and of a zstandard frame.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"

LEAST = 0
LEVEL = 3
#: The dictionary is made from about so many pages of a bounded length; see ``dictionary``.
SAMPLE_PAGES = 200
SAMPLE_BYTES = 8 << 10
DICTIONARY_BYTES = 32 << 10
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 4 << 20

_PAGES = "page_id string, url string, html binary, digest string, refers_to string"
_READ = pa.schema(
    [
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)
_SQL_READ = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


class WarcError(ValueError):
    """A record or an archive that does not follow the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit record where ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return head + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes, where: str) -> dict[bytes, bytes]:
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise WarcError(f"{where}: version line {lines[0][:20]!r}")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise WarcError(f"{where}: header line {line[:40]!r}")
        out[name.lower()] = value.strip()
    return out


_PAGE = re.compile(rb"<urn:page:(.*)>")


def parse(data: bytes, where: str) -> dict:
    """A whole record, validated, as a row of ``read``."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    if not blank:
        raise WarcError(f"{where}: no end of headers")
    fields = _fields(head, where)
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length"):
        if name not in fields:
            raise WarcError(f"{where}: no {name.decode()}")
    if not fields[b"content-length"].isdigit() or int(fields[b"content-length"]) + 4 != len(rest):
        raise WarcError(f"{where}: Content-Length {fields[b'content-length'][:20]!r}, block of {len(rest) - 4}")
    if rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"{where}: no line ends after the block")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    page = _PAGE.fullmatch(fields[b"warc-record-id"])
    kind = fields[b"warc-type"].decode()
    length = re.search(rb"\r\nContent-Length: (\d+)", http)
    if not blank or not page or kind not in ("response", "revisit") or not length:
        raise WarcError(f"{where}: not a record of a page")
    digest = fields.get(b"warc-payload-digest", b"")[5:].decode()
    refers = _PAGE.fullmatch(fields.get(b"warc-refers-to", b""))
    if kind == "response" and (digest != digest_of(payload) or int(length[1]) != len(payload)):
        raise WarcError(f"{where}: the payload does not have its digest or length")
    if kind == "revisit" and (not refers or payload):
        raise WarcError(f"{where}: a revisit needs WARC-Refers-To and no payload")
    name = page[1].decode()
    return {
        "page_id": None if name == NO_ID else name,
        "url": fields.get(b"warc-target-uri", b"").decode(),
        "record_type": kind,
        "payload_bytes": int(length[1]),
        "payload_digest": digest,
        "refers_to": refers[1].decode() if refers else None,
        "payload": payload if kind == "response" else None,
    }


def dictionary(pages: DataFrame) -> bytes:
    """A zstandard dictionary from pages of least hash: about ``SAMPLE_PAGES`` pages, of each at
    most ``SAMPLE_BYTES``. Too few pages for training give their joined text as a raw dictionary."""
    pages = pages.where("octet_length(html) > 0")
    h = F.pmod(F.xxhash64("page_id", F.octet_length("html")), F.lit(1 << 30))
    limit = (1 << 30) * min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    drawn = pages.where(h <= int(limit)).select(h.alias("h"), F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES).alias("part"))
    sample = sorted(drawn.collect(), key=lambda r: (r.h, bytes(r.part)))
    parts = [bytes(r.part) for r in sample]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def _file(folder: str):
    """A file system and a path in it, for the shared folder in any form that Spark takes."""
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)


class _Archive:
    def __init__(self, folder: str, name: str, words: bytes):
        self.system, self.path = _file(folder)
        self.name, self.size = name, 0
        self.open_as = f"{self.path}/_{name}.{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.open_as, compression=None)
        self.coder = zstandard.ZstdCompressor(LEVEL, dict_data=zstandard.ZstdCompressionDict(words) if words else None)
        self._write(struct.pack("<II", SKIPPABLE, len(words)) + words)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._write(self.coder.compress(data))

    def close(self) -> str:
        self.out.close()
        self.system.move(self.open_as, f"{self.path}/{self.name}.warc.zst")
        return f"{self.name}.warc.zst"


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write all pages as archives below ``folder``; gives the table of archives and records.

    Which page of a payload is the response is told by one aggregate over the digests; only
    payloads that occur more than once are joined back to the pages.
    """
    pages = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    words = dictionary(pages)
    system, path = _file(folder)
    system.create_dir(path, recursive=True)
    told = F.when(F.octet_length("html") >= least, F.sha1("html"))
    marked = pages.withColumn("digest", told)
    same = marked.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    same = stored(same.where("n > 1 and first is not null").select("digest", "first"), "warc-same")
    side = F.broadcast(same) if same.count() <= BROADCAST_ROWS else same
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    rows = marked.join(side, "digest", "left").select(
        F.coalesce(F.col("page_id").cast("string"), F.lit(NO_ID)).alias("page_id"),
        F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit("urn:none")).alias("url"),
        F.col("html").cast("binary").alias("html"),
        refers.alias("refers_to"),
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, held, count, done = TaskContext.get().partitionId(), 0, None, 0, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None:
                    held, count, nth = _Archive(folder, f"{task:06d}-{nth:04d}", words), 0, nth + 1
                held.add(record(page_id, url, html, digest_of(html), refers_to))
                count += 1
                if held.size >= ARCHIVE_BYTES:
                    done.append((held.close(), count))
                    held = None
        if held is not None:
            done.append((held.close(), count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["archive", "records"])

    return stored(rows.mapInArrow(archive, "archive string, records long"), "warc-archives")


def records(data, where: str) -> Iterator[bytes]:
    """The records of an open archive: the dictionary's frame, then one frame each."""
    head = data.read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != SKIPPABLE:
        raise WarcError(f"{where}: no dictionary frame at the beginning")
    size = struct.unpack("<II", head)[1]
    words = data.read(size)
    if len(words) != size:
        raise WarcError(f"{where}: the dictionary is cut off")
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    rest, nth = b"", 0
    while rest or (rest := data.read(READ_BYTES)):
        frame, out = decoder.decompressobj(), []
        while not frame.eof:
            if not rest and not (rest := data.read(READ_BYTES)):
                raise WarcError(f"{where}: record {nth} is cut off")
            try:
                out.append(frame.decompress(rest))
            except zstandard.ZstdError as fault:
                raise WarcError(f"{where}: record {nth}: {fault}") from None
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(out)
        nth += 1


def read(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives named in ``archives`` (archive, records), validated.

    The number of records of each archive is checked as well. A task reads one archive after the
    other, a few MB at once.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file(folder)
        for batch in batches:
            for name, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size, n = [], 0, 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as data:
                    for raw in records(data, name):
                        row = parse(raw, f"{name}: record {n}")
                        n += 1
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows, size = [], 0
                if n != count:
                    raise WarcError(f"{name}: {n} records, written were {count}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    each = archives.select("archive", "records")
    return each.repartition(F.col("archive")).mapInArrow(load, _SQL_READ)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/permeate/warc-{uuid.uuid4().hex}"


def pages_archived(pages: DataFrame) -> DataFrame:
    """The query's rows: each page as it was read back from the archives."""
    spark = pages.sparkSession
    folder = new_folder(spark)
    archives = write(pages, folder)
    found = read(spark, archives, folder, payloads=False)
    return found.select(
        F.col("page_id").cast("long"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long"),
    )


#: The same rows in SQL; the base 32 of a digest is taken five bits at a time.
SQL = r"""
with p as (select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex from pages),
first as (select hex, min(page_id) as first from p group by hex),
digits as (
  select page_id, hex, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
      ((bits >> (35 - 5 * k)) & 31)::int, 1), '' order by part, k) as base32
  from (select page_id, hex, part, ('0x' || substr(hex, 1 + 10 * part, 10))::bigint as bits, unnest(range(8)) as k
        from (select page_id, hex, unnest(range(4)) as part from p))
  group by page_id, hex)
select page_id, octet_length(payload)::bigint as payload_bytes, base32 as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from p join first using (hex) join digits using (page_id, hex)
"""
