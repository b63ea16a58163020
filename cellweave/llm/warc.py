"""WARC archives under Zstandard: one frame a record, the dictionary in the leading skippable frame.

Writer: every task fills archives of bounded size. The dictionary is trained on the first
payloads of the archive (at most SAMPLE_BYTES of them) and stored, compressed itself, in a skippable frame
ahead of all records. Reader: loads that dictionary, decodes frame after frame, and holds headers,
lengths and digests against what it has decoded.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .shared import need, salted_join, scratch, slices, stored

# Fixed values of the archive format: the skippable frame that holds a dictionary; the version line.
MAGIC, VERSION = 0x184D2A5D, b"WARC/1.1"
#: Payload in an archive, payload for a dictionary, size of a dictionary, bytes decoded at a time.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES, CHUNK = 1 << 25, 1 << 20, 1 << 15, 1 << 14
#: Smallest payload that may be revisited, and the date of all records.
LEAST, DATE = 100, "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit without; both state length and digest of the full payload."""
    body = b"" if refers_to is not None else payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(body))),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + body + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> bytes:
    """Trained where the samples suffice for it, else the samples' own first bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archive(folder: str, name: str, records: list[bytes]) -> str:
    samples, n = [], 0
    for r in records:
        if n + len(r) > SAMPLE_BYTES:
            break
        samples.append(r)
        n += len(r)
    raw = dictionary_of(samples)
    shown = zstandard.ZstdCompressor(level=9).compress(raw)
    path, stream = files.create(folder, name)
    with stream:
        stream.write(struct.pack("<II", MAGIC, len(shown)) + shown)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        for r in records:
            stream.write(squeeze.compress(r))
    return path


def frames(path: str) -> Iterator[bytes]:
    """The decoded frames of an archive, each exactly one; a cut or trailing piece is an error."""
    with files.reopen(path) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != MAGIC:
            raise ValueError(f"{path} has no dictionary frame")
        raw = stream.read(size)
        if len(raw) < size:
            raise ValueError(f"{path} is cut short")
        if raw[:4] == zstandard.FRAME_HEADER:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        rest = stream.read(CHUNK)
        while rest:
            one, out = unpack.decompressobj(), []
            while not one.eof:
                if not rest:
                    raise ValueError(f"{path} ends within a record")
                out.append(one.decompress(rest))
                rest = one.unused_data if one.eof else stream.read(CHUNK)
            rest = rest or stream.read(CHUNK)
            yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, body) of one record; raises where the version, a header or a length is not as it must be."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION or not gap:
        raise ValueError("no WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        key, colon, value = line.decode().partition(":")
        if not colon or not key or key in headers:
            raise ValueError(f"bad header {line!r}")
        headers[key] = value.strip()
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the record states {size} bytes and has {len(rest) - 4}")
    return headers, rest[:size]


def page_of(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record, validated."""
    headers, body = parse(data)
    number = lambda name: int(headers[name].removeprefix("<urn:page:").removesuffix(">"))
    kind, digest, length = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["WARC-Payload-Length"])
    if kind == "response":
        if len(body) != length or hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not as stated")
        return number("WARC-Record-ID"), length, digest, kind, None
    if kind != "revisit" or body or headers.get("WARC-Profile") != PROFILE:
        raise ValueError(f"record {headers['WARC-Record-ID']} is neither response nor revisit")
    return number("WARC-Record-ID"), length, digest, kind, number("WARC-Refers-To")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Writes every page to archives in folder; returns the stored manifest (path, records).

    Of pages with equal payloads of ``least`` bytes or more, those with the smallest page_id are responses,
    the others revisit it. Null html is an empty payload. Repeated rows give a record each;
    null page_ids are refused; an empty table gives no archive.
    """
    need(pages, page_id, url, html)
    if pages.where(F.col(page_id).isNull()).head(1):
        raise ValueError("a page has no page_id")
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    full = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    thin = stored(full.where(F.length("payload") >= least).select("page_id", "digest"), "digests")
    first = stored(thin.groupBy("digest").agg(F.min("page_id").alias("to"), F.max("page_id").alias("_last")).where("to < _last").drop("_last"), "first")
    again = salted_join(thin, first, "digest", "page_id").where("page_id > to").distinct()
    rows = full.join(again, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "to")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, made = [], 0, []
        part = TaskContext.get().partitionId()

        def close() -> None:
            made.append((write_archive(folder, f"pages-{part:06d}-{len(made):04d}.warc.zst", held), len(held)))

        for batch in slices(batches, 2, 1 << 21):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(record(*row))
                n += len(held[-1])
                if n >= ARCHIVE_BYTES:
                    close()
                    held, n = [], 0
        if held:
            close()
        if made:
            yield pa.record_batch([pa.array(x) for x in zip(*made)], ["path", "records"])

    return stored(rows.mapInArrow(run, "path string, records long"), "archives")


def read(archives: DataFrame) -> DataFrame:
    """A row for each record of the archives of a manifest; fails where an archive has more or fewer records."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [page_of(x) for x in frames(path)]
                if len(rows) != n:
                    raise ValueError(f"{path} has {len(rows)} records, not {n}")
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    spread = archives.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.select("path", "records").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    return read(write(pages, scratch(pages.sparkSession, "warc"), **options))


SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS one FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND one < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND one < page_id THEN one END AS refers_to
FROM firsts
"""
