"""Media columns: ISO base media files written, walked and described without decoding samples.

``describe`` walks the nested boxes of a file, expands the sample tables (stts, stsz, stsc,
stco/co64, stss) and gives codec, duration and the byte range of every key frame. ``wrap`` stores
bytes losslessly as a track of uncompressed 8-bit grey frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import need, slices, stored

# Fixed values of the container format: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"udta", b"mvex"}
#: Bytes of a frame, frames of a chunk, frames from one key frame to the next, ticks of a frame and a second.
FRAME, CHUNK, KEYS, TICKS, SCALE = 64, 64, 32, 1, 25


@dataclass
class Track:
    codec: str = ""
    scale: int = 0
    duration: int = 0
    width: int = 0
    height: int = 0
    tables: dict = field(default_factory=dict)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """(offset in the file, size) of every sample."""
        same, sizes = self.tables.get("stsz", (0, np.zeros(0, np.int64)))
        sizes = np.full(same[1], same[0], np.int64) if same else sizes
        chunks = self.tables.get("stco", np.zeros(0, np.int64))
        first = self.tables.get("stsc", np.zeros((0, 3), np.int64))
        if not len(sizes):
            return sizes, sizes
        each = np.repeat(first[:, 1], np.diff(np.r_[first[:, 0], len(chunks) + 1]))
        if each.sum() != len(sizes):
            raise ValueError("the chunks do not hold the samples")
        starts = np.cumsum(each) - each
        within = np.cumsum(sizes) - sizes
        return np.repeat(chunks - within[starts], each) + within, sizes

    def keys(self) -> np.ndarray:
        """Numbers of the key frames, from 0; all where no table lists them."""
        listed = self.tables.get("stss")
        return listed - 1 if listed is not None else np.arange(len(self.samples()[0]))


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body if len(body) < (1 << 32) - 8 else struct.pack(">I4sQ", 1, kind, 16 + len(body)) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def wrap(payload: bytes) -> bytes:
    """A file with one video track of ``raw `` frames, 64 x 1 grey pixels of 8 bits each."""
    if len(payload) % FRAME:
        raise ValueError("the payload is no whole number of frames")
    n = len(payload) // FRAME
    matrix = struct.pack(">9I", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)
    brand = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    entry = box(b"raw ", bytes(6), struct.pack(">H16xHHII4xH32xHh", 1, FRAME, 1, 72 << 16, 72 << 16, 1, 40, -1))
    full_chunks, rest = divmod(n, CHUNK)
    runs = [(1, CHUNK)] * bool(full_chunks) + [(full_chunks + 1, rest)] * bool(rest)
    keys = range(1, n + 1, KEYS)

    def movie(at: int) -> bytes:
        chunks = np.arange(0, len(payload), FRAME * CHUNK) + at
        wide = len(payload) + at >= 1 << 32
        table = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, n, TICKS)),
            full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", a, b, 1) for a, b in runs)),
            full(b"stsz", struct.pack(">II", FRAME, n)),
            full(b"co64" if wide else b"stco", struct.pack(">I", len(chunks)), chunks.astype(">u8" if wide else ">u4").tobytes()),
        )
        info = box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), table)
        media = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, SCALE, n * TICKS, 0x55C4, 0)), full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), info)
        head = full(b"tkhd", struct.pack(">IIIII8xhhhH", 0, 0, 1, 0, n * TICKS, 0, 0, 0, 0), matrix, struct.pack(">II", FRAME << 16, 1 << 16), flags=3)
        whole = full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, SCALE, n * TICKS, 1 << 16, 0x100), matrix, bytes(24), struct.pack(">I", 2))
        return box(b"moov", whole, box(b"trak", head, media))

    prefix = len(brand) + len(movie(0)) + (8 if len(payload) < (1 << 32) - 8 else 16)
    return brand + movie(prefix) + box(b"mdat", payload)


def boxes(data: memoryview, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, end of the body) of each box in a stretch; sizes are held against the stretch."""
    while start < end:
        if end - start < 8:
            raise ValueError("a box is cut short")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            (size,), head = struct.unpack_from(">Q", data, start + 8), 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} does not fit")
        yield kind, start + head, start + size
        start += size


def describe(data: bytes) -> list[Track]:
    tracks: list[Track] = []
    view = memoryview(data)

    def numbers(at: int, count: int, kind: str = ">u4") -> np.ndarray:
        return np.frombuffer(view, kind, count, at).astype(np.int64)

    def walk(start: int, end: int) -> None:
        for kind, at, stop in boxes(view, start, end):
            if kind == b"trak":
                tracks.append(Track())
            if kind in CONTAINERS:
                walk(at, stop)
                continue
            if not tracks:
                continue
            track = tracks[-1]
            if kind == b"mdhd":
                track.scale, track.duration = struct.unpack_from(">20xIQ" if view[at] == 1 else ">12xII", view, at)
            elif kind == b"stsd":
                for codec, a, b in boxes(view, at + 8, stop):
                    track.codec = codec.decode("latin-1")
                    if b - a >= 28:
                        track.width, track.height = struct.unpack_from(">24xHH", view, a)
            elif kind == b"stts":
                track.tables["stts"] = numbers(at + 8, 2 * struct.unpack_from(">I", view, at + 4)[0]).reshape(-1, 2)
            elif kind == b"stss":
                track.tables["stss"] = numbers(at + 8, struct.unpack_from(">I", view, at + 4)[0])
            elif kind == b"stsc":
                track.tables["stsc"] = numbers(at + 8, 3 * struct.unpack_from(">I", view, at + 4)[0]).reshape(-1, 3)
            elif kind == b"stsz":
                same, n = struct.unpack_from(">4xII", view, at)
                track.tables["stsz"] = ((same, n), None) if same else (0, numbers(at + 12, n))
            elif kind in (b"stco", b"co64"):
                track.tables["stco"] = numbers(at + 8, struct.unpack_from(">I", view, at + 4)[0], ">u4" if kind == b"stco" else ">u8")

    walk(0, len(data))
    return tracks


def payload_of(data: bytes, track: Track) -> bytes:
    """The samples' bytes in order; neighbouring samples are read as one."""
    at, size = track.samples()
    if not len(at):
        return b""
    breaks = np.flatnonzero(at[1:] != at[:-1] + size[:-1]) + 1
    starts, ends = at[np.r_[0, breaks]], (at + size)[np.r_[breaks - 1, len(at) - 1]]
    return b"".join(data[a:b] for a, b in zip(starts.tolist(), ends.tolist()))


def feature(track: Track) -> str:
    """Codec, frame, duration and the byte ranges of the key frames, as one line."""
    at, size = track.samples()
    keys = track.keys()
    ranges = ",".join(f"{a}-{a + n}" for a, n in zip(at[keys].tolist(), size[keys].tolist()))
    return f"codec={track.codec.strip()};frame={track.width}x{track.height};samples={len(at)};duration={track.duration}/{track.scale};keys={ranges}"


def media_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: every text, padded to whole frames, as a stored media column.

    Null and empty texts are one frame of zeros. Rows are kept as they are, repeated ones too;
    other columns are ignored.
    """
    need(docs, doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 21):
            raw = [(x or "").encode() for x in batch.column(1).to_pylist()]
            files = [wrap(x + bytes(-len(x) % FRAME or (0 if x else FRAME))) for x in raw]
            yield pa.record_batch([batch.column(0).cast("int64"), pa.array(list(map(len, raw)), pa.int64()), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    return stored(docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_bytes long, media binary"), "media")


def media_digest(table: DataFrame) -> DataFrame:
    """Digests and features of a stored media column; every payload is read through its sample tables."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1 << 21):
            rows = []
            for doc, n, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                (track,) = describe(data)
                payload = payload_of(data, track)
                rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature(track)))
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.string() if "sha" in x or x == "feature" else pa.int64() for x in names]
    schema = ", ".join(f"{x} {'string' if k == pa.string() else 'long'}" for x, k in zip(names, kinds))
    return table.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
