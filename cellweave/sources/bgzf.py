"""Blocked gzip: files of small gzip members that state their own size, so a reader may start at any of them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyarrow import fs

#: Fixed values of the format: how a block starts, the size of text that a block may hold, and the empty block at the end of a file.
MAGIC = b"\x1f\x8b\x08\x04"
MOST = 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes that are read at a time.
READ = 1 << 20


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def block_size(head: bytes) -> int:
    """Bytes of the block that starts here, 0 where none does; head: 18 bytes at least."""
    if len(head) < 18 or head[:4] != MAGIC:
        return 0
    extra = struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(12 + extra, len(head)):
        tag, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if tag == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def block(data: bytes) -> bytes:
    """At most MOST bytes as one block."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    head = MAGIC + struct.pack("<IBBHBBHH", 0, 0, 0xFF, 6, 0x42, 0x43, 2, len(packed) + 25)
    return head + packed + struct.pack("<II", zlib.crc32(data), len(data))


class Blocks:
    """The blocks of an open file from a byte on: (where it starts, its text)."""

    def __init__(self, file, start: int, size: int):
        self.file, self.at, self.size, self.held, self.base = file, start, size, b"", start

    def bytes_at(self, at: int, n: int) -> bytes:
        if not (self.base <= at and at + n <= self.base + len(self.held)):
            self.held, self.base = self.file.read_at(min(max(n, READ), max(0, self.size - at)), at), at
        return self.held[at - self.base : at - self.base + n]

    def seek_block(self) -> bool:
        """Moves to the first block that starts at or behind the place, as far as there is one; the block behind it must start too."""
        while self.at < self.size:
            part = self.bytes_at(self.at, min(READ, self.size - self.at))
            found = part.find(MAGIC)
            if found < 0:
                self.at += max(1, len(part) - 3)
                continue
            self.at += found
            n = block_size(self.bytes_at(self.at, 64))
            if n and (self.at + n == self.size or block_size(self.bytes_at(self.at + n, 64))):
                return True
            self.at += 1
        return False

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while self.at < self.size:
            n = block_size(self.bytes_at(self.at, 64))
            raw = self.bytes_at(self.at, n)
            if not n or len(raw) < n:
                raise ValueError(f"no whole block at byte {self.at}")
            extra = struct.unpack_from("<H", raw, 10)[0]
            text = zlib.decompress(raw[12 + extra : -8], -15)
            if (zlib.crc32(text), len(text)) != struct.unpack_from("<II", raw, n - 8):
                raise ValueError(f"the block at byte {self.at} is damaged")
            at, self.at = self.at, self.at + n
            yield at, text


class Writer:
    """Writes bytes as blocks to an open stream."""

    def __init__(self, stream):
        self.stream, self.held = stream, bytearray()

    def write(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= MOST:
            self.stream.write(block(bytes(self.held[:MOST])))
            del self.held[:MOST]

    def flush(self) -> None:
        if self.held:
            self.stream.write(block(bytes(self.held)))
            self.held.clear()
