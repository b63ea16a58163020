"""Binary alignment files (BAM) as a Spark data source, and alignments written as BAM or SAM.

A file is read in splits of compressed bytes. A split owns the records that start in a block of its bytes and reads the
last one to its end; it finds its first one by records that follow on one another, and checks when it ends that the next split
starts where it stopped. Tasks decode into Arrow batches.

Written alignments are one file, or one for each value of a column: tasks write parts without a header, and the commit
puts the header before them, in the order of the partitions. Parts are copied as bytes, a megabyte at a time.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import bgzf, tables

#: Fixed values of the format: letters of packed bases and of operations, kinds of tag values and of array values.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
SCHEMA = "qname string, flag int, chrom string, start int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, tags array<string>"
ARROW = pa.schema([(x.split()[0], {"int": pa.int32(), "string": pa.string()}.get(x.split()[1], pa.list_(pa.string()))) for x in SCHEMA.split(", ")])
#: Bytes of a split, records of a batch, and records that must follow on one another where a split starts.
SPLIT_BYTES, BATCH, CHAIN = 64 << 20, 4096, 16
FROM_HEX = str.maketrans("0123456789abcdef", BASES)
TO_HEX = str.maketrans({**{b: "0123456789abcdef"[i] for i, b in enumerate(BASES)}, **{b.lower(): "0123456789abcdef"[i] for i, b in enumerate(BASES)}})
QUALITY = bytes(min(i + 33, 126) for i in range(256))
PLAIN = bytes(max(i - 33, 0) for i in range(256))
NAME = re.compile(rb"[!-~]{1,254}\0")


class Stream:
    """The text of a file's blocks in turn, with the place (block, byte in it) of each byte."""

    def __init__(self, path: str, start: int = 0, seek: bool = False):
        store, inner = bgzf.store_of(path)
        self.size = store.get_file_info(inner).size
        self.blocks = bgzf.Blocks(store.open_input_file(inner), start, self.size)
        self.found = not seek or self.blocks.seek_block()
        self.source = iter(self.blocks)
        self.data, self.at = bytearray(), 0
        self.marks: list[tuple[int, int]] = []  # (byte in data, block that starts there)

    def more(self) -> bool:
        for block, text in self.source:
            self.marks.append((len(self.data), block))
            self.data += text
            return True
        return False

    def have(self, n: int) -> bool:
        """Whether n bytes lie ahead; reads blocks until they do."""
        while len(self.data) - self.at < n:
            if not self.more():
                return False
        return True

    def place(self) -> tuple[int, int]:
        """(block, byte in it) of the next byte; at the end of a block that is the next one's first."""
        if len(self.data) == self.at and not self.have(1):
            return self.size, 0
        start, block = next(m for m in reversed(self.marks) if m[0] <= self.at)
        return block, self.at - start

    def drop(self) -> None:
        """Forgets what is read."""
        if self.at > 1 << 20:
            keep = [m for m in self.marks if m[0] > self.at]
            last = [m for m in self.marks if m[0] <= self.at][-1:]
            self.marks = [(a - self.at, b) for a, b in [*last, *keep]]
            del self.data[: self.at]
            self.at = 0


def header_of(stream: Stream) -> tuple[str, list[str]]:
    """(header text, names of the references); the stream stands behind them."""
    if not stream.have(12) or bytes(stream.data[:4]) != b"BAM\1":
        raise ValueError("this is no BAM file")
    n = struct.unpack_from("<i", stream.data, 4)[0]
    stream.have(12 + n)
    text = bytes(stream.data[8 : 8 + n]).rstrip(b"\0").decode()
    stream.at, names = 12 + n, []
    for _ in range(struct.unpack_from("<i", stream.data, 8 + n)[0]):
        stream.have(4)
        size = struct.unpack_from("<i", stream.data, stream.at)[0]
        stream.have(8 + size)
        names.append(bytes(stream.data[stream.at + 4 : stream.at + 3 + size]).decode())
        stream.at += 8 + size
    return text, names


def plausible(stream: Stream, at: int, references: int) -> int:
    """Bytes of the record that could start at byte ``at`` of the stream's data; 0 if none could, -1 at the end of the file."""
    stream.at = at
    if not stream.have(4):
        return -1 if len(stream.data) == at else 0
    size = struct.unpack_from("<i", stream.data, at)[0]
    if size < 34 or size > 1 << 28 or not stream.have(36):
        return 0
    ref, pos, n_name, _, _, n_cigar, _, n_seq, other, other_pos, _ = struct.unpack_from("<iiBBHHHiiii", stream.data, at + 4)
    if not (-1 <= ref < references and -1 <= pos and n_name > 1 and n_seq >= 0 and -1 <= other < references and -1 <= other_pos):
        return 0
    if 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq > size or not stream.have(36 + n_name):
        return 0
    return 4 + size if NAME.fullmatch(bytes(stream.data[at + 36 : at + 36 + n_name])) else 0


def first_record(stream: Stream, references: int) -> bool:
    """Moves to the first byte from which on CHAIN records, or all up to the end of the file, follow on one another."""
    start = stream.at
    while True:
        stream.at = start
        if not stream.have(36):
            stream.at = len(stream.data)
            return False
        at = start
        for _ in range(CHAIN):
            n = plausible(stream, at, references)
            if n <= 0:
                break
            at += n
        stream.at = start
        if n != 0:
            return True
        start += 1


def tag_text(data: bytes, at: int, end: int) -> list[str]:
    out = []
    while at < end:
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind == "A":
            out.append(f"{name}:A:{chr(data[at])}")
            at += 1
        elif kind in NUMBERS:
            value = struct.unpack_from(NUMBERS[kind], data, at)[0]
            out.append(f"{name}:f:{value:g}" if kind == "f" else f"{name}:i:{value}")
            at += struct.calcsize(NUMBERS[kind])
        elif kind in "ZH":
            stop = data.index(b"\0", at)
            out.append(f"{name}:{kind}:{data[at:stop].decode()}")
            at = stop + 1
        elif kind == "B":
            each, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[each][1]}", data, at + 5)
            out.append(f"{name}:B:{each}" + "".join(f",{v:g}" if each == "f" else f",{v}" for v in values))
            at += 5 + n * struct.calcsize(NUMBERS[each])
        else:
            raise ValueError(f"tag {name} has the unknown kind {kind!r}")
    return out


def decoded(data: bytes, names: list[str]) -> tuple:
    """The columns of one record, without its size."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, other, other_pos, tlen = struct.unpack_from("<iiBBHHHiiii", data)
    at = 32 + n_name
    cigar = "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in struct.unpack_from(f"<{n_cigar}I", data, at)) or "*"
    at += 4 * n_cigar
    seq = data[at : at + (n_seq + 1) // 2].hex().translate(FROM_HEX)[:n_seq] or "*"
    at += (n_seq + 1) // 2
    qual = data[at : at + n_seq]
    qual = "*" if not qual or qual[0] == 0xFF else qual.translate(QUALITY).decode()
    tags = tag_text(data, at + n_seq, len(data))
    for i, tag in enumerate(tags):  # operations beyond 65535 are in a tag
        if tag.startswith("CG:B:I,"):
            cigar = "".join(f"{int(x) >> 4}{OPERATIONS[int(x) & 15]}" for x in tag[7:].split(","))
            del tags[i]
            break
    chrom = names[ref] if ref >= 0 else "*"
    rnext = "*" if other < 0 else "=" if other == ref else names[other]
    return data[32 : 31 + n_name].decode(), flag, chrom, pos, mapq, cigar, rnext, other_pos + 1, tlen, seq, qual, tags


def encoded(line: str, places: dict[str, int]) -> bytes:
    """One SAM line as a record, its size before it."""
    f = line.rstrip("\n").split("\t")
    if len(f) < 11:
        raise ValueError(f"no alignment: {line[:80]!r}")
    operations = [int(n) << 4 | OPERATIONS.index(o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", f[5])] if f[5] != "*" else []
    used = sum(x >> 4 for x in operations if OPERATIONS[x & 15] in "MDN=X")
    seq = "" if f[9] == "*" else f[9]
    pos, tags = int(f[3]) - 1, [tag_bytes(t) for t in f[11:]]
    if len(operations) > 65535:
        tags.append(b"CGBI" + struct.pack(f"<i{len(operations)}I", len(operations), *operations))
        operations = [len(seq) << 4 | 4, used << 4 | 3]
    packed = bytes.fromhex(seq.translate(TO_HEX) + "0" * (len(seq) % 2))
    qual = b"\xff" * len(seq) if f[10] == "*" else f[10].encode().translate(PLAIN)
    other = places[f[2]] if f[6] == "=" else places[f[6]]
    name = f[0].encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", places[f[2]], pos, len(name), int(f[4]), bin_of(max(pos, 0), max(pos, 0) + max(used, 1)), len(operations), int(f[1]), len(seq), other, int(f[7]) - 1, int(f[8]))
    body += name + struct.pack(f"<{len(operations)}I", *operations) + packed + qual + b"".join(tags)
    return struct.pack("<i", len(body)) + body


def bin_of(start: int, stop: int) -> int:
    """The smallest bin of the format's six levels (16 kb, each level eight times as wide) that holds the stretch."""
    for level in range(5, 0, -1):
        shift = 14 + 3 * (5 - level)
        if start >> shift == (stop - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def tag_bytes(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    if kind == "A":
        return f"{name}A{value}".encode()
    if kind == "i":
        n = int(value)
        return f"{name}{'i' if n < 1 << 31 else 'I'}".encode() + struct.pack("<i" if n < 1 << 31 else "<I", n)
    if kind == "f":
        return f"{name}f".encode() + struct.pack("<f", float(value))
    if kind == "B":
        each, *values = value.split(",")
        return f"{name}B{each}".encode() + struct.pack("<i", len(values)) + b"".join(struct.pack(NUMBERS[each], float(v) if each == "f" else int(v)) for v in values)
    return f"{name}{kind}{value}".encode() + b"\0"


# The source ----------------------------------------------------------------------------------------


@dataclass
class Split(InputPartition):
    path: str
    start: int
    stop: int
    references: list[str]


def files_of(path: str) -> list[str]:
    """The path itself, or the alignment files of a folder."""
    store, inner = bgzf.store_of(path)
    if store.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    return sorted(f"{path.rstrip('/')}/{x.base_name}" for x in store.get_file_info(fs.FileSelector(inner)) if x.base_name.endswith(".bam"))


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [f for p in (json.loads(options["paths"]) if "paths" in options else [options["path"]]) for f in files_of(p)]
        self.parts, self.split = int(options.get("partitions", 0)), int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        out = []
        for path in self.paths:
            stream = Stream(path)
            names = header_of(stream)[1]
            n = self.parts or max(1, -(-stream.size // self.split))
            bounds = [stream.size * i // n for i in range(n + 1)]
            out += [Split(path, a, b, names) for a, b in zip(bounds[:-1], bounds[1:]) if a < b]
        return out

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        stream = Stream(split.path, split.start, split.start > 0)
        if split.start == 0:
            header_of(stream)
        elif not stream.found or stream.blocks.at >= split.stop or not first_record(stream, len(split.references)):
            return
        rows: list[tuple] = []
        while (place := stream.place())[0] < split.stop:
            stream.have(4)
            n = struct.unpack_from("<i", stream.data, stream.at)[0]
            if not stream.have(4 + n):
                raise ValueError(f"{split.path} ends within a record")
            rows.append(decoded(bytes(stream.data[stream.at + 4 : stream.at + 4 + n]), split.references))
            stream.at += 4 + n
            stream.drop()
            if len(rows) == BATCH:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)
        if split.stop < stream.size:
            after = Stream(split.path, split.stop, True)
            if after.found and first_record(after, len(split.references)) and after.place() > place:
                raise ValueError(f"{split.path}: the records behind byte {split.stop} do not follow on those before it; read it with fewer partitions")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


@dataclass
class Part(WriterCommitMessage):
    files: list[tuple[str, int, str]]  # value of the key, partition, path


class AlignmentWriter(DataSourceArrowWriter):
    """Rows of ``line`` (SAM text) and, with option ``by``, a key."""

    def __init__(self, options: dict):
        self.path, self.by, self.header = options["path"].rstrip("/"), options.get("by"), options["header"]
        self.kind = options.get("kind", "bam")
        self.work = f"{self.path}._work-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        nth, store, inner = TaskContext.get().partitionId(), *bgzf.store_of(self.work)
        store.create_dir(inner)
        places = {name: i for i, name in enumerate(references_of(self.header))} | {"*": -1}
        found: dict[str, tuple[str, object, object]] = {}
        for batch in iterator:
            keys = batch.column(self.by).cast(pa.string()).to_pylist() if self.by else [""] * batch.num_rows
            for key, line in zip(keys, batch.column("line").to_pylist()):
                key = "unassigned" if key is None else re.sub(r"[/\\]", ",", key).replace(" ", "_")
                if key not in found:  # a task that is run again writes files of its own
                    name = f"{inner}/{len(found)}-{nth}-{uuid.uuid4().hex}"
                    stream = store.open_output_stream(name)
                    found[key] = name, stream, bgzf.Writer(stream) if self.kind == "bam" else stream
                found[key][2].write(encoded(line, places) if self.kind == "bam" else f"{line}\n".encode())
        for _, stream, writer in found.values():
            if self.kind == "bam":
                writer.flush()
            stream.close()
        return Part([(key, nth, name) for key, (name, _, _) in found.items()])

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((x for m in messages if m for x in m.files), key=lambda x: (x[0], x[1]))
        store, inner = bgzf.store_of(self.path)
        if self.by:
            store.create_dir(inner)
        for key in sorted({p[0] for p in parts}) if self.by else [""]:
            target = f"{inner}/{key}.{self.kind}" if self.by else inner
            with store.open_output_stream(f"{target}._new") as out:
                out.write(head_bytes(self.header) if self.kind == "bam" else self.header.encode())
                for _, _, name in (p for p in parts if p[0] == key):
                    with store.open_input_stream(name) as part:
                        while data := part.read(bgzf.READ):
                            out.write(data)
                if self.kind == "bam":
                    out.write(bgzf.END)
            store.move(f"{target}._new", target)
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        store, inner = bgzf.store_of(self.work)
        if store.get_file_info(inner).type == fs.FileType.Directory:
            store.delete_dir(inner)


class Bam(DataSource):
    """Format ``bam``. Reading: path (a file or folder) or paths (several, as JSON), partitions or splitbytes. Writing: see ``write_alignments``."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> AlignmentWriter:
        return AlignmentWriter(self.options)


def references_of(header: str) -> dict[str, int]:
    """Names and lengths of the references that a header's text lists, in turn."""
    found = {}
    for line in header.splitlines():
        if line.startswith("@SQ"):
            f = dict(x.split(":", 1) for x in line.split("\t")[1:])
            found[f["SN"]] = int(f["LN"])
    return found


def head_bytes(header: str) -> bytes:
    text, refs = header.encode(), references_of(header)
    data = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs))
    data += b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs.items())
    return b"".join(bgzf.block(data[a : a + bgzf.MOST]) for a in range(0, len(data), bgzf.MOST))


def read_header(path: str) -> str:
    """The header text of a BAM or SAM file."""
    path = files_of(path)[0]
    store, inner = bgzf.store_of(path)
    with store.open_input_file(inner) as file:
        packed = file.read_at(4, 0) == bgzf.MAGIC
    if packed:
        return header_of(Stream(path))[0]
    lines, rest = [], b""
    with store.open_input_stream(inner) as file:
        while data := file.read(1 << 16):
            *whole, rest = (rest + data).split(b"\n")
            for line in whole:
                if not line.startswith(b"@"):
                    return "".join(f"{x}\n" for x in lines)
                lines.append(line.decode())
    return "".join(f"{x}\n" for x in [*lines, *([rest.decode()] if rest.startswith(b"@") else [])])


def with_program(header: str, name: str, version: str = "", command: str = "") -> str:
    """The header with one more program line, chained to the last one; a taken id gets a number, from 2 on."""
    ids = re.findall(r"^@PG\t(?:.*\t)?ID:([^\t\n]+)", header, re.M)
    own, n = name, 1
    while own in ids:
        n += 1
        own = f"{name}.{n}"
    more = [f"ID:{own}", f"PN:{name}", *([f"PP:{ids[-1]}"] if ids else []), *([f"VN:{version}"] if version else []), *([f"CL:{command}"] if command else [])]
    return header + ("" if not header or header.endswith("\n") else "\n") + "\t".join(["@PG", *more]) + "\n"


def bam(spark: SparkSession, path: str | list[str], partitions: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of BAM files, with the columns of ``tables.sam``; files of a folder are read in the order of their names."""
    spark.dataSource.register(Bam)
    rows = spark.read.format("bam").option("partitions", partitions).option("splitbytes", split_bytes).option("paths", json.dumps([path] if isinstance(path, str) else path)).load()
    pairs = F.transform("tags", lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20)))
    fields = ["qname", "flag", "chrom", F.col("start") + 1, "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    line = F.concat_ws("\t", *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in fields), "tags")
    return rows.withColumns({"line": line, "tags": tables.first_of(pairs)}).withColumns(tables.derived()).drop("rnext", "pnext", "tlen", "qual")


def write_alignments(rows: DataFrame, path: str, header: str, by: str | None = None, program: str | None = None, command: str = "", kind: str = "bam") -> None:
    """rows (line: SAM text; by: a key) as one file, or as one for each value of ``by`` in the folder ``path``, rows without one in ``unassigned``.

    kind: bam or sam. Lines come in the order of the partitions; ``program`` adds a line to the header. An empty table gives a file
    with the header alone.
    """
    if kind not in ("bam", "sam"):
        raise ValueError(f"{kind!r} is neither bam nor sam")
    rows.sparkSession.dataSource.register(Bam)
    text = with_program(header, program, command=command) if program else header
    options = {"header": text, "kind": kind} | ({"by": by} if by else {})
    rows.select("line", *([by] if by else [])).write.format("bam").mode("append").options(**options).save(path)
