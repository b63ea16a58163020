"""Lines of text as one file: tasks write parts, and the commit joins them in the order of the partitions.

Gzipped parts are members of their own, which follow on one another in one gzip file. Parts are copied as bytes, a megabyte at a time;
a task that runs again writes a part of its own, and only parts of tasks that committed are joined.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .bgzf import READ, store_of


@dataclass
class Part(WriterCommitMessage):
    nth: int
    path: str


class LinesWriter(DataSourceArrowWriter):
    """Rows of one text column."""

    def __init__(self, options: dict):
        self.path, self.head = options["path"], options.get("head", "")
        self.packed = self.path.endswith(".gz")
        self.work = f"{self.path}._work-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        store, inner = store_of(self.work)
        store.create_dir(inner)
        nth = TaskContext.get().partitionId()
        name = f"{inner}/{nth}-{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            stream = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6, mtime=0) if self.packed else out
            for batch in iterator:
                text = io.StringIO()
                text.writelines(f"{x}\n" for x in batch.column(0).to_pylist())
                stream.write(text.getvalue().encode())
            if self.packed:
                stream.close()
        return Part(nth, name)

    def commit(self, messages: list[Part | None]) -> None:
        store, inner = store_of(self.path)
        store.create_dir(inner.rsplit("/", 1)[0])
        with store.open_output_stream(f"{inner}._new") as out:
            head = self.head.encode()
            if head or not any(messages):
                out.write(gzip.compress(head, mtime=0) if self.packed else head)
            for part in sorted((m for m in messages if m), key=lambda m: m.nth):
                with store.open_input_stream(part.path) as held:
                    while data := held.read(READ):
                        out.write(data)
        store.move(f"{inner}._new", inner)
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        store, inner = store_of(self.work)
        if store.get_file_info(inner).type == fs.FileType.Directory:
            store.delete_dir(inner)


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "joined_lines"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options)


def write_lines(rows: DataFrame, path: str, head: str = "") -> None:
    """The one text column of rows as one file, gzipped if its name ends so, in the order of the partitions behind ``head``."""
    rows.sparkSession.dataSource.register(Lines)
    rows.write.format("joined_lines").mode("append").option("head", head).save(path)
