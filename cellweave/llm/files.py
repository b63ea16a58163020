"""Binary files in the shared folder, by any URI that pyarrow's file systems open.

Tasks write under names of their own attempt and report them as rows; only the rows of the
attempt that Spark commits are read, so retried and speculative tasks do no harm.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def create(folder: str, name: str):
    """(path, open stream) of a new file that no other attempt can take."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    return f"{folder}/{name}", system.open_output_stream(f"{root}/{name}")


def reopen(path: str):
    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)
