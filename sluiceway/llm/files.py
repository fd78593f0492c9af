"""Files of own formats in the folder that all executors share."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a ``file:``, ``hdfs:``, ``s3:`` or ``gs:`` address or a plain path, and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Output:
    """A file that appears under its name only when it is whole, so a repeated or lost task leaves no half of one."""

    def __init__(self, folder: str, name: str):
        self.fs, base = opened(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.partial = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.partial)
        self.size = 0

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        self.size += len(data)
        return len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.partial, self.path)
