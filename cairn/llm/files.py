"""Files of an operator's own format in the shared folder, written and read by executors.

Names carry a random part, so a task that runs twice leaves two files and only
the one whose row was committed is ever named in a manifest.
"""

from __future__ import annotations

import uuid

import pyarrow.fs


def locate(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def fresh_name(folder: str, prefix: str, part: int, suffix: str) -> str:
    return f"{folder}/{prefix}-{part:06d}-{uuid.uuid4().hex}{suffix}"


class Writer:
    """A file that knows its length."""

    def __init__(self, uri: str):
        fs, path = locate(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.size = uri, 0
        self._out = fs.open_output_stream(path, compression=None)

    def write(self, data: bytes) -> int:
        """Append, and return where the data begins."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()


class Reader:
    """Range reads of one file."""

    def __init__(self, uri: str):
        fs, path = locate(uri)
        self._in = fs.open_input_file(path)

    def size(self) -> int:
        return self._in.size()

    def read(self, offset: int, length: int) -> bytes:
        return self._in.read_at(length, offset)

    def close(self) -> None:
        self._in.close()
