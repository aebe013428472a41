"""Files that tasks write and read through the file system of a shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs


def system(location: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(location if "://" in location else f"file://{location}")


def unique(folder: str, ending: str) -> str:
    """A new name in a folder. Every attempt of a task writes a file of its own; only those whose
    rows Spark has committed are ever read."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{ending}"


class Output:
    """A file that counts the bytes written to it."""

    def __init__(self, location: str):
        files, path = system(location)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self._stream = files.open_output_stream(path, compression=None)
        self.place = 0

    def write(self, data: bytes) -> None:
        self._stream.write(data)
        self.place += len(data)

    def close(self) -> None:
        self._stream.close()


def read_range(location: str, offset: int, length: int) -> bytes:
    files, path = system(location)
    with files.open_input_file(path) as f:
        return f.read_at(length, offset)
