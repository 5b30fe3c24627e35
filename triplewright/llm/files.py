"""Files that tasks write and read in ranges, wherever the shared folder lies."""

from __future__ import annotations

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class RangeReader:
    """Reads ranges, keeping the last file open."""

    def __init__(self) -> None:
        self._uri, self._file = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self._uri:
            self.close()
            system, path = open_fs(uri)
            self._uri, self._file = uri, system.open_input_file(path)
        return self._file.read_at(length, offset)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            self._uri, self._file = None, None
