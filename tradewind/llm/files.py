"""Binary files in the shared folder, through the file system of its URI (file, hdfs, s3, gs)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class NewFile:
    """A file that appears under its name only when it is complete."""

    def __init__(self, path: str):
        self._fs, self._path = file_system(path)
        self._fs.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._draft = f"{self._path}.{uuid.uuid4().hex[:12]}.draft"
        self._out = self._fs.open_output_stream(self._draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        try:
            self._fs.move(self._draft, self._path)
        except OSError:
            # A file system whose rename does not replace: an earlier attempt was complete.
            self._fs.delete_file(self._draft)
