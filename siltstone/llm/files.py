"""Binary files in the shared folder, written and read by the tasks themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a bare path is a local one."""
    if "://" in uri or uri.startswith("file:"):
        scheme, _, rest = uri.partition(":")
        return fs.FileSystem.from_uri(f"{scheme}://{rest}" if not rest.startswith("//") else uri)
    return fs.LocalFileSystem(), uri


class Staged:
    """A file that gets its name only when it is whole.

    Each attempt writes under a name of its own, so a repeated or speculative task
    replaces a file by the same bytes and never leaves a torn one.
    """

    def __init__(self, folder: str, name: str):
        self.system, path = store(folder)
        self.system.create_dir(path, recursive=True)
        self.final = f"{path}/{name}"
        self.own = f"{path}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.own)
        self.size = 0

    def write(self, parts: Iterable[bytes]) -> None:
        for part in parts:
            self.stream.write(part)
            self.size += len(part)

    def publish(self) -> None:
        self.stream.close()
        self.system.move(self.own, self.final)


def read_range(folder: str, name: str, begin: int, length: int) -> bytes:
    """Bytes of a published file."""
    system, path = store(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        return file.read_at(length, begin)
