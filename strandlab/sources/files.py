"""Files of any store that Arrow reaches, and streams that are kept as pieces of one."""

from __future__ import annotations

import struct
from bisect import bisect_right

from pyarrow import fs

PIECE_BYTES = 64 << 20
#: Ends the name of a folder that holds the pieces of one file, each named by the place where it begins.
PIECES = ".pieces"


class FormatError(ValueError):
    """The file is damaged or not of the format."""


def at_path(path: str):
    """(file system, path within it)."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def piece_starts(path: str) -> list[int]:
    system, inner = at_path(path)
    return sorted(int(f.base_name) for f in system.get_file_info(fs.FileSelector(inner)))


class Pieces:
    """The pieces of a folder as one file."""

    def __init__(self, path: str):
        self.system, self.folder = at_path(path)
        found = sorted((int(f.base_name), f.size) for f in self.system.get_file_info(fs.FileSelector(self.folder)))
        self.starts, self.length, self.at = [a for a, _ in found], sum(n for _, n in found), 0
        self.open: tuple | None = None

    def size(self) -> int:
        return self.length

    def seek(self, at: int) -> None:
        self.at = at

    def tell(self) -> int:
        return self.at

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and self.at < self.length:
            k = bisect_right(self.starts, self.at) - 1
            if self.open is None or self.open[0] != k:
                self.open = k, self.system.open_input_file(f"{self.folder}/{self.starts[k]:020d}")
            self.open[1].seek(self.at - self.starts[k])
            out.append(self.open[1].read(n))
            self.at, n = self.at + len(out[-1]), n - len(out[-1])
        return b"".join(out)


def open_file(path: str):
    """A file, or the folder of a stream's pieces, to read and seek in."""
    if path.endswith(PIECES):
        return Pieces(path)
    system, inner = at_path(path)
    return system.open_input_file(inner)


def block_size(head: bytes) -> int:
    """Size of a compressed block from its first bytes, at least those of its extra field."""
    if len(head) < 12 or head[:2] != b"\x1f\x8b" or not head[3] & 4:
        raise FormatError("not a block-compressed file")
    past = 12 + struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(past, len(head)):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    raise FormatError("block without size")


def spool(stream, folder: str, piece_bytes: int = PIECE_BYTES) -> str:
    """Keep a block-compressed stream below ``folder`` in pieces of whole blocks while it is read; returns the name to read it by.

    One block is in memory at a time, and every piece can be read as soon as it is closed."""
    path = f"{folder}{PIECES}"
    system, inner = at_path(path)
    system.create_dir(inner, recursive=True)
    at, begin, out = 0, 0, None
    try:
        while len(head := stream.read(12)) == 12:
            extra = stream.read(struct.unpack_from("<H", head, 10)[0])
            block = head + extra
            rest = block_size(block) - len(block)
            block += stream.read(rest)
            if out is None or at - begin >= piece_bytes:
                if out is not None:
                    out.close()
                begin, out = at, system.open_output_stream(f"{inner}/{at:020d}", compression=None)
            out.write(block)
            at += len(block)
            if len(block) < 12 + len(extra) + rest:
                raise FormatError("file ends within a block")
    finally:
        if out is not None:
            out.close()
    if not at:
        raise FormatError("no blocks in the stream")
    return path


def drop_pieces(path: str) -> None:
    system, inner = at_path(path)
    if path.endswith(PIECES) and system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)
