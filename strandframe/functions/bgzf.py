"""BGZF files: blocks from any byte, streams from virtual offsets, and lines of plain or packed text by split."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

#: Fixed values of the format: how a block begins, and the most bytes it has.
MAGIC = b"\x1f\x8b\x08\x04"
MOST = 1 << 16


def block_size(head: bytes) -> int:
    """The size of the block that begins here; 0 if none does."""
    if len(head) < 18 or head[:4] != MAGIC:
        return 0
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    at = 0
    while at + 4 <= len(extra):
        n = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and n == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + n
    return 0


def inflated(block: bytes) -> bytes:
    """The bytes of a whole block, checked."""
    data = zlib.decompress(block[12 + struct.unpack_from("<H", block, 10)[0] : -8], -15)
    if (zlib.crc32(data), len(data)) != struct.unpack_from("<II", block, len(block) - 8):
        raise ValueError("damaged BGZF block")
    return data


def is_bgzf(file) -> bool:
    file.seek(0)
    return block_size(file.read(64)) > 0


def first_block(file, offset: int) -> int | None:
    """The address of the first block at or after a byte; None if there is none."""
    file.seek(offset)
    data = file.read(2 * MOST + 64)
    at = data.find(MAGIC)
    while at >= 0:
        n = block_size(data[at : at + 64])
        if n and at + n <= len(data):
            try:
                inflated(data[at : at + n])
                return offset + at
            except (ValueError, zlib.error):
                pass
        at = data.find(MAGIC, at + 1)
    return None


class Blocks:
    """A BGZF file read from a virtual offset, block by block."""

    def __init__(self, file, offset: int):
        self.file, self.next = file, offset >> 16
        self.data, self.at, self.here = b"", 0, self.next
        if self.load():
            self.at = offset & 0xFFFF

    def load(self) -> bool:
        """The next block that isn't empty."""
        while True:
            self.file.seek(self.next)
            head = self.file.read(MOST)
            n = block_size(head[:64])
            if not n:
                if head:
                    raise ValueError("not a BGZF block")
                self.data, self.at, self.here = b"", 0, self.next
                return False
            if n > len(head):
                raise EOFError("BGZF file cut short")
            self.here, self.next = self.next, self.next + n
            self.data, self.at = inflated(head[:n]), 0
            if self.data:
                return True

    def tell(self) -> int:
        """The virtual offset of the next byte, in a block that has it."""
        if self.at >= len(self.data) and not self.load():
            return self.next << 16
        return self.here << 16 | self.at

    def read(self, n: int) -> bytes:
        if self.at + n <= len(self.data):
            self.at += n
            return self.data[self.at - n : self.at]
        out = []
        while n and (self.at < len(self.data) or self.load()):
            part = self.data[self.at : self.at + n]
            self.at += len(part)
            n -= len(part)
            out.append(part)
        return b"".join(out)

    def line(self) -> bytes | None:
        parts = []
        while self.at < len(self.data) or self.load():
            stop = self.data.find(b"\n", self.at)
            parts.append(self.data[self.at : stop if stop >= 0 else None])
            self.at = stop + 1 if stop >= 0 else len(self.data)
            if stop >= 0:
                return b"".join(parts)
        return b"".join(parts) if parts else None

    def lines(self) -> Iterator[tuple[int, bytes]]:
        """(virtual offset, line) to the end of the file."""
        while True:
            at = self.tell()
            line = self.line()
            if line is None:
                return
            yield at, line.rstrip(b"\r")


def plain_lines(file, start: int, end: int | None) -> tuple[Iterator[tuple[int, bytes]], Callable[[int], bool]]:
    """(offset, line) from the first line that starts at `start` or later, and whether a line's offset is in the split."""

    def each() -> Iterator[tuple[int, bytes]]:
        at = start
        if at:
            file.seek(at - 1)
            at += len(file.readline()) - 1
        else:
            file.seek(0)
        for line in file:
            yield at, line.rstrip(b"\r\n")
            at += len(line)

    return each(), lambda at: end is None or at < end


def packed_lines(file, start: int, end: int | None) -> tuple[Iterator[tuple[int, bytes]], Callable[[int], bool]]:
    """As plain_lines(), of a BGZF file cut at bytes. Whether a block begins with a line isn't known, so a line that begins
    the first block of a split counts to the split before."""
    edge = first_block(file, end) if end is not None else None
    last = Blocks(file, edge << 16).tell() if edge is not None else None
    begin = first_block(file, start) if start else 0

    def each() -> Iterator[tuple[int, bytes]]:
        if begin is None:
            return
        blocks = Blocks(file, begin << 16)
        if start:
            if last is not None and blocks.tell() >= last:
                return
            blocks.line()
        yield from blocks.lines()

    return each(), lambda at: last is None or at <= last
