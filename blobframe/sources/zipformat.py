"""The parts of the ZIP format a task needs: the central directory, and one member at an offset.

``zipfile`` would hold the whole directory in memory, which a single archive with a third of all
members does not allow; here it is read as a stream.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

# Fixed values of the ZIP format: record signatures, record layouts, and the markers that send a
# reader to the 64-bit fields.
DIRECTORY_END = b"PK\x05\x06"
DIRECTORY_END_64 = b"PK\x06\x06"
DIRECTORY_END_64_LOCATOR = b"PK\x06\x07"
DIRECTORY_ENTRY = b"PK\x01\x02"
LOCAL_HEADER = b"PK\x03\x04"
DIRECTORY_END_SIZE = 22
DIRECTORY_END_64_SIZE = 56
DIRECTORY_END_64_LOCATOR_SIZE = 20
DIRECTORY_ENTRY_SIZE = 46
LOCAL_HEADER_SIZE = 30
MAX_COMMENT = 65535
MARKER_32 = 0xFFFFFFFF
EXTRA_64 = 0x0001
STORED = 0
DEFLATED = 8
ENCRYPTED_FLAG = 0x0001

BLOCK_BYTES = 4 << 20
TAIL_BYTES = MAX_COMMENT + DIRECTORY_END_SIZE + DIRECTORY_END_64_SIZE + DIRECTORY_END_64_LOCATOR_SIZE


class Entry(NamedTuple):
    member: str
    offset: int
    head: int
    packed: int
    size: int
    method: int
    crc: int
    flags: int


class FromTheEnd:
    """A handle whose last bytes are read once; they hold all of a small archive's directory."""

    def __init__(self, handle):
        self.handle = handle
        self.total = handle.size()
        self.begin = max(0, self.total - TAIL_BYTES)
        self.tail = handle.read_at(self.total - self.begin, self.begin)

    def read_at(self, count: int, at: int) -> bytes:
        if at >= self.begin:
            return self.tail[at - self.begin : at - self.begin + count]
        return self.handle.read_at(count, at)


def find_directory(handle: FromTheEnd, archive: str) -> tuple[int, int, int]:
    """``start, length`` of the central directory, and the bytes that precede the first member."""
    at = handle.tail.rfind(DIRECTORY_END)
    if at < 0 or at + DIRECTORY_END_SIZE > len(handle.tail):
        raise ValueError(f"{archive} is not a ZIP archive")
    length, offset = struct.unpack_from("<2L", handle.tail, at + 12)
    end = handle.begin + at
    if end >= DIRECTORY_END_64_LOCATOR_SIZE:
        locator_at = end - DIRECTORY_END_64_LOCATOR_SIZE
        locator = handle.read_at(DIRECTORY_END_64_LOCATOR_SIZE, locator_at)
        if locator[:4] == DIRECTORY_END_64_LOCATOR:
            end = locator_at - DIRECTORY_END_64_SIZE
            record = handle.read_at(DIRECTORY_END_64_SIZE, end)
            if record[:4] != DIRECTORY_END_64:
                raise ValueError(f"{archive} has a damaged 64-bit directory end")
            length, offset = struct.unpack_from("<2Q", record, 40)
    start = end - length
    if start < 0:
        raise ValueError(f"{archive} has a damaged directory")
    return start, length, start - offset


def member_name(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("cp437")


def wide_fields(extra: bytes, fields: list[int]) -> list[int]:
    """``fields`` with every 32-bit marker replaced by its 64-bit value, in the format's order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == EXTRA_64:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide, field) if field == MARKER_32 else field for field in fields]
        at += 4 + length
    return fields


def directory(handle, archive: str) -> Iterator[Entry]:
    """The archive's entries, read from its central directory in blocks of bounded size."""
    handle = FromTheEnd(handle)
    start, length, shift = find_directory(handle, archive)
    stop = start + length
    buffer, at = b"", 0
    while start < stop or at < len(buffer):
        if start < stop:
            block = handle.read_at(min(BLOCK_BYTES, stop - start), start)
            if not block:
                raise ValueError(f"{archive} ends inside its directory")
            start += len(block)
            buffer, at = buffer[at:] + block, 0
        while at + DIRECTORY_ENTRY_SIZE <= len(buffer):
            if buffer[at : at + 4] != DIRECTORY_ENTRY:
                raise ValueError(f"{archive} has a damaged directory")
            flags, method = struct.unpack_from("<2H", buffer, at + 8)
            crc, packed, size, name_len, extra_len, comment_len = struct.unpack_from(
                "<3L3H", buffer, at + 16
            )
            (offset,) = struct.unpack_from("<L", buffer, at + 42)
            name_at = at + DIRECTORY_ENTRY_SIZE
            extra_at = name_at + name_len
            following = extra_at + extra_len + comment_len
            if following > len(buffer):
                break
            if MARKER_32 in (size, packed, offset):
                extra = buffer[extra_at : extra_at + extra_len]
                size, packed, offset = wide_fields(extra, [size, packed, offset])
            yield Entry(
                member_name(buffer[name_at:extra_at]),
                offset + shift,
                LOCAL_HEADER_SIZE + name_len + extra_len,
                packed,
                size,
                method,
                crc,
                flags,
            )
            at = following
        if start >= stop and at < len(buffer):
            raise ValueError(f"{archive} ends inside its directory")


def payload_start(header: bytes, at: int, where: str) -> int:
    """Where a member's packed bytes lie in ``header``, whose local header begins at ``at``."""
    if header[at : at + 4] != LOCAL_HEADER:
        raise ValueError(f"no member begins at {where}; was the archive replaced?")
    name_len, extra_len = struct.unpack_from("<2H", header, at + 26)
    return at + LOCAL_HEADER_SIZE + name_len + extra_len


def unpack(packed: bytes, place: dict, where: str) -> bytes:
    if place["flags"] & ENCRYPTED_FLAG:
        raise ValueError(f"the member at {where} is encrypted")
    if place["method"] == STORED:
        content = packed
    elif place["method"] == DEFLATED:
        content = zlib.decompressobj(-zlib.MAX_WBITS).decompress(packed, place["size"] + 1)
    else:
        raise ValueError(f"the member at {where} uses compression method {place['method']}")
    if len(content) != place["size"] or zlib.crc32(content) != place["crc"]:
        raise ValueError(f"the member at {where} is damaged")
    return content
