"""ZIP directories, read by ranges: central directory, ZIP64 records and the
places of stored members. Nothing is extracted."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

# Signatures and sizes of the ZIP format.
_END, _END64, _LOCATOR, _CENTRAL, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_END_SIZE, _LOCATOR_SIZE, _END64_SIZE, _CENTRAL_SIZE, _LOCAL_SIZE = 22, 20, 56, 46, 30
_COMMENT = 65535
_ZIP64_EXTRA = 1
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF

ReadAt = Callable[[int, int], bytes]  # (offset, length)


@dataclass(frozen=True)
class Member:
    """One entry of the central directory."""

    name: str
    method: int
    packed: int
    size: int
    header_at: int

    @property
    def stored(self) -> bool:
        return self.method == 0 and self.packed == self.size


def _directory(read: ReadAt, size: int) -> tuple[int, int, int]:
    """(entries, bytes, offset) of the central directory."""
    tail_at = max(0, size - _END_SIZE - _COMMENT)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0:  # a comment may hold the signature: its length must reach the end
        if at + _END_SIZE <= len(tail) and at + _END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if _FULL16 == entries or _FULL32 in (length, offset):
        locator_at = tail_at + at - _LOCATOR_SIZE
        locator = read(locator_at, _LOCATOR_SIZE) if locator_at >= 0 else b""
        if locator[:4] == _LOCATOR:
            record = read(struct.unpack_from("<Q", locator, 8)[0], _END64_SIZE)
            if record[:4] != _END64:
                raise ValueError("the ZIP64 locator points nowhere")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
    return entries, length, offset


def members(read: ReadAt, size: int) -> list[Member]:
    """All entries of a ZIP file of ``size`` bytes."""
    entries, length, offset = _directory(read, size)
    raw = read(offset, length)
    out, at = [], 0
    for _ in range(entries):
        if raw[at: at + 4] != _CENTRAL:
            raise ValueError("a broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header_at = struct.unpack_from("<I", raw, at + 42)[0]
        name_at = at + _CENTRAL_SIZE
        extra = raw[name_at + n_name: name_at + n_name + n_extra]
        wide = _zip64(extra, [full == _FULL32, packed == _FULL32, header_at == _FULL32])
        full, packed, header_at = (w if w is not None else v for w, v in zip(wide, (full, packed, header_at), strict=True))
        name = raw[name_at: name_at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        out.append(Member(name, method, packed, full, header_at))
        at = name_at + n_name + n_extra + n_comment
    return out


def _zip64(extra: bytes, wanted: list[bool]) -> list[int | None]:
    """The 64-bit values that stand for full 32-bit fields, in their order."""
    out: list[int | None] = [None] * len(wanted)
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_EXTRA:
            value_at = at + 4
            for i, want in enumerate(wanted):
                if want and value_at + 8 <= at + 4 + n:
                    out[i] = struct.unpack_from("<Q", extra, value_at)[0]
                    value_at += 8
        at += 4 + n
    return out


def data_at(read: ReadAt, member: Member) -> int:
    """Offset of a stored member's bytes. The local header has lengths of its
    own for name and extra field, so it is read."""
    if not member.stored:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    head = read(member.header_at, _LOCAL_SIZE)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header_at + _LOCAL_SIZE + n_name + n_extra
