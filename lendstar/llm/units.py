"""Safe places to cut a text before byte-level BPE, and a bounded memo of units.

The pre-split pattern of the rank files never matches across a place where a
non-space character is followed by white space, so a text may be cut there and
each unit (white space, then a word) encoded alone.  A unit that is still long
(a base64 line, a minified script) is cut further where an ASCII letter or
digit is followed by an ASCII character of another class: letter and digit
runs always end there, and a contraction starts, not ends, at such a place.
Units repeat, so the bytes of their ids are kept in a bounded dictionary.

``unit_array`` cuts many texts at once by their bytes: before ASCII white space
at such places, and between a letter or digit and ASCII punctuation.  Its units
are then encoded once for all the texts, however often they stand there.
"""

from __future__ import annotations

import ctypes
import re
import struct
import weakref
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Unicode White_Space, spelled out: Python's \s also holds U+001C to U+001F.
_WS = " \t\n\x0b\x0c\r\x85\xa0" + "".join(map(chr, [
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_CLASS_EDGE = re.compile(r"(?<=[A-Za-z])(?=[!-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~])")
# Punctuation behind a letter or digit, up to the unit's end: a run of its own.
_TAIL = re.compile(r"(?<=[^\W_])[!-/:-@\[-`{-~]+$")

LONG_UNIT = 2048

# For ``unit_array``: classes of bytes, and of characters of two bytes.
_SPACE, _PUNCTUATION, _WORD = 1, 2, 4
_BYTE_CLASS = np.array([_SPACE if c in _WS else _WORD if c.isalnum() else _PUNCTUATION if "!" <= c <= "~" else 0
                        for c in map(chr, range(0x80))] + [0] * 0x80, np.uint8)
_TWO_BYTE_WORD = np.array([chr(i).isalnum() for i in range(0x800)])
_WIDE_WS = [int.from_bytes(c.encode(), "big") for c in _WS if ord(c) > 0x7F]  # of two or three bytes


def split_units(text: str) -> list[str]:
    """Units whose encodings concatenate to the encoding of ``text``."""
    units = _UNIT.findall(text)
    if len(text) <= LONG_UNIT or max(map(len, units)) <= LONG_UNIT:
        return units
    return [p for u in units for p in (_CLASS_EDGE.split(u) if len(u) > LONG_UNIT else (u,)) if p]


def unit_array(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The units of all ``texts`` (none null) in a row, and where those of each
    text start among them (one more: their number)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(at[0]), int(at[-1])
    if lo == hi:
        return texts.slice(0, 0), np.zeros(len(texts) + 1, np.int64)
    b = np.frombuffer(data, np.uint8)[lo:hi]
    kind = _BYTE_CLASS[b]
    before, after = kind[:-1], kind[1:]
    cut = (after == _SPACE) & (before != _SPACE) | (after == _PUNCTUATION) & (before == _WORD)
    # Behind a character of more bytes: the last two and three bytes decide.
    wide = np.flatnonzero((b[:-1] > 0x7F) & (b[1:] < 0x80) & (after != 0))
    last, lead = b[wide].astype(np.int64), b[wide - 1].astype(np.int64)
    two = lead << 8 | last
    three = b[np.maximum(wide - 2, 0)].astype(np.int64) << 16 | two
    word = (lead >= 0xC2) & _TWO_BYTE_WORD[(lead & 0x1F) << 6 | last & 0x3F]
    space = np.isin(two, _WIDE_WS) | np.isin(three, _WIDE_WS)
    cut[wide] = np.where(after[wide] == _SPACE, ~space, (after[wide] == _PUNCTUATION) & word)
    first = at - lo
    starts = first[:-1][first[:-1] < first[1:]]
    cut[starts[starts > 0] - 1] = True
    ends = np.concatenate([[0], np.flatnonzero(cut) + 1, [hi - lo]])
    units = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends + lo), data)
    return units, np.searchsorted(ends, first)


_MEMOS: "weakref.WeakSet[UnitMemo]" = weakref.WeakSet()


def release_memory() -> None:
    """Let go of what a stage kept in a Python worker: before the next one uses the
    worker again, and after its own rows, as the worker stays beside the JVM."""
    for memo in list(_MEMOS):
        memo.clear()
        memo.old.clear()
    trim_memory()


def trim_memory() -> None:
    """Give free memory of the worker back; memos stay."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


class UnitMemo(dict):
    """unit -> bytes of its ids (little-endian unsigned 32 bit), filled on demand.

    Two generations bound the entries: when this one has ``max_units``, it
    becomes the old one, from which units in use come back.  A word with
    punctuation behind it is put together from the two, so that the library
    sees each word once.  Only units of up to ``max_chars`` are kept.
    """

    def __init__(self, encode: Callable[[str], list[int]], max_units: int = 400_000, max_chars: int = 64):
        super().__init__()
        _MEMOS.add(self)
        self.encode_ids, self.max_units, self.max_chars = encode, max_units, max_chars
        self.old: dict[str, bytes] = {}

    __hash__ = object.__hash__

    def __missing__(self, unit: str) -> bytes:
        out = self.old.get(unit)
        if out is None:
            tail = _TAIL.search(unit)
            if tail:
                out = self[unit[:tail.start()]] + self[tail.group()]
            else:
                ids = self.encode_ids(unit)
                out = struct.pack(f"<{len(ids)}I", *ids)
        if len(unit) <= self.max_chars:
            if len(self) >= self.max_units:
                self.old = dict(self)
                self.clear()
            self[unit] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        return b"".join(map(self.__getitem__, split_units(text)))
