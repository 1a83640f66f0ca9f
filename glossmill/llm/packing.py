"""Token ids in files of word-aligned packed integers.

Ids are written in blocks; a block is a run of 64-bit words, each holding a
4-bit selector and as many values as fit in the other 60 bits at the width the
selector names. A value of more than 60 bits escapes: selector 0 says that the
whole next word is the value. Blocks start at recorded word offsets, so the
words of all blocks are packed side by side and unpacked selector by selector
with vector operations, and any document can be read without the rest.

File: header (magic, counts), per-document tables (doc id, first id), per-block
word offsets, words. Little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MAGIC = b"GMS8B\x00\x01\x00"
BLOCK = 1024  # ids of a block
PACKED = 256 * BLOCK  # ids packed at once
#: Values of a word by selector, 1 to 14; 0 is the escape.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([64, *(60 // COUNTS[1:])], np.int64)
_HEADER = struct.Struct("<8s6q")
_U = np.uint64


def _fitting(values: np.ndarray) -> np.ndarray:
    """Selector per position: the most values from there on that fit a word.

    Runs stop at the end of a block.
    """
    n = len(values)
    wide = np.zeros(n, np.int64)  # bits of each value
    rest = values.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >= (_U(1) << _U(shift))
        wide += big * shift
        rest = np.where(big, rest >> _U(shift), rest)
    wide += rest > 0
    room = np.minimum(BLOCK - np.arange(n) % BLOCK, n - np.arange(n))
    out = np.where(wide > 60, 0, 14)
    least = int(wide.min()) if n else 0
    widest, width = wide, 1  # widest value of the `width` from each position on

    def grown(to):
        nonlocal widest, width
        while width < to:
            step = min(width, to - width)
            moved = np.full(n, 99, np.int64)
            moved[: n - step] = widest[step:]
            widest = np.maximum(widest, moved)
            width += step
        return widest

    for selector in range(13, 0, -1):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        if bits < least or count > n:
            break
        out = np.where((grown(count) <= bits) & (room >= count), selector, out)
    return out


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks and the word offset of each block (one more than blocks)."""
    values = np.ascontiguousarray(values, _U)
    n = len(values)
    if not n:
        return np.empty(0, _U), np.zeros(1, np.int64)
    fit = _fitting(values)
    taken = np.maximum(COUNTS[fit], 1)
    # All blocks step from word to word together.
    at = np.arange(0, n, BLOCK)
    end = np.minimum(at + BLOCK, n)
    block = np.arange(len(at))
    starts, owners = [], []
    while len(at):
        starts.append(at)
        owners.append(block)
        at = at + taken[at]
        on = at < end
        at, end, block = at[on], end[on], block[on]
    start, owner = np.concatenate(starts), np.concatenate(owners)
    order = np.argsort(start, kind="stable")
    start, owner = start[order], owner[order]
    chosen = fit[start]
    size = np.where(chosen == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), _U)
    for selector in np.unique(chosen):
        rows = np.flatnonzero(chosen == selector)
        if selector == 0:
            words[place[rows] + 1] = values[start[rows]]
            continue
        packed = np.full(len(rows), selector, _U)
        for k in range(COUNTS[selector]):
            shift = _U(4 + k * int(BITS[selector]))
            packed |= values[start[rows] + k] << shift
        words[place[rows]] = packed
    per_block = np.bincount(owner, size, minlength=-(-n // BLOCK)).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The `n` values of a run of words that starts at a block."""
    words = np.ascontiguousarray(words, _U)
    chosen = (words & _U(15)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # The word after an escape is data whatever its low bits are.
    for i in np.flatnonzero(chosen == 0):
        if not raw[i]:
            raw[i + 1] = True
    count = np.where(chosen == 0, 1, COUNTS[np.minimum(chosen, 14)])
    count[raw] = 0
    place = np.cumsum(count) - count
    out = np.empty(n, _U)
    for selector in np.unique(chosen[~raw]):
        rows = np.flatnonzero((chosen == selector) & ~raw)
        if selector == 0:
            out[place[rows]] = words[rows + 1]
            continue
        bits = int(BITS[selector])
        mask = _U(2**bits - 1)
        for k in range(COUNTS[selector]):
            out[place[rows] + k] = (words[rows] >> _U(4 + k * bits)) & mask
    return out


@dataclass
class TokenFile:
    """What a file holds: `doc_ids` (with a mask of NULLs), `ends` and the words."""

    doc_ids: np.ndarray
    missing: np.ndarray
    first: np.ndarray  # first id of each document, and the end of the last
    offsets: np.ndarray  # first word of each block, and the end of the last
    words: np.ndarray

    @classmethod
    def parse(cls, data: bytes) -> TokenFile:
        magic, docs, ids, blocks, words, size, code = _HEADER.unpack_from(data)
        body = memoryview(data)[_HEADER.size :]
        if magic != MAGIC or len(body) != size or zlib.crc32(body) != code:
            raise ValueError("not a whole token file")
        at, parts = 0, []
        for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs + 1), ("<i8", blocks + 1), ("<u8", words)):
            parts.append(np.frombuffer(body, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(parts[0], parts[1].astype(bool), *parts[2:])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids from `lo` to `hi` of the file; reads only the blocks they lie in."""
        if lo >= hi:
            return np.empty(0, _U)
        first, last = lo // BLOCK, -(-hi // BLOCK)
        words = self.words[self.offsets[first] : self.offsets[last]]
        n = min(last * BLOCK, int(self.first[-1])) - first * BLOCK
        return unpack(words, n)[lo - first * BLOCK : hi - first * BLOCK]

    def documents(self, ids_at_once: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, place of its first id in the file, ids) of each document."""
        n, at = len(self.doc_ids), 0
        while at < n:
            to = at + 1
            while to < n and self.first[to + 1] - self.first[at] <= ids_at_once:
                to += 1
            base = int(self.first[at])
            some = self.ids(base, int(self.first[to]))
            for i in range(at, to):
                lo, hi = int(self.first[i]), int(self.first[i + 1])
                name = None if self.missing[i] else int(self.doc_ids[i])
                yield name, lo, some[lo - base : hi - base]
            at = to


def build(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The bytes of a file of documents in the given order."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    flat = np.concatenate(ids) if ids else np.empty(0, _U)
    # A few hundred blocks at a time: packing needs many times its input.
    some, offsets = [], [np.zeros(1, np.int64)]
    for at in range(0, len(flat), PACKED):
        words, ends = pack(flat[at : at + PACKED])
        some.append(words)
        offsets.append(ends[1:] + offsets[-1][-1])
    words = np.concatenate(some) if some else np.empty(0, _U)
    offsets = np.concatenate(offsets)
    body = b"".join(
        [
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            first.astype("<i8").tobytes(),
            offsets.astype("<i8").tobytes(),
            words.astype("<u8").tobytes(),
        ]
    )
    head = _HEADER.pack(
        MAGIC, len(doc_ids), len(flat), len(offsets) - 1, len(words), len(body), zlib.crc32(body)
    )
    return head + body
