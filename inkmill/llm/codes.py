"""Directly addressable codes of token ids.

An id is cut into chunks of 8 bits, lowest first, as many as it needs. Level 0 holds the first chunk of every id, level 1
the second chunk of those that have one, and so on; each level but the last has a bitmap, one bit a chunk, that is set where the
id goes on, and a directory with the number of set bits before every block of 512. To read id i, take chunk i of
level 0; if its bit is set, the number of set bits before it (directory plus at most 512 bits) is its place on
the next level. Any token is read so in a few steps, without decoding what lies around it.

Layout of a segment (little-endian): magic ``DAC1``, u32 levels, u64 ids; then for each level u64 chunks, the chunks,
and, but for the last level, the bitmap in whole 64-byte blocks (bit 0 first) and a u64 directory entry for each block.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
BLOCK = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """The segment of ids (unsigned, up to 64 bits)."""
    rest = np.ascontiguousarray(ids, np.uint64)
    parts = []
    while True:
        chunks = (rest & np.uint64(255)).astype(np.uint8)
        rest = rest >> np.uint64(8)
        more = rest != 0
        last = not more.any()
        parts.append(struct.pack("<Q", len(chunks)) + chunks.tobytes())
        if last:
            break
        blocks = -(-len(chunks) // BLOCK)
        bits = np.zeros(blocks * BLOCK // 8, np.uint8)
        packed = np.packbits(more, bitorder="little")
        bits[: len(packed)] = packed
        per_block = _ONES[bits].reshape(blocks, -1).sum(axis=1, dtype=np.uint64)
        parts.append(bits.tobytes() + (np.cumsum(per_block) - per_block).astype("<u8").tobytes())
        rest = rest[more]
    return MAGIC + struct.pack("<IQ", len(parts) // 2 + 1, len(ids)) + b"".join(parts)


class Segment:
    """Read access to a segment; nothing is decoded until it is asked for."""

    def __init__(self, data):
        self.data = memoryview(data)
        if bytes(self.data[:4]) != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n_levels, self.n = struct.unpack_from("<IQ", self.data, 4)
        self.levels, at = [], 16
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", self.data, at)
            chunks = np.frombuffer(self.data, np.uint8, n, at + 8)
            at += 8 + n
            bits = ranks = None
            if k < n_levels - 1:
                blocks = -(-n // BLOCK)
                bits = np.frombuffer(self.data, np.uint8, blocks * BLOCK // 8, at)
                at += len(bits)
                ranks = np.frombuffer(self.data, "<u8", blocks, at)
                at += 8 * blocks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * (BLOCK // 8)
            before = int(_ONES[bits[first : i >> 3]].sum()) + int(_ONES[bits[i >> 3] & ((1 << (i & 7)) - 1)])
            i = int(ranks[i // BLOCK]) + before
        return value

    def ids(self) -> np.ndarray:
        """All ids, as u64."""
        out, at = np.zeros(self.n, np.uint64), np.arange(self.n)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint64) << np.uint64(8 * k)
            if bits is not None:
                at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out
