"""Elias-Fano code of a non-decreasing sequence, with select by block counts.

A value is split at `width` bits: the low parts are packed one after the other, the high parts are a bit
vector in which value i sets bit (high + i). Select needs the number of ones before each block of 512 bits
only, kept in 32 bits, so a sequence of n values below u takes about n * (2 + log2(u / n)) bits.
"""

import struct

import numpy as np

BLOCK_BITS = 512
_HEAD = struct.Struct("<4sBxxxQQQ")  # magic, low width, number of values, base value, bits of the high part
_MAGIC = b"EFS1"


class EliasFano:
    def __init__(self, width, count, base, low, high, bits):
        self.width, self.count, self.base, self.low, self.high, self.bits = width, count, base, low, high, bits
        ones = np.bitwise_count(high.reshape(-1, BLOCK_BITS // 8)).sum(axis=1, dtype=np.int64)
        self.before = np.r_[0, np.cumsum(ones)].astype(np.uint32)

    @classmethod
    def encode(cls, values):
        """values: non-decreasing integers; the first is the base the rest are counted from."""
        v = np.asarray(values, np.int64)
        base = int(v[0]) if len(v) else 0
        v = (v - base).astype(np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits((v[:, None] >> np.arange(width, dtype=np.uint64)) .astype(np.uint8) & 1) if width else np.zeros(0, np.uint8)
        at = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = int(at[-1]) + 1 if n else 0
        flags = np.zeros(-(-max(bits, 1) // BLOCK_BITS) * BLOCK_BITS, np.uint8)
        flags[at] = 1
        return cls(width, n, base, low, np.packbits(flags), bits)

    def select(self, index) -> np.ndarray:
        """Values at the given positions."""
        i = np.asarray(index, np.int64)
        block = np.searchsorted(self.before, i, side="right") - 1
        out = np.empty(len(i), np.int64)
        lanes = self.high.reshape(-1, BLOCK_BITS // 8)
        for at in range(0, len(i), 4096):  # bounded unpacking
            part = slice(at, at + 4096)
            blocks, inverse = np.unique(block[part], return_inverse=True)
            ones = np.flatnonzero(np.unpackbits(lanes[blocks], axis=1).reshape(-1))
            first = np.searchsorted(ones // BLOCK_BITS, np.arange(len(blocks)))
            bit = ones[first[inverse] + (i[part] - self.before[block[part]])]
            out[part] = (blocks[bit // BLOCK_BITS] * BLOCK_BITS + bit % BLOCK_BITS - i[part]) << self.width
        if self.width:
            where = i[:, None] * self.width + np.arange(self.width)
            bits = (self.low[where >> 3] >> (7 - (where & 7)).astype(np.uint8)) & 1
            out += (bits.astype(np.int64) << np.arange(self.width)).sum(axis=1)
        return out + self.base

    def to_bytes(self) -> bytes:
        return _HEAD.pack(_MAGIC, self.width, self.count, self.base & (2**64 - 1), self.bits) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data):
        """(the sequence, what follows it in `data`)."""
        magic, width, count, base, bits = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        n_low = -(-count * width // 8)
        n_high = -(-max(bits, 1) // BLOCK_BITS) * BLOCK_BITS // 8
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        return cls(width, count, base - (1 << 64) if base >> 63 else base, low, high, bits), data[at + n_low + n_high :]
