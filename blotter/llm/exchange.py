"""Golomb-coded exchange of sorted 64-bit values between tasks.

A sender sorts its distinct values, cuts them at the owners' range bounds and
sends each owner one Golomb-Rice coded blob of gaps. Remainders are whole
bytes, so both directions are numpy array operations.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = "<QBQQ"  # count, remainder bytes, first value, unary bits


def encode(values: np.ndarray) -> bytes:
    """Code sorted distinct uint64 ``values``."""
    n = len(values)
    if n == 0:
        return struct.pack(HEAD, 0, 0, 0, 0)
    gaps = np.diff(values)
    if n == 1:
        return struct.pack(HEAD, 1, 0, int(values[0]), 0)
    spread = int(values[-1]) - int(values[0])
    # whole-byte remainder with the fewest bits in all: n * (8k + 1) + spread / 2^8k
    k = min(range(8), key=lambda b: (n - 1) * (8 * b + 1) + (spread >> (8 * b)))
    rest = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].tobytes()
    ends = np.cumsum((gaps >> np.uint64(8 * k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    return struct.pack(HEAD, n, k, int(values[0]), len(unary)) + np.packbits(unary).tobytes() + rest


def decode(blob: bytes) -> np.ndarray:
    n, k, first, bits = struct.unpack_from(HEAD, blob)
    if n == 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    out[0] = first
    if n > 1:
        at = struct.calcsize(HEAD)
        packed = np.frombuffer(blob, np.uint8, (bits + 7) // 8, at)
        ends = np.flatnonzero(np.unpackbits(packed, count=bits))
        wide = np.zeros((n - 1, 8), np.uint8)
        wide[:, :k] = np.frombuffer(blob, np.uint8, (n - 1) * k, at + len(packed)).reshape(n - 1, k)
        gaps = wide.view("<u8").ravel().astype(np.uint64)
        gaps += (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(8 * k)
        out[1:] = gaps
        np.cumsum(out, out=out)
    return out


def owner_cuts(values: np.ndarray, owners: int) -> np.ndarray:
    """Positions in sorted ``values`` at which each owner's equal hash range begins, and the end."""
    bounds = np.array([(i << 64) // owners for i in range(1, owners)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, bounds), [len(values)]])


def pack_mask(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unpack_mask(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)
