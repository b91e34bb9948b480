"""Arrays of numbers as bytes that take little room in a shuffle."""

from __future__ import annotations

import numpy as np


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers, all low bytes first: most are small, so the last planes compress away."""
    return x.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(4, -1).T).view("<u4").ravel()


def narrow(sorted_: np.ndarray) -> bytes:
    """Ascending 64-bit numbers: the width of the differences, and these."""
    steps = np.diff(sorted_, prepend=np.uint64(0)).astype("<u8")
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    return bytes([width]) + np.ascontiguousarray(steps.view("u1").reshape(-1, 8)[:, :width]).tobytes()


def wide(data: bytes) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 8), "u1")
    out[:, :width] = np.frombuffer(data, "u1", -1, 1).reshape(-1, width)
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def short(x: np.ndarray) -> bytes:
    """Counts, most of them small: their number, a byte each, and those of 255 and above in full."""
    return np.uint32(len(x)).tobytes() + np.minimum(x, 255).astype("u1").tobytes() + x[x >= 255].astype("<u8").tobytes()


def full(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    out = np.frombuffer(data, "u1", n, 4).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", -1, 4 + n) if len(data) > 4 + n else 0
    return out
