"""Packed columns: many small rows travel a shuffle as few compressed blobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _least(a: np.ndarray) -> np.ndarray:
    """The same whole numbers (none negative) in the narrowest type."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def pack(*columns: np.ndarray) -> bytes:
    """Whole-number columns, each narrowed, in planes of bytes, compressed together: five bytes a column and one frame."""
    head, planes = [np.uint8(len(columns)).tobytes()], []
    for c in columns:
        c = _least(c.view(np.uint64) if c.dtype == np.int64 else c)
        head.append(np.uint32(len(c)).tobytes() + np.uint8(c.dtype.itemsize).tobytes())
        if len(c):
            planes.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes())
    body = b"".join(planes)
    return b"".join(head) + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def unpack(blob: bytes) -> list[np.ndarray]:
    """The columns of pack(), as uint64."""
    n_columns = blob[0]
    shapes = [(int.from_bytes(blob[1 + 5 * i : 5 + 5 * i], "little"), blob[5 + 5 * i]) for i in range(n_columns)]
    size = sum(n * width for n, width in shapes)
    raw = np.frombuffer(pa.decompress(memoryview(blob)[1 + 5 * n_columns :], decompressed_size=size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    out, at = [], 0
    for n, width in shapes:
        planes = raw[at : at + n * width].reshape(width, n).T
        out.append(np.ascontiguousarray(planes).view(f"u{width}").ravel().astype(np.uint64) if n else np.zeros(0, np.uint64))
        at += n * width
    return out


def delta(a: np.ndarray) -> np.ndarray:
    """Steps of a sorted array."""
    return np.diff(a, prepend=a.dtype.type(0))


def undelta(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=np.uint64)


def slot(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of the 64-bit space a hash is in: rises with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def ranges(spark, rows: int, each: int = 1_400_000, parallel: int = 64) -> int:
    """How many ranges of hashes: about `each` rows in one, which bounds a task's memory, and enough to keep tasks busy."""
    return max(min(parallel, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-rows // each))
