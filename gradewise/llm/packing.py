"""Arrays of numbers and lists of byte strings as compressed bytes, for rows that a shuffle carries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(*parts: np.ndarray | bytes) -> tuple[int, bytes]:
    """(size, compressed bytes) of the parts, one behind the other."""
    raw = b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpacked(size: int, data: bytes) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def joined(words: list[bytes]) -> bytes:
    """The words' sizes and bytes."""
    return np.fromiter(map(len, words), np.uint32, len(words)).tobytes() + b"".join(words)


def parted(raw: bytes, n: int) -> list[bytes]:
    """The n words of `joined`."""
    ends = (4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n).astype(np.int64))).tolist()
    return [raw[a:b] for a, b in zip([4 * n, *ends], ends)]


def planes(numbers: np.ndarray) -> list[np.ndarray]:
    """The low and the high bytes of numbers below 65,536, which shrink better apart."""
    return [(numbers & 255).astype(np.uint8), (numbers >> 8).astype(np.uint8)]
