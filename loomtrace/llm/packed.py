"""Packed columns: numpy arrays and lists of bytes in one compressed binary value.

Shuffling one row per word or window costs more in row headers than in content, so the
operators that count or encode words move them a block at a time.
"""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any integer type, byte plane by byte plane, compressed."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4))
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    to = zstandard.ZstdCompressor(level=3).compressobj(size=sum(map(len, parts)))  # without a copy of all of them
    return b"".join([*map(to.compress, parts), to.flush()])


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, kind = int.from_bytes(raw[at : at + 8], "little"), np.dtype(raw[at + 8 : at + 12].decode().strip())
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def pack_strings(items: list[bytes]) -> bytes:
    return pack(np.fromiter(map(len, items), np.uint32, len(items)), np.frombuffer(b"".join(items), np.uint8))


def unpack_strings(data: bytes) -> list[bytes]:
    lens, flat = unpack(data)
    ends, flat = np.cumsum(lens, dtype=np.int64).tolist(), flat.tobytes()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def gather(starts: np.ndarray, lens: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Indices of the elements of segments ``picks``, one segment after another."""
    n = lens[picks]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(lens.sum())) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((starts[picks] - (ends - n)).astype(kind), n)
