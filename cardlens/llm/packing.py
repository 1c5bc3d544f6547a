"""Integer arrays and bytes as compact binary cells (used inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def pack_bytes(data: bytes, level: int = 1) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec(_CODEC, compression_level=level).compress(data, asbytes=True)


def unpack_bytes(cell: bytes) -> bytes:
    return pa.decompress(cell[8:], int.from_bytes(cell[:8], "little"), codec=_CODEC, asbytes=True)


def pack_ints(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned integers in the fewest bytes each, equal-ranked bytes together; gaps if ``ascending``."""
    values = values.astype(np.uint64)
    if ascending and len(values):
        values = np.concatenate([values[:1], values[1:] - values[:-1]])
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pack_bytes(planes.tobytes())


def unpack_ints(cell: bytes, ascending: bool = False) -> np.ndarray:
    width = cell[0]
    planes = np.frombuffer(unpack_bytes(cell[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    values = out.reshape(-1).view("<u8")
    return np.cumsum(values, dtype=np.uint64) if ascending else values
