"""Byte-aligned variable-length coding of unsigned integers with separate control bytes (used inside tasks).

A value takes one to four little-endian bytes of the data stream. Its length less one is a
two-bit code; four codes make a control byte (the first value in the lowest bits). Control
and data streams stand apart, so the lengths of all values come out of one lookup in a table
of 256 rows and their places out of one running sum.
"""

from __future__ import annotations

import numpy as np

_LENGTHS = np.stack([((np.arange(256) >> 2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)  # control byte -> four lengths
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)  # length -> bits that belong to the value


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned integers below 2^32."""
    values = np.ascontiguousarray(values, "<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros((-(-len(values) // 4), 4), np.uint8)
    quads.reshape(-1)[:len(values)] = codes
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    parts = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), parts[np.arange(4) <= codes[:, None]].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of the two streams; streams of other lengths are an error."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    if len(control) != -(-n // 4) or len(data) != (int(ends[-1]) if n else 0):
        raise ValueError("control and data bytes do not fit the number of values")
    if not n:
        return np.empty(0, np.uint32)
    padded = np.frombuffer(data + bytes(3), np.uint8)
    at_every_byte = np.ndarray((len(data),), "<u4", padded, strides=(1,))
    return at_every_byte[ends - lengths] & _MASKS[lengths]
