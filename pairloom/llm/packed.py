"""Numbers in a binary column, packed for a shuffle or a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, so that bytes that hardly change cost nothing."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpack(blob: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], size, asbytes=True), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, size // width).T).view(kind).ravel()
