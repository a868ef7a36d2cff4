"""Images as pixel tables: PNG files and NumPy arrays by Spark's binary file source, decoded in tasks.

A file is one row and is decoded by one task, a band of lines at a time, so the pixels of a large image never stand in memory as rows at once. Rows: path, x, y, channel (0, 1, ...) and value.
PNG: 8 and 16 bits a channel, grey or colour, with or without alpha, not interlaced. NumPy: (height, width) or (channels, height, width), whole numbers or floats, in C order.
"""

from __future__ import annotations

import ast
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Fixed values of the format: first bytes, and channels by colour type.
PNG, CHANNELS = b"\x89PNG\r\n\x1a\n", {0: 1, 2: 3, 4: 2, 6: 4}
#: Pixel values in a band.
BAND = 1 << 20


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line of bytes from what its filter left of it; ``step`` bytes make a pixel."""
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        # each byte adds the one a pixel before
        return np.cumsum(line.reshape(-1, step), 0, dtype=np.uint8).ravel()
    out, up = line.tolist(), above.tolist()
    if kind == 3:
        for i in range(len(out)):
            out[i] = (out[i] + ((out[i - step] if i >= step else 0) + up[i]) // 2) & 255
    elif kind == 4:
        for i in range(len(out)):
            a, b, c = (out[i - step], up[i], up[i - step]) if i >= step else (0, up[i], 0)
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))
            out[i] = (out[i] + near[2]) & 255
    else:
        raise ValueError(f"line filter {kind}")
    return np.array(out, np.uint8)


def png_bands(data: bytes, band: int = BAND) -> Iterator[tuple[int, np.ndarray]]:
    """(first line, values as lines x width x channels) of a PNG file, in bands."""
    if not data.startswith(PNG):
        raise ValueError("no PNG file")
    at, packed, head = len(PNG), [], None
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        at += size + 12
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"IDAT":
            packed.append(body)
        elif name == b"IEND":
            break
    if head is None or head[2] not in (8, 16) or head[3] not in CHANNELS or head[6]:
        raise ValueError(f"PNG header {head} is not supported")
    width, height, bits, colour = head[:4]
    step = CHANNELS[colour] * bits // 8
    wide, unpack, rest = width * step, zlib.decompressobj(), b""
    above, lines, first, done = np.zeros(wide, np.uint8), [], 0, 0
    for piece in [*packed, None]:
        rest += unpack.flush() if piece is None else unpack.decompress(piece)
        start = 0
        while len(rest) - start > wide and done < height:
            above = _unfiltered(rest[start], np.frombuffer(rest, np.uint8, wide, start + 1), above, step)
            lines.append(above)
            start, done = start + wide + 1, done + 1
            if len(lines) * width * CHANNELS[colour] >= band or done == height:
                values = np.stack(lines)
                yield first, (values.view(">u2") if bits == 16 else values).reshape(len(lines), width, CHANNELS[colour])
                first, lines = done, []
        rest = rest[start:]
    if done < height:
        raise ValueError(f"{done} of {height} lines are there")


def npy_bands(data: bytes, band: int = BAND) -> Iterator[tuple[int, np.ndarray]]:
    """The same of a NumPy file; channels come first there."""
    if data[:6] != b"\x93NUMPY":
        raise ValueError("no NumPy file")
    wide = 2 if data[6] == 1 else 4
    size = int.from_bytes(data[8 : 8 + wide], "little")
    head = ast.literal_eval(data[8 + wide : 8 + wide + size].decode("latin1"))
    shape = head["shape"]
    if head["fortran_order"] or len(shape) not in (2, 3) or np.dtype(head["descr"]).kind not in "uif":
        raise ValueError(f"NumPy header {head} is not supported")
    a = np.frombuffer(data, head["descr"], int(np.prod(shape)), 8 + wide + size).reshape((1, *shape) if len(shape) == 2 else shape)
    many = max(1, band // max(1, a.shape[0] * a.shape[2]))
    for y in range(0, a.shape[1], many):
        yield y, np.moveaxis(a[:, y : y + many], 0, 2)


def pixels(spark: SparkSession, path: str) -> DataFrame:
    """(path, x, y, channel, value) of the images at ``path`` (a file, a folder or a pattern), ``.npy`` files by name and others as PNG. A file that cannot be read is an error that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    for first, v in (npy_bands if name.endswith(".npy") else png_bands)(data.as_py()):
                        y, x, c = np.indices(v.shape, np.int64).reshape(3, -1)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(x), pa.string()), pa.array(x), pa.array(y + first), pa.array(c.astype(np.int32)), pa.array(v.astype(np.float64).ravel())], names=["path", "x", "y", "channel", "value"])
                except (ValueError, KeyError, struct.error, zlib.error) as e:
                    raise ValueError(f"{name}: {e}") from e

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, x long, y long, channel int, value double")
