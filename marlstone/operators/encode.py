"""Rasters as PNG, in several modes of which the smallest is kept.

Modes: full (8 bits a channel, each row with the filter of the least sum), P16 (a palette of at most 16 colours by
median cut) and 1 (black and white, split at 128). Images are bytes, row after row, one or three to a
pixel. Overviews are reduced by the mean of the area that each pixel covers, never enlarged.

Defined results: images without pixels, without a width, or whose bytes don't fill their last row, have no
encoding; of modes of equal size the first in the order above is kept.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

MODES = ("full", "P16", "1")
#: Images whose encodings are held at once.
SOME = 64


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _png(rows: np.ndarray, width: int, depth: int, colour: int, palette: bytes = b"") -> bytes:
    """rows: filter byte and data of each row."""
    head = struct.pack(">IIBBBBB", width, len(rows), depth, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", head) + (_chunk(b"PLTE", palette) if palette else b"") + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 9)) + _chunk(b"IEND", b"")


def full(a: np.ndarray) -> bytes:
    """a: height, width, channels."""
    h, w, c = a.shape
    x = a.reshape(h, w * c).astype(np.int16)
    left, up = np.zeros_like(x), np.zeros_like(x)
    left[:, c:], up[1:] = x[:, :-c], x[:-1]
    corner = np.zeros_like(x)
    corner[1:, c:] = x[:-1, :-c]
    guess = left + up - corner
    pa_, pb, pc = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
    paeth = np.where((pa_ <= pb) & (pa_ <= pc), left, np.where(pb <= pc, up, corner))
    tried = np.stack([x, x - left, x - up, x - (left + up) // 2, x - paeth]).astype(np.uint8)
    cost = np.minimum(tried, 256 - tried.astype(np.int16)).sum(2, dtype=np.int64)
    best = cost.argmin(0)
    return _png(np.concatenate([best[:, None].astype(np.uint8), tried[best, np.arange(h)]], 1), w, 8, 0 if c == 1 else 2)


def median_cut(colours: np.ndarray, counts: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Palette and the place in it of each colour: boxes are split at the median of their widest channel, the box
    with most pixels times extent first; a box's colour is the mean of its pixels."""
    boxes = [np.arange(len(colours))]
    while len(boxes) < most:
        extent = [int((colours[b].max(0) - colours[b].min(0).astype(int)).max()) * int(counts[b].sum()) for b in boxes]
        k = int(np.argmax(extent))
        if not extent[k]:
            break
        b = boxes[k]
        axis = int((colours[b].max(0) - colours[b].min(0).astype(int)).argmax())
        b = b[np.argsort(colours[b, axis], kind="stable")]
        total = np.cumsum(counts[b])
        at = int(np.searchsorted(total, total[-1] / 2, "left")) + 1
        values = colours[b, axis]
        at = min(max(1, at), len(b) - 1)
        if values[at - 1] == values[at]:  # equal values stay together
            low, high = int(np.searchsorted(values, values[at], "left")), int(np.searchsorted(values, values[at], "right"))
            at = low if low else high
        boxes[k : k + 1] = [b[:at], b[at:]]
    place = np.zeros(len(colours), np.int64)
    palette = np.zeros((len(boxes), colours.shape[1]), np.uint8)
    for i, b in enumerate(boxes):
        place[b] = i
        palette[i] = np.rint((colours[b] * counts[b, None]).sum(0) / counts[b].sum())
    return palette, place


def _packed(index: np.ndarray, bits: int) -> np.ndarray:
    """Rows of small numbers, several to a byte, with filter 0."""
    per = 8 // bits
    wide = np.pad(index, ((0, 0), (0, -index.shape[1] % per))).reshape(len(index), -1, per)
    shift = np.arange(per - 1, -1, -1) * bits
    return np.concatenate([np.zeros((len(index), 1), np.uint8), (wide << shift).sum(2).astype(np.uint8)], 1)


def p16(a: np.ndarray) -> bytes:
    h, w, c = a.shape
    colours, back, counts = np.unique(a.reshape(-1, c), axis=0, return_inverse=True, return_counts=True)
    palette, place = median_cut(colours, counts)
    index = place[back.reshape(h, w)]
    bits = 1 if len(palette) <= 2 else 2 if len(palette) <= 4 else 4
    rgb = palette if c == 3 else np.repeat(palette, 3, 1)
    return _png(_packed(index, bits), w, bits, 3, rgb.tobytes())


def one(a: np.ndarray) -> bytes:
    return _png(_packed((a.mean(2) >= 128).astype(np.int64), 1), a.shape[1], 1, 0)


def reduced(a: np.ndarray, most: int) -> np.ndarray:
    """a with its long side cut down to `most` pixels by area means."""
    h, w, _ = a.shape
    if max(h, w) <= most:
        return a
    ratio = most / max(h, w)
    out = a.astype(np.float64)
    for axis, n in ((0, max(1, round(h * ratio))), (1, max(1, round(w * ratio)))):
        size = out.shape[axis]
        sums = np.concatenate([np.zeros_like(out.take([0], axis)), np.cumsum(out, axis)], axis)
        edge = np.linspace(0, size, n + 1)
        low = np.minimum(edge.astype(int), size - 1)
        part = (edge - low).reshape((-1, 1, 1) if axis == 0 else (1, -1, 1))
        at = sums.take(low, axis) + part * out.take(low, axis)
        out = np.diff(at, axis=axis) * n / size
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


_MAKE = {"full": full, "P16": p16, "1": one}


def encoded(batches, page: str, channels: int, most: int | None, modes: tuple[str, ...]):
    """Rows of encodings(), those of SOME images at a time, however many come in a batch."""
    for b in (whole.slice(at, SOME) for whole in batches for at in range(0, len(whole), SOME)):
        made = []
        for i, (raw, w) in enumerate(zip(b.column("_image"), b.column("_w").to_pylist(), strict=True)):
            a = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, w, channels)
            a = a if most is None else reduced(a, most)
            for k, mode in enumerate(modes):
                png = _MAKE[mode](a)
                made.append((i, mode, k, a.shape[1], a.shape[0], len(png), png))
        cols = list(zip(*made, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        at, *rest = (pa.array(c, t) for c, t in zip(cols, kinds, strict=True))
        yield pa.RecordBatch.from_arrays([b.column(page).take(at), *rest], names=[page, "mode", "place", "w", "h", "bytes", "png"])


def encodings(images: DataFrame, page: str, image: str, width: str, channels: int = 1, most: int | None = None, modes: tuple[str, ...] = MODES) -> DataFrame:
    """page, mode, place (of the mode), w, h, bytes, png for each mode of every image, reduced to `most` pixels on
    the long side, if given."""
    rows = images.select(page, F.col(image).alias("_image"), F.col(width).cast("long").alias("_w")).where((F.col("_w") > 0) & (F.octet_length("_image") > 0) & (F.octet_length("_image") % (F.col("_w") * channels) == 0))

    def run(batches):
        return encoded(batches, page, channels, most, modes)

    fields = [StructField("mode", StringType()), StructField("place", IntegerType()), StructField("w", IntegerType()), StructField("h", IntegerType()), StructField("bytes", LongType()), StructField("png", BinaryType())]
    return rows.mapInArrow(run, StructType([images.schema[page], *fields]))


def smallest(encoded: DataFrame, page: str) -> DataFrame:
    """page, mode, w, h, bytes, png of the smallest encoding of each image; the modes of an image leave one
    task together, so that larger ones don't travel."""
    rest = ("mode", "w", "h", "bytes", "png")
    best = encoded.groupBy(page).agg(F.min_by(F.struct(*rest), F.struct("bytes", "place")).alias("b"))
    return best.select(page, *(F.col("b")[c].alias(c) for c in rest))
