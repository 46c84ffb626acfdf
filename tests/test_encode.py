"""PNG rows decoded again, palettes, overviews, and the query against a plain version."""

import struct
import zlib

import numpy as np
import pytest

from marlstone.operators import encode
from marlstone.plans import rasters


def decode(png):
    """Height, width, channels as the format says, and whether all checks hold."""
    assert png[:8] == b"\x89PNG\r\n\x1a\n"
    at, parts = 8, {}
    while at < len(png):
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        body = png[at + 8 : at + 8 + n]
        assert struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        parts[kind] = body
        at += 12 + n
    w, h, depth, colour = struct.unpack(">IIBB", parts[b"IHDR"][:10])
    c = 3 if colour == 2 else 1
    raw, step, bpp = zlib.decompress(parts[b"IDAT"]), (w * c * depth + 7) // 8 + 1, max(1, c * depth // 8)
    out, above = [], [0] * (step - 1)
    for y in range(h):
        f, line = raw[y * step], list(raw[y * step + 1 : (y + 1) * step])
        for i in range(len(line)):
            a, b, q = line[i - bpp] if i >= bpp else 0, above[i], above[i - bpp] if i >= bpp else 0
            p = a + b - q
            near = min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - q), 2, q)))[2]
            line[i] = (line[i] + (0, a, b, (a + b) // 2, near)[f]) % 256
        above = line
        out.append([line[k * depth // 8] >> (8 - depth - k * depth % 8) & ((1 << depth) - 1) for k in range(w * c)] if depth < 8 else line)
    a = np.array(out).reshape(h, w, c)
    if colour == 3:
        return np.frombuffer(parts[b"PLTE"], np.uint8).reshape(-1, 3)[a[:, :, 0]]
    return a * 255 if depth == 1 else a


IMAGES = [np.random.default_rng(n).integers(0, 256, shape).astype(np.uint8) for n, shape in enumerate([(1, 1, 1), (7, 13, 1), (40, 9, 3), (1, 30, 3), (33, 1, 1)])]
IMAGES += [np.add.outer(np.arange(50), np.arange(60))[:, :, None].astype(np.uint8), np.zeros((20, 20, 1), np.uint8), np.kron(np.eye(5), np.full((6, 6), 255)).astype(np.uint8)[:, :, None]]


@pytest.mark.parametrize("a", IMAGES, ids=lambda a: str(a.shape))
def test_decodes(a):
    assert (decode(encode.full(a)) == a).all()
    assert (decode(encode.one(a))[:, :, 0] == np.where(a.mean(2) >= 128, 255, 0)).all()
    got = decode(encode.p16(a))
    flat = got.reshape(-1, 3)
    assert len(np.unique(flat, axis=0)) <= 16
    if len(np.unique(a.reshape(-1, a.shape[2]), axis=0)) <= 16:
        assert (got == a).all()
    assert np.abs(got.astype(int) - a).mean() < (60 if a.shape[2] == 3 else 9)


def test_median_cut_uses_all_places():
    grey = np.arange(256, dtype=np.uint8)[:, None]
    palette, place = encode.median_cut(grey, np.ones(256, int))
    assert len(palette) == 16 and np.bincount(place).tolist() == [16] * 16
    palette, place = encode.median_cut(grey[[0, 1, 200]], np.array([1000, 1, 1]), 2)
    assert place.tolist() in ([0, 1, 1], [0, 0, 1])


def test_reduced():
    a = np.kron(np.arange(12).reshape(3, 4) * 20, np.ones((4, 4))).astype(np.uint8)[:, :, None]
    assert (encode.reduced(a, 4)[:, :, 0] == np.arange(12).reshape(3, 4) * 20).all()
    assert encode.reduced(a, 100) is a
    b = np.random.default_rng(1).integers(0, 256, (37, 91, 3)).astype(np.uint8)
    small = encode.reduced(b, 40)
    assert small.shape == (16, 40, 3) and abs(small.mean() - b.mean()) < 1


def test_smallest(spark):
    rows = [(i, a.tobytes(), a.shape[1], "x") for i, a in enumerate(IMAGES) if a.shape[2] == 1] + [(90, None, 4, "x"), (91, b"", 4, "x"), (92, b"abc", 2, "x"), (93, b"abc", None, "x")]
    df = spark.createDataFrame(rows, "page long, image binary, width int, mode string")
    every = encode.encodings(df, "page", "image", "width").collect()
    assert {r.page for r in every} == {i for i, a in enumerate(IMAGES) if a.shape[2] == 1} and all(r.bytes == len(r.png) for r in every)
    best = {r.page: r for r in encode.smallest(encode.encodings(df, "page", "image", "width"), "page").collect()}
    for i in best:
        assert (best[i].bytes, best[i].mode) == min((r.bytes, r.place, r.mode) for r in every if r.page == i)[::2]
        assert decode(bytes(best[i].png)).shape[:2] == IMAGES[i].shape[:2]


def test_query(spark, sf_dir):
    got = {r.page_id: r for r in rasters.smallest_page_png(spark, sf_dir).collect()}
    pages = {r.page_id: r.html.encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert set(got) == {i for i, x in pages.items() if len(x) >= 64}
    for i, r in got.items():
        h = len(pages[i]) // 64
        a = encode.reduced(np.frombuffer(pages[i], np.uint8)[: 64 * h].reshape(h, 64, 1), 128)
        made = [(len(f(a)), k, zlib.crc32(f(a))) for k, f in enumerate((encode.full, encode.p16, encode.one))]
        size, k, crc = min(made)
        assert (r.mode, r.w, r.h, r.bytes, r.png_crc32) == (encode.MODES[k], a.shape[1], a.shape[0], size, crc)


def test_few_encodings_are_held_at_once():
    """However many images Arrow brings in a batch."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(1000)), "_image": pa.array([bytes(range(64))] * 1000, pa.binary()), "_w": pa.array([8] * 1000)})
    got = [len(b) for b in encode.encoded([batch], "id", 1, None, encode.MODES)]
    assert sum(got) == 3000 and max(got) <= 3 * encode.SOME
