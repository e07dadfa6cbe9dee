"""Images of all readable kinds as rows: PNG filters, JPEG and TIFF by the JVM, files without bytes."""

import struct
import time
import zlib

import numpy as np
import pytest

from plumbline.functions import codec
from plumbline.sources import images


def filtered_png(image, kinds):
    """The image with the given filter in each row, by the specification's formulas."""
    h, w, c = image.shape
    rows = image.reshape(h, w * c).astype(int)
    out = bytearray()
    for y in range(h):
        out.append(kinds[y])
        for x in range(w * c):
            a, b, d = rows[y, x - c] if x >= c else 0, rows[y - 1, x] if y else 0, rows[y - 1, x - c] if y and x >= c else 0
            p = a + b - d
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
            out.append((rows[y, x] - (0, a, b, (a + b) // 2, paeth)[kinds[y]]) % 256)
    chunk = lambda n, x: struct.pack(">I", len(x)) + n + x + struct.pack(">I", zlib.crc32(n + x))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("shape", [(9, 7, 3), (6, 1, 1), (1, 8, 3), (12, 12, 1)])
def test_every_filter(shape):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, shape, dtype=np.uint8)
    for kinds in ([k % 5 for k in range(shape[0])], [4] * shape[0], [3] * shape[0], [1] * shape[0], [2, 0] * shape[0]):
        assert (codec.decode(filtered_png(image, kinds)).reshape(shape) == image).all()


def test_a_large_filtered_image_is_fast():
    raw = np.random.default_rng(1).integers(0, 256, (2046, 2046), dtype=np.uint8)
    at = time.process_time()
    codec._unfilter(raw, np.full(2046, 4), 1)
    assert time.process_time() - at < 2


def test_kinds_of_files(spark, tmp_path):
    root = tmp_path / "case01" / "01" / "000" / "10000us"
    root.mkdir(parents=True)
    jvm = spark._jvm
    for name, kind, model in (("mono_a.jpg", "jpg", 10), ("mono_b.TIF", "tiff", 5), ("mono_c.bmp", "bmp", 5)):
        made = jvm.java.awt.image.BufferedImage(20, 10, model)
        for x in range(20):
            for y in range(10):
                made.setRGB(x, y, 0x404040 if x < 10 else 0xC0C0C0)
        assert jvm.javax.imageio.ImageIO.write(made, kind, jvm.java.io.File(str(root / name)))
    (root / "mono_d.png").write_bytes(codec.encode_png(np.zeros((4, 5), np.uint8)))
    (root / "mono_e.png").write_bytes(b"")
    (root / "mono_f.jpg").write_bytes(b"no image")
    (root / "mono g.jpeg").write_bytes(b"")
    rows = {r.name: r for r in images.scan(spark, str(tmp_path)).collect()}
    assert set(rows) == {"mono_a.jpg", "mono_b.TIF", "mono_c.bmp", "mono_d.png", "mono_e.png", "mono_f.jpg", "mono g.jpeg"}
    decoded = {k: codec.decode(bytes(r.content)) for k, r in rows.items()}
    assert decoded["mono_a.jpg"].shape[:2] == (10, 20) and decoded["mono_b.TIF"].shape == (10, 20, 3) and (decoded["mono_b.TIF"] == decoded["mono_c.bmp"]).all()
    assert abs(int(decoded["mono_a.jpg"].reshape(10, 20, -1)[5, 3, 0]) - int(decoded["mono_a.jpg"].reshape(10, 20, -1)[5, 16, 0])) > 90
    assert decoded["mono_d.png"].shape == (4, 5) and all(decoded[k] is None for k in ("mono_e.png", "mono_f.jpg", "mono g.jpeg"))
    assert rows["mono_a.jpg"].rel_path == "case01/01/000/10000us/mono_a.jpg" and rows["mono_a.jpg"].exposure_us == 10000
