"""PNG and BMP by their public specifications, in NumPy: 8 and 16 bit, 1, 3 and 4 channels (colour order as stored); and plain pixels that the JVM decoded."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def encode_png(image: np.ndarray) -> bytes:
    """Rows with filter 0; 16-bit samples big-endian."""
    image = image if image.ndim == 3 else image[:, :, None]
    h, w, c = image.shape
    kind = {1: 0, 2: 4, 3: 2, 4: 6}[c]
    depth = image.dtype.itemsize * 8
    if depth not in (8, 16):
        raise ValueError("8 or 16 bit")
    rows = image.astype(">u2" if depth == 16 else "u1").reshape(h, -1).view(np.uint8).reshape(h, -1)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], axis=1).tobytes()

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def _unfilter(raw: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    if kinds.max(initial=0) > 4:
        raise ValueError("filter")
    if kinds.max(initial=0) > 2:
        return _unfilter_diagonals(raw, kinds, step)
    h, n = raw.shape
    out = np.zeros((h + 1, n + step), np.uint8)  # a row above and a pixel before, both zero
    for y in range(h):
        line, up, kind, cur = raw[y], out[y], kinds[y], out[y + 1]
        if kind == 0:
            cur[step:] = line
        elif kind == 1:
            for k in range(step):
                cur[step + k :: step] = np.cumsum(line[k::step], dtype=np.uint64).astype(np.uint8)
        else:
            cur[step:] = line + up[step:]
    return out[1:, step:]


def _unfilter_diagonals(raw: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """All filters, a diagonal of pixels at a time: a pixel needs those to its left, above, and above left, which lie on earlier diagonals."""
    h, n = raw.shape
    w = n // step
    line = np.ascontiguousarray(raw).reshape(h * w, step).astype(np.int16)
    out = np.zeros(((h + 1) * (w + 1), step), np.int16)  # with a row above and a pixel before, both zero
    for d in range(h + w - 1):
        i0, i1 = max(0, d - w + 1), min(h, d + 1)
        y = np.arange(i0, i1)
        at = (y + 1) * (w + 1) + d - y + 1
        kind = kinds[i0:i1, None]
        a, b, c = out[at - 1], out[at - w - 1], out[at - w - 2]
        q = a + b - c
        pa, pb, pc = np.abs(q - a), np.abs(q - b), np.abs(q - c)
        paeth = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
        guess = np.where(kind == 4, paeth, np.where(kind == 3, (a + b) >> 1, np.where(kind == 2, b, np.where(kind == 1, a, 0))))
        out[at] = (line[y * w + d - y] + guess) & 255
    return out.reshape(h + 1, w + 1, step)[1:, 1:].reshape(h, n).astype(np.uint8)


def decode_png(data: bytes) -> np.ndarray:
    if data[:8] != _SIGNATURE:
        raise ValueError("not PNG")
    at, body, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        n, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        at += 12 + n
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body.append(part)
        elif name == b"IEND":
            break
    w, h, depth, kind, _, _, interlace = head
    if interlace or depth not in (8, 16):
        raise ValueError("interlaced or packed samples")
    c = _CHANNELS[kind]
    step = c * depth // 8
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * step)
    out = np.ascontiguousarray(_unfilter(raw[:, 1:], raw[:, 0], step))
    image = out.view(">u2").astype(np.uint16) if depth == 16 else out
    image = image.reshape(h, w, c)
    if kind == 3:
        image = palette[image[:, :, 0]]
    return image[:, :, 0] if image.shape[2] == 1 else image


def decode_bmp(data: bytes) -> np.ndarray:
    if data[:2] != b"BM":
        raise ValueError("not BMP")
    offset, _, w, h, _, bits, packing = struct.unpack("<IIiiHHI", data[10:34])
    if packing not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError("BMP kind")
    c = bits // 8
    stride = (w * c + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)[:, : w * c].reshape(abs(h), w, c)
    rows = rows[::-1] if h > 0 else rows
    return rows[:, :, 0].copy() if c == 1 else rows[:, :, [2, 1, 0, 3][:c]].copy()


#: Pixels decoded elsewhere: this mark, height, width and channels as big-endian 32-bit numbers, then rows of 8-bit samples, colours as blue, green, red.
PIXELS = b"PIX0"


def decode_pixels(data: bytes) -> np.ndarray:
    h, w, c = struct.unpack(">III", data[4:16])
    rows = np.frombuffer(data, np.uint8, h * w * c, 16).reshape(h, w, c)
    return rows[:, :, 0].copy() if c == 1 else rows[:, :, [2, 1, 0, 3][:c]].copy()


def decode(data: bytes | None) -> np.ndarray | None:
    """The image, or null for empty, unknown or broken data."""
    try:
        if not data:
            return None
        kind = {b"BM": decode_bmp, PIXELS[:2]: decode_pixels}.get(data[:2], decode_png)
        return kind(data)
    except (ValueError, KeyError, TypeError, IndexError, struct.error, zlib.error):
        return None
