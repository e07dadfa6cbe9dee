"""Defect masks and polygons: blurred difference, threshold, outer contours, fill, simplification, run-length codes."""

from __future__ import annotations

import numpy as np

from .filters import blur, otsu

_STEPS = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))  # clockwise from the right: (dy, dx)


def difference(image: np.ndarray, size: int, sigma: float, wide: bool = True) -> np.ndarray:
    """|image - blurred| as 0..255. wide=False wraps 16-bit samples to signed ones, as older tools do."""
    x = image.astype(np.float64)
    smooth = np.rint(blur(x, size, sigma))
    if wide:
        d = x - smooth
    else:
        d = (image.astype(np.int64).astype(np.int16).astype(np.int64) - smooth.astype(np.int64).astype(np.int16).astype(np.int64)).astype(np.int16).astype(float)
    if d.ndim == 3:
        d = d.mean(axis=2)
    return np.clip(np.abs(d), 0, 255).astype(np.uint8)


def regions(mask: np.ndarray) -> np.ndarray:
    """Labels 1.. of 8-connected regions in raster order of their first pixel; 0 is background."""
    h, w = mask.shape
    x = np.zeros((h, w + 2), np.int8)
    x[:, 1:-1] = mask > 0
    edge = np.diff(x, axis=1)
    ys, starts = np.nonzero(edge == 1)
    _, ends = np.nonzero(edge == -1)
    parent = list(range(len(ys)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    row = np.searchsorted(ys, np.arange(h + 1))
    for y in range(1, h):
        i, j = row[y - 1], row[y]
        while i < row[y] and j < row[y + 1]:
            if starts[i] <= ends[j] and starts[j] <= ends[i]:  # runs touch, corners included
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    out = np.zeros((h, w), np.int32)
    names: dict[int, int] = {}
    for k in range(len(ys)):
        out[ys[k], starts[k] : ends[k]] = names.setdefault(find(k), len(names) + 1)
    return out


def contour(region: np.ndarray) -> np.ndarray:
    """The outer boundary of one region as (x, y) pixel centres, by Moore tracing from its first pixel."""
    ys, xs = np.nonzero(region)
    start = (int(ys[0]), int(xs[0]))
    h, w = region.shape
    inside = lambda y, x: 0 <= y < h and 0 <= x < w and region[y, x]
    points, here, back = [start], start, 4  # it was entered from the left
    first = None
    for _ in range(4 * region.size + 8):
        for k in range(1, 9):
            d = (back + k) % 8
            y, x = here[0] + _STEPS[d][0], here[1] + _STEPS[d][1]
            if inside(y, x):
                break
        else:
            return np.array([[start[1], start[0]]])
        if here == start and first is not None and d == first:
            points.pop()
            break
        if first is None:
            first = d
        here, back = (y, x), (d + 4) % 8
        points.append(here)
    return np.array([(x, y) for y, x in points])


def area(points: np.ndarray) -> float:
    x, y = points[:, 0].astype(float), points[:, 1].astype(float)
    return abs(float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum())) / 2


def filled(region: np.ndarray) -> np.ndarray:
    """The region with its holes."""
    outside = regions_of_background(region)
    return ~outside


def regions_of_background(region: np.ndarray) -> np.ndarray:
    """Background that reaches the border by 4-connected steps."""
    free = np.pad(~region.astype(bool), 1, constant_values=True)
    seen = np.zeros_like(free)
    seen[0, 0] = True
    while True:
        grown = seen.copy()
        for axis, shift in ((0, 1), (0, -1), (1, 1), (1, -1)):
            line = np.moveaxis(grown, axis, 0)
            open_ = np.moveaxis(free, axis, 0)
            order = range(1, line.shape[0]) if shift == 1 else range(line.shape[0] - 2, -1, -1)
            for k in order:
                line[k] |= line[k - shift] & open_[k]
        if np.array_equal(grown, seen):
            return seen[1:-1, 1:-1]
        seen = grown


def simplify(points: np.ndarray, epsilon: float) -> np.ndarray:
    """Douglas-Peucker on a closed curve, cut at its first point and the one farthest from it."""
    if len(points) < 3 or epsilon <= 0:
        return points
    p = points.astype(float)
    far = int(np.argmax(((p - p[0]) ** 2).sum(1)))

    def open_curve(q: np.ndarray) -> list[int]:
        keep, stack = {0, len(q) - 1}, [(0, len(q) - 1)]
        while stack:
            a, b = stack.pop()
            if b - a < 2:
                continue
            d = q[b] - q[a]
            r = q[a + 1 : b] - q[a]
            norm = float(np.hypot(*d))
            dist = np.abs(d[0] * r[:, 1] - d[1] * r[:, 0]) / norm if norm else np.hypot(r[:, 0], r[:, 1])
            k = int(np.argmax(dist))
            if dist[k] > epsilon:
                keep.add(a + 1 + k)
                stack += [(a, a + 1 + k), (a + 1 + k, b)]
        return sorted(keep)

    first = open_curve(p[: far + 1])
    second = open_curve(np.concatenate([p[far:], p[:1]]))
    index = first + [far + k for k in second[1:-1]]
    return points[index]


def defect_mask(image: np.ndarray, size: int = 21, sigma: float = 0.0, threshold: int | None = None, min_area: float = 10.0, wide: bool = True) -> np.ndarray:
    """0/255: filled outer regions of the thresholded difference whose contour's area is at least min_area. A threshold of 0 is fixed too; none means Otsu's."""
    d = difference(image, size, sigma, wide)
    hit = d > (otsu(d) if threshold is None else threshold)
    labels = regions(hit)
    out = np.zeros(d.shape, np.uint8)
    for k in range(1, int(labels.max(initial=0)) + 1):
        region = labels == k
        if area(contour(region)) >= min_area:
            out[filled(region)] = 255
    return out


def polygons(mask: np.ndarray, ratio: float = 0.002) -> list[np.ndarray]:
    """Simplified outer contours of at least three vertices, normalised by width and height, in raster order."""
    labels = regions(mask > 0)
    out = []
    for k in range(1, int(labels.max(initial=0)) + 1):
        c = contour(labels == k)
        step = np.diff(np.concatenate([c, c[:1]]).astype(float), axis=0)
        c = simplify(c, ratio * float(np.hypot(step[:, 0], step[:, 1]).sum()))
        if len(c) >= 3:
            out.append(c / np.array([mask.shape[1], mask.shape[0]], float))
    return out


def label_lines(found: list[np.ndarray], class_id: int = 0) -> list[str]:
    return [" ".join([str(class_id), *(f"{min(max(v, 0.0), 1.0):.6f}" for v in p.ravel())]) for p in found]


_SIZES = (3, 4, 8, 16)  # fixed values of the run-length format: bits of the four length kinds


def rle_encode(mask: np.ndarray) -> list[int]:
    """A 0/255 mask as the annotation tool's run-length bytes: each pixel four equal channel values, runs of at most 65536."""
    flat = np.where(mask.ravel() > 128, 255, 0)
    cut = np.flatnonzero(np.diff(flat)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(flat)]])
    bits = [f"{4 * len(flat):032b}", f"{8 - 1:05b}", *(f"{s - 1:04b}" for s in _SIZES)]
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if len(flat) else ():
        left = 4 * (b - a)
        while left:
            n = min(left, 65536)
            k = next(i for i, s in enumerate(_SIZES) if n - 1 < 1 << s)
            bits.append(f"1{k:02b}{n - 1:0{_SIZES[k]}b}{int(flat[a]):08b}")
            left -= n
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    return [int(text[i : i + 8], 2) for i in range(0, len(text), 8)]


def rle_decode(code: list[int], shape: tuple[int, int]) -> np.ndarray:
    text = "".join(f"{x:08b}" for x in code)
    at = 0

    def read(n: int) -> int:
        nonlocal at
        at += n
        return int(text[at - n : at], 2)

    total, word = read(32), read(5) + 1
    sizes = [read(4) + 1 for _ in range(4)]
    out: list[int] = []
    while len(out) < total:
        run = read(1)
        n = read(sizes[read(2)]) + 1
        out += [read(word)] * n if run else [read(word) for _ in range(n)]
    return np.array(out, np.uint8).reshape(*shape, 4)[:, :, 0]
