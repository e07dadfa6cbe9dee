"""The boundary mode's kernels: evidence of a textured band's edges strip by strip, paths, robust lines, alternatives, outside texture.

Arrays are (side, strip, row) with sides top and bottom; strips are x_bin_width columns wide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from . import filters, lattice, lines

SIDE_NAMES = ("top", "bottom")


@dataclass
class Evidence:
    height: int
    width: int
    x: np.ndarray
    texture: np.ndarray  # strip, row
    marks: np.ndarray  # side, strip, row: how much a row looks like the side's edge
    contrast: np.ndarray  # inside less outside
    outside: np.ndarray


def _blur(image: np.ndarray, sigma: float) -> np.ndarray:
    if sigma <= 0:
        return image
    kernel = filters.gaussian_kernel(min(int(round(8 * sigma + 1)) | 1, 2 * min(image.shape) - 1), sigma)
    return filters.along(filters.along(image, kernel, 1, "symmetric"), kernel, 0, "symmetric")


def _positive(values: np.ndarray) -> np.ndarray:
    """Each row of values by its 99th percentile of size, cut to 0..1."""
    top = np.percentile(np.abs(values), 99, axis=-1, keepdims=True)
    return np.clip(values / np.maximum(top, 1e-8), 0, 1)


def measure(image: np.ndarray, config: dict) -> Evidence:
    """Gabor texture, deviation and brightness edges, averaged over strips, and what they say of each row as an edge."""
    pre, bank, cand = (config[k] for k in ("preprocess", "gabor", "candidate"))
    gray = filters.robust_unit(filters.gray(image))
    smooth = _blur(gray, pre["gaussian_sigma"])
    even = smooth - _blur(smooth, pre["illumination_sigma"]) if pre["illumination_normalization"] else smooth
    if pre["clahe"]:
        even = filters.clahe((filters.robust_unit(even) * 255).astype(np.uint8)) / 255.0
    kernels = filters.gabor_bank(bank["kernel_size"], bank["sigma"], bank["wavelength"], bank["gamma"], bank["orientations"])
    energy = np.max([np.abs(filters.convolve(even, k.real)) for k in kernels], axis=0)
    maps = {
        "gabor": filters.robust_unit(filters.box_mean(energy, bank["envelope_size"])),
        "std": filters.robust_unit(filters.local_std(smooth, 31)),
        "edge": filters.robust_unit(np.abs(filters.scharr_y(smooth))),
    }
    h, w = gray.shape
    cuts = np.arange(0, w, cand["x_bin_width"])
    ends = np.minimum(cuts + cand["x_bin_width"], w)
    reduce = np.mean if cand["aggregation"] == "mean" else np.median
    kernel = filters.gaussian_kernel(min(cand["smooth_size"], h - 1 + h % 2) | 1)
    strip = {k: filters.along(np.stack([reduce(m[:, a:b], axis=1) for a, b in zip(cuts, ends, strict=True)]), kernel, 1, "symmetric") for k, m in maps.items()}
    texture = (1 - cand["std_weight"]) * strip["gabor"] + cand["std_weight"] * strip["std"]
    y, gap, far = np.arange(h), cand["gap"], cand["gap"] + cand["window"]
    above, below = filters.range_means(texture, y - far, y - gap), filters.range_means(texture, y + gap, y + far)
    inside, outside = np.stack([below, above]), np.stack([above, below])
    contrast = inside - outside
    sign = lines.SIDES[:, :, None]
    change = _positive(sign * np.gradient(strip["gabor"], axis=1)) if h > 1 else np.zeros_like(contrast)
    apart = _positive(contrast)
    around = filters.along(apart.reshape(-1, h), np.full(3, 1 / 3), 1, "symmetric").reshape(apart.shape)
    parts = (change, np.broadcast_to(_positive(strip["edge"]), contrast.shape), apart, around)
    marks = sum(k * p for k, p in zip(np.array(cand["weights"]) / sum(cand["weights"]), parts, strict=True))
    marks = np.where((contrast >= cand["min_contrast"]) & (y >= far) & (y < h - far), marks, 0.0)
    return Evidence(h, w, (cuts + ends - 1) / 2, texture, marks, contrast, outside)


def strongest(values: np.ndarray, count: int, config: dict, allowed: np.ndarray | None = None) -> np.ndarray:
    """The rows of the highest peaks that keep their distance. Rows that aren't allowed neither count nor crowd others out."""
    found = lines.peaks(values, config["min_score"], 0.0, 1, len(values))
    if allowed is not None:
        found = found[allowed[found]]
    kept: list[int] = []
    for p in sorted(found.tolist(), key=lambda p: (-values[p], p)):
        if all(abs(p - q) >= config["peak_distance"] for q in kept):
            kept.append(p)
    return np.array(sorted(kept[:count]), int)


def pairs(e: Evidence, config: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each strip its pairs of rows (n x 2) and their scores."""
    cand, pair = config["candidate"], config["pair"]
    weights = np.array(pair["weights"]) / sum(pair["weights"])
    spread = max(pair["max_height_ratio"] - pair["min_height_ratio"], 1e-6)
    out = []
    for i in range(len(e.x)):
        tops, bottoms = (strongest(e.marks[s, i], cand[k], cand) for s, k in ((0, "top_k"), (1, "bottom_k")))
        y = np.array([(a, b) for a in tops for b in bottoms], int).reshape(-1, 2)
        thick = (y[:, 1] - y[:, 0]) / e.height
        ok = (thick >= pair["min_height_ratio"]) & (thick <= pair["max_height_ratio"])
        y, thick = y[ok], thick[ok]
        of = lambda a, i=i, y=y: np.stack([a[0, i, y[:, 0]], a[1, i, y[:, 1]]])
        parts = (of(e.marks).mean(0), 1 - np.abs(thick - pair["expected_height_ratio"]) / spread, np.clip(2 * of(e.contrast).min(0), 0, 1), 1 - of(e.outside).mean(0))
        out.append((y.astype(float), weights @ np.stack(parts) if len(y) else np.zeros(0)))
    return out


def path(x: np.ndarray, choices: list[tuple[np.ndarray, np.ndarray]], height: int, config: dict) -> tuple[np.ndarray, np.ndarray]:
    """Positions and rows (n x 2) of the cheapest path through the strips that have choices."""
    held = [k for k, (y, _) in enumerate(choices) if len(y)]
    if not held:
        return np.zeros(0), np.zeros((0, 2))
    dp = config["dp"]
    spacing = float(np.median(np.diff(x))) if len(x) > 1 else 1.0
    net = lattice.boundaries(x[held], [choices[k][0] for k in held], [choices[k][1] for k in held], height, spacing, dp["lambda_position"], dp["lambda_slope"], dp["lambda_height"])
    return x[held], np.stack([choices[k][0][j] for k, j in zip(held, net.best(), strict=True)])


def _limits(config: dict) -> lines.Config:
    q = config["quality"]
    return lines.Config(min_inlier_ratio=q["min_inlier_ratio"], min_span=q["min_x_coverage"], max_gap=q["max_gap_ratio"], max_rmse=q["max_rmse_px"], max_median=q["max_median_residual_px"])


def failures(line: lines.Line, config: dict) -> int:
    """How many of the mode's gates a line fails; a line that isn't there fails all."""
    if line.rmse is None:
        return 99
    q = config["quality"]
    return sum(
        (not line.valid, line.inlier_ratio < q["min_inlier_ratio"], line.span_ratio < q["min_x_coverage"], line.max_gap_ratio > q["max_gap_ratio"], line.rmse > q["max_rmse_px"], line.median_residual > q["max_median_residual_px"], min(line.thirds) < q["min_third_support"])
    )


def fit(points: np.ndarray, width: int, config: dict) -> lines.Line:
    """Up the ladder of tolerances to the first line without a failure, else the one with fewest."""
    tried = []
    for t in config["ransac"]["thresholds"]:
        tried.append(lines.fit_line(points, width, t, _limits(config)))
        if not failures(tried[-1], config):
            break
    best = min(tried, key=lambda f: (failures(f, config), math.inf if f.rmse is None else f.rmse))
    best.attempts = len(tried)
    return best


def other_side(e: Evidence, known: lines.Line, side: int, thickness: float, config: dict) -> lines.Line:
    """A line for the side that has none, from peaks within a band around the known one moved by the thickness."""
    pair, cand, radius = config["pair"], config["candidate"], config["recovery"]["search_margin"]
    y, away = np.arange(e.height), 1 if side else -1
    choices = []
    for i, base in enumerate(known.at(e.x)):
        thick = away * (y - base)
        allowed = (np.abs(thick - thickness) <= radius) & (thick >= pair["min_height_ratio"] * e.height) & (thick <= pair["max_height_ratio"] * e.height)
        found = strongest(e.marks[side, i], 3 * max(cand["top_k"], cand["bottom_k"]), cand, allowed)
        rows = np.full((len(found), 2), base)
        rows[:, side] = found
        choices.append((rows, e.marks[side, i, found]))
    x, rows = path(e.x, choices, e.height, config)
    return fit(np.stack([x, rows[:, side]], 1), e.width, config)


def lone_side(e: Evidence, side: int, config: dict) -> lines.Line:
    """A side's line where no strip has a pair."""
    cand = config["candidate"]
    found = [strongest(e.marks[side, i], cand[f"{SIDE_NAMES[side]}_k"], cand) for i in range(len(e.x))]
    x, rows = path(e.x, [(np.stack([f, f], 1).astype(float), e.marks[side, i, f]) for i, f in enumerate(found)], e.height, config)
    return fit(np.stack([x, rows[:, side]], 1), e.width, config)


def candidate(e: Evidence, x: np.ndarray, rows: np.ndarray, config: dict) -> dict | None:
    """Both lines of a path with one side recovered from the other where only one holds; an unknown side leaves the frame untrimmed."""
    both = [fit(np.stack([x, rows[:, s]], 1), e.width, config) if len(x) else lone_side(e, s, config) for s in (0, 1)]
    good = [failures(f, config) == 0 for f in both]
    how = []
    if sum(good) == 1:
        lost = good.index(False)
        usual = float(np.median(rows[:, 1] - rows[:, 0])) if len(x) else e.height * config["pair"]["expected_height_ratio"]
        again = other_side(e, both[1 - lost], lost, usual, config)
        if not failures(again, config):
            both[lost], good[lost] = again, True
            how.append(f"reacquire_{SIDE_NAMES[lost]}")
    how += [f"relaxed_ransac_{n}" for n, f in zip(SIDE_NAMES, both, strict=True) if f.tolerance > config["ransac"]["thresholds"][0]]
    known = [f.rmse is not None for f in both]
    if not any(known):
        return None
    edge = lambda s: lines.Line(intercept=float(s * (e.height - 1)))
    both = [f if k else edge(s) for s, (f, k) in enumerate(zip(both, known, strict=True))]
    ends = np.stack([f.at([0, e.width - 1]) for f in both])
    if not np.isfinite(ends).all() or (ends[0] >= ends[1]).any():
        if sum(good) != 1:
            return None
        held = good.index(True)
        if not ((ends[held] > 0) & (ends[held] < e.height - 1)).all():
            return None
        both[1 - held], known[1 - held] = edge(1 - held), False
    return {"lines": both, "roi_detected": all(known), "recovery_method": ";".join(how)}


def score(e: Evidence, both: list[lines.Line], config: dict) -> dict[str, float]:
    """The parts of a candidate's quality, but for the agreement with other exposures."""
    q = config["quality"]
    rows = np.arange(e.height)
    seen = [np.mean([np.interp(y, rows, m, left=0, right=0) for y, m in zip(f.at(e.x), e.marks[s], strict=True)]) for s, f in enumerate(both)]
    change = abs(both[1].slope - both[0].slope) * (e.width - 1)
    return {
        "boundary": float(min(seen)),
        "line": min(math.exp(-(e.height if f.rmse is None else f.rmse) / q["max_rmse_px"]) for f in both),
        "coverage": min(f.span_ratio * (1 - min(1.0, f.max_gap_ratio)) for f in both),
        "geometry": math.exp(-change / max(1.0, q["max_height_variation_px"])),
    }


VARIANTS = {"primary": (), "alternative_top": (0,), "alternative_bottom": (1,), "alternative_pair": (0, 1)}


def candidates(e: Evidence, config: dict) -> list[dict]:
    """The primary path's candidate and those of paths that are paid less near it, without near repeats."""
    cand = config["candidate"]
    choices = pairs(e, config)
    x, rows = path(e.x, choices, e.height, config)
    taken = dict(zip(x.tolist(), rows, strict=True))
    out: list[dict] = []
    for name, sides in VARIANTS.items():
        way = x, rows
        if sides and len(x):
            fined = []
            for at, (y, paid) in zip(e.x.tolist(), choices, strict=True):
                near = (np.abs(y[:, sides] - taken[at][list(sides)]) < cand["alternative_radius"]).all(1) if at in taken else np.zeros(len(y), bool)
                fined.append((y, paid - cand["alternative_penalty"] * near))
            way = path(e.x, fined, e.height, config)
        found = candidate(e, *way, config)
        if found is None:
            continue
        ends = np.concatenate([f.at([0, e.width - 1]) for f in found["lines"]])
        if all(np.abs(ends - c["ends"]).max() > 1 for c in out):
            out.append(found | {"method": f"gabor_{name}", "ends": ends, "parts": score(e, found["lines"], config), "candidate_counts": [len(y) for y, _ in choices]})
    return out


def beyond(e: Evidence, line: lines.Line, side: int, config: dict) -> list[tuple[float, float | None, float | None]]:
    """For each strip (x, texture outside the line, texture inside it); nulls where a range leaves the image."""
    o, away = config["outside"], 1 if side else -1
    out = []
    for x, row, t in zip(e.x, line.at(e.x), e.texture, strict=True):
        ranges = [sorted(round(row + sign * d) for d in (o["gap"], o["gap"] + o["window"])) for sign in (away, -away)]
        fits = all(0 <= a < b <= e.height for a, b in ranges)
        out.append((float(x), *(float(t[a:b].mean()) if fits else None for a, b in ranges)))
    return out
