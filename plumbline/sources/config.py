"""The strict configuration of the boundary mode: defaults, a mapping laid over them, and rules that name what breaks them."""

from __future__ import annotations

import copy
import json
import math

#: Defaults by section. The type of a default is the type that its key takes.
DEFAULTS: dict[str, dict] = {
    "preprocess": {"gaussian_sigma": 1.0, "illumination_normalization": True, "illumination_sigma": 41.0, "clahe": False},
    "gabor": {"kernel_size": 21, "envelope_size": 31, "sigma": 4.0, "wavelength": 8.0, "gamma": 0.5, "orientations": 8},
    "candidate": {
        "aggregation": "median", "x_bin_width": 16, "smooth_size": 9, "std_weight": 0.3, "gap": 4, "window": 24, "weights": [0.35, 0.15, 0.35, 0.15], "min_contrast": 0.03, "min_score": 0.1, "peak_distance": 6,
        "top_k": 5, "bottom_k": 5, "alternative_radius": 30, "alternative_penalty": 0.5,
    },
    "pair": {"min_height_ratio": 0.08, "expected_height_ratio": 0.35, "max_height_ratio": 0.95, "weights": [0.5, 0.1, 0.25, 0.15]},
    "dp": {"lambda_position": 1.0, "lambda_slope": 12.0, "lambda_height": 0.5},
    "ransac": {"thresholds": [8.0, 12.0, 16.0]},
    "recovery": {"search_margin": 30},
    "outside": {"gap": 6, "window": 24, "min_energy": 0.35, "min_inside_energy": 0.05, "ratio_threshold": 0.80, "min_bin_fraction": 0.20, "min_adjacent_bins": 3, "min_valid_fraction": 0.5},
    "quality": {
        "min_score": 0.35, "min_inlier_ratio": 0.5, "min_x_coverage": 0.70, "max_gap_ratio": 0.25, "max_rmse_px": 12.0, "max_median_residual_px": 8.0, "min_third_support": 1, "min_consensus_ratio": 0.5, "max_tilt_deg": 15.0,
        "max_angle_diff_deg": 2.5, "max_height_variation_px": 100.0, "ambiguity_score_gap": 0.02, "ambiguity_boundary_gap_px": 30.0, "consensus_distance_px": 20.0, "weights": [0.35, 0.2, 0.2, 0.15, 0.1],
    },
    "mask": {"margin_top": 0, "margin_bottom": 0},
}

_ODD = {"gabor.kernel_size", "gabor.envelope_size", "candidate.smooth_size"}
_POSITIVE = {
    "gabor.sigma", "gabor.wavelength", "gabor.gamma", "gabor.orientations", "candidate.x_bin_width", "candidate.top_k", "candidate.bottom_k", "candidate.window", "candidate.peak_distance", "recovery.search_margin",
    "outside.window", "outside.min_adjacent_bins", "quality.max_rmse_px", "quality.max_tilt_deg", "quality.consensus_distance_px", "preprocess.illumination_sigma",
}
_SHARE = {
    "quality.min_score", "quality.min_inlier_ratio", "quality.min_x_coverage", "quality.max_gap_ratio", "quality.min_consensus_ratio", "outside.min_energy", "outside.min_inside_energy", "outside.min_bin_fraction",
    "outside.min_valid_fraction", "candidate.std_weight", "candidate.min_score", "candidate.min_contrast",
}


def _number(x) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool) and math.isfinite(x) and x >= 0


def _problem(name: str, value, default) -> str | None:
    """What is wrong with a value by itself."""
    if isinstance(default, bool):
        return None if isinstance(value, bool) else "must be boolean"
    if isinstance(default, str):
        return None if value in ("mean", "median") else "must be mean or median"
    if isinstance(default, list):
        if not isinstance(value, list) or len(value) != len(default) or not all(map(_number, value)):
            return f"must be a list of {len(default)} finite numbers from 0 on"
        return "cannot be all zero" if name.endswith(".weights") and not sum(value) else None
    if not _number(value):
        return "must be a finite number from 0 on"
    if isinstance(default, int) and not isinstance(value, int):
        return "must be an integer"
    if name in _ODD and (value < 3 or value % 2 == 0):
        return "must be odd and at least 3"
    if name in _POSITIVE and value <= 0:
        return "must be positive"
    return "must lie in [0, 1]" if name in _SHARE and value > 1 else None


def load(over: dict | str | None = None) -> dict[str, dict]:
    """The defaults with a mapping, or the JSON or YAML text of one, laid over. All problems are told at once."""
    if isinstance(over, str):
        over = _parse(over)
    if over is not None and not isinstance(over, dict):
        raise ValueError("the configuration must be a mapping")
    out, wrong = copy.deepcopy(DEFAULTS), []
    for section, values in (over or {}).items():
        if section not in out or not isinstance(values, dict):
            wrong.append(f"{section}: unknown or no mapping")
            continue
        wrong += [f"{section}.{k}: unknown" for k in values if k not in out[section]]
        out[section] |= {k: v for k, v in values.items() if k in out[section]}
    own = [(f"{s}.{k}", v, DEFAULTS[s][k]) for s, values in out.items() for k, v in values.items()]
    wrong += [f"{name}: {text}" for name, v, d in own if (text := _problem(name, v, d))]
    if not wrong:
        p, t = out["pair"], out["ransac"]["thresholds"]
        rules = (
            (0 < p["min_height_ratio"] <= p["expected_height_ratio"] <= p["max_height_ratio"] <= 1, "pair: 0 < min <= expected <= max <= 1"),
            (t[0] > 0 and all(a < b for a, b in zip(t, t[1:], strict=False)), "ransac.thresholds: positive and strictly rising"),
            (out["quality"]["max_tilt_deg"] < 90, "quality.max_tilt_deg: below 90"),
        )
        wrong = [text for ok, text in rules if not ok]
    if wrong:
        raise ValueError("; ".join(wrong))
    return out


def _parse(text: str):
    text = text.removeprefix("﻿")
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError:
        raise ValueError("without a YAML reader the configuration must be JSON") from None
    return yaml.safe_load(text)
