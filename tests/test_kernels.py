import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.functions import codec, filters, lines, masks
from plumbline.operators import catalog, reference


@pytest.mark.parametrize(("shape", "dtype"), [((7, 5), np.uint8), ((6, 9), np.uint16), ((4, 4, 3), np.uint8), ((4, 3, 4), np.uint16), ((1, 1), np.uint8)])
def test_png_round_trip(shape, dtype):
    x = np.random.default_rng(0).integers(0, np.iinfo(dtype).max + 1, shape).astype(dtype)
    assert np.array_equal(codec.decode(codec.encode_png(x)), x)


@pytest.mark.parametrize("data", [b"", None, b"text", b"\x89PNG\r\n\x1a\n", b"BM123"])
def test_broken_images_are_null(data):
    assert codec.decode(data) is None


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 2**32 - 1))
def test_rle_round_trip(h, w, seed):
    m = (np.random.default_rng(seed).random((h, w)) > 0.5).astype(np.uint8) * 255
    assert np.array_equal(masks.rle_decode(masks.rle_encode(m), m.shape), m)


def test_rle_long_runs_and_threshold():
    m = np.zeros((200, 200), np.uint8)
    assert np.array_equal(masks.rle_decode(masks.rle_encode(m), m.shape), m)
    assert masks.rle_decode(masks.rle_encode(np.array([[128, 129]], np.uint8)), (1, 2)).tolist() == [[0, 255]]


def test_regions_fill_and_polygons():
    m = np.zeros((20, 30), np.uint8)
    m[3:9, 4:12] = 255
    m[5:7, 6:8] = 0
    m[12, 20] = m[13, 21] = 255  # joined by a corner
    labels = masks.regions(m)
    assert labels.max() == 2
    assert masks.filled(labels == 1).sum() == 48
    assert masks.area(masks.contour(labels == 1)) == 35
    found = masks.polygons(m, 0.01)
    assert len(found) == 1 and len(found[0]) == 4
    assert masks.label_lines(found)[0].startswith("0 0.133333 0.150000")


def test_defect_mask_finds_a_patch_and_spares_a_flat_image():
    x = np.full((60, 80), 100, np.uint8)
    assert not masks.defect_mask(x).any()
    x[20:30, 30:45] = 180
    assert masks.defect_mask(x)[22:28, 32:43].all()
    assert masks.defect_mask(x.astype(np.uint16) * 200)[20, 30]


def test_filters_against_definitions():
    x = np.random.default_rng(1).random((12, 15))
    p = np.pad(x, 2, mode="symmetric")
    want = np.array([[p[i : i + 5, j : j + 5].std() for j in range(15)] for i in range(12)])
    assert np.allclose(filters.local_std(x, 5), want, atol=1e-6)
    assert filters.gaussian_kernel(5).sum() == pytest.approx(1)
    assert filters.otsu(np.array([[10, 10, 200, 200]], np.uint8)) == 10
    k = filters.gabor_bank(5, 1.5, 3.0, 0.6, 2)[1]
    direct = np.array([[(p[i : i + 5, j : j + 5] * k).sum() for j in range(15)] for i in range(12)])
    assert np.allclose(filters.convolve(x, k), direct)
    assert not filters.normalise(np.full(5, 3.0)).any()


def test_peaks_and_path_against_brute_force():
    import itertools

    assert lines.peaks(np.array([0, 1, 1, 0, 3, 0, 2, 0.0]), 0.5, 0.1, 1, 2).tolist() == [4, 6]
    rng = np.random.default_rng(3)
    c = lines.Config()
    columns = [(10.0 * k, [{"y0": int(a), "y1": int(a + rng.integers(5, 20)), "score": float(rng.random())} for a in rng.integers(0, 40, 3)]) for k in range(5)]

    def cost(path):
        y = np.array([[p["y0"], p["y1"]] for p in path], float)
        d = np.diff(y, axis=0)
        total = -sum(p["score"] for p in path) + (c.continuity * np.abs(d).sum(1) + c.continuity / 2 * np.abs(d[:, 1] - d[:, 0])).sum() / 100
        return total + c.slope * 10 / 100 * np.abs(np.diff(d / 10, axis=0)).sum()

    best = min(itertools.product(*(cand for _, cand in columns)), key=cost)
    assert cost([p for _, p in lines.best_path(columns, 100, c)]) == pytest.approx(cost(best))


def band(h=160, w=200, slope=0.0, seed=0):
    rng = np.random.default_rng(seed)
    x = np.full((h, w), 110.0)
    y = np.arange(h)[:, None]
    cols = np.arange(w)
    inside = (y >= 50 + slope * cols) & (y < 105 + slope * cols)
    return np.where(inside, x + rng.normal(0, 40, (h, w)), x + rng.normal(0, 1, (h, w))).clip(0, 255).astype(np.uint8)


@pytest.mark.parametrize("mode", ["std", "fft", "gabor"])
def test_detects_a_textured_band(mode):
    from plumbline.operators.regions import detect_image

    out = detect_image(band(slope=0.05), mode, lines.Config(smooth=9, gap=4, window=20))
    assert out["status"] in ("fitted", "recovered"), out
    assert abs(out["top_intercept"] - 50) < 12 and abs(out["bottom_intercept"] - 105) < 12


def test_flat_and_tiny_images_have_no_region():
    from plumbline.operators.regions import detect_image

    assert detect_image(np.full((80, 90), 7, np.uint8), "std", lines.Config())["status"] == "no_roi"
    assert detect_image(np.zeros((3, 1), np.uint8), "std", lines.Config())["status"] == "no_roi"


def test_metrics_of_a_shifted_band():
    w = 10
    m = lines.boundary_metrics(np.full(w, 22.0), np.full(w, 62.0), np.full(w, 20.0), np.full(w, 60.0), 100)
    assert m["top_mae_px"] == m["bottom_mae_px"] == 2
    assert m["under_crop_pixels"] == m["over_crop_pixels"] == 20
    assert math.isclose(m["mask_iou"], 39 / 43)


def test_small_helpers():
    assert catalog.parse_extensions(" PNG, .jpg;png,") == [".png", ".jpg"]
    assert reference.exact_total([("b", 3), ("a", 2), ("c", 5)], 5) == ["a", "b"]
    assert reference.exact_total([("a", 2)], 3) is None
