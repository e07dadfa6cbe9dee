"""Region-of-interest detection and masking: image kernels in Arrow batches, everything else relational."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import bands, codec, filters, lines
from . import exports

DETECTED = (
    "rel_path string, mode string, status string, reason string, found boolean, needs_review boolean, input_height int, input_width int, channels int, dtype string, "
    "top_slope double, top_intercept double, top_rmse double, top_inlier_ratio double, bottom_slope double, bottom_intercept double, bottom_rmse double, bottom_inlier_ratio double, "
    "selected_pair_count int, pair_score_mean double, points_json string"
)


RECOVERY_CHOICES = 12  # of a strip
_SIDE = "{0}_slope double, {0}_intercept double, {0}_valid boolean, {0}_rmse double, {0}_median_residual double, {0}_inlier_ratio double, {0}_x_coverage double, {0}_max_gap_ratio double, {0}_least_third int"
BANDS = (
    "rel_path string, input_height int, input_width int, method string, roi_detected boolean, was_recovered boolean, recovery_method string, "
    "part_boundary double, part_line double, part_coverage double, part_geometry double, ends array<double>, candidate_counts array<int>, "
    f"{_SIDE.format('top')}, {_SIDE.format('bottom')}, beyond array<struct<side:string,x:double,out:double,inside:double>>"
)


def _rows(schema: str, work):
    """A batch function that maps each row (a dict) to any number of rows of the schema."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([out for row in b.to_pylist() for out in work(row)], schema=arrow)

    return run


def _scores(gray: np.ndarray, mode: str, x0: int, x1: int, bank) -> np.ndarray:
    part = gray[:, x0:x1]
    if mode == "std":
        return filters.local_std(part, 31 if min(part.shape) > 31 else 2 * (min(part.shape) // 2) - 1 or 1).mean(axis=1)
    if mode == "fft":
        window = max(4, min(32, *part.shape))
        return filters.fft_band(part, window, max(1, window // 4), 0.08, 0.45)
    return filters.gabor_energy(part, bank).mean(axis=1)


def detect_image(image: np.ndarray, mode: str, c: lines.Config) -> dict:
    """Strips, pair candidates, a smooth path, two robust lines, gates: fitted, recovered, needs_review or no_roi."""
    g = filters.gray(image)
    h, w = g.shape
    bank = filters.gabor_bank(15, 3.0, 6.0, 0.6, 4) if mode == "gabor" else None
    edges = np.linspace(round(0.05 * w), round(0.95 * w), max(1, min(c.strips, w // 8 or 1)) + 1).astype(int)
    bright = np.abs(filters.scharr_y(g)) if min(h, w) > 1 else np.zeros_like(g)
    columns = []
    for x0, x1 in zip(edges[:-1], edges[1:], strict=True):
        if x1 > x0 and h >= 5:
            score = filters.along(_scores(g, mode, x0, x1, bank)[:, None], filters.gaussian_kernel(min(c.smooth, h - 1 + h % 2) | 1), 0, "symmetric")[:, 0]
            columns.append(((x0 + x1 - 1) / 2, lines.pair_candidates(score, bright[:, x0:x1].mean(axis=1), c)))
    path = lines.best_path(columns, h, c, anchored=True)
    out = {"status": "no_roi", "reason": "no_candidates", "found": False, "selected_pair_count": len(path), "pair_score_mean": float(np.mean([p["score"] for _, p in path])) if path else None}
    if not path:
        return out
    points = [np.array([(x, p[k]) for x, p in path], float) for k in ("y0", "y1")]
    top, bottom = (lines.fit_with_retries(p, w, c) for p in points)
    recovered = max(top.attempts, bottom.attempts) > 1
    for known, lost, name in ((top, bottom, "bottom"), (bottom, top, "top")):
        if known.valid and not lost.valid:  # the other side, within a corridor around the known side and the usual distance
            offset = float(np.median(points[1][:, 1] - points[0][:, 1])) * (1 if name == "bottom" else -1)
            k = "y1" if name == "bottom" else "y0"
            radius = max(2.0, 0.10 * h)
            found = []
            for x, cand in columns:
                near = {p[k]: p["score"] - 0.15 * abs(p[k] - known.at(x) - offset) / radius for p in sorted(cand, key=lambda p: p["score"]) if abs(p[k] - known.at(x) - offset) <= radius}
                best = sorted(near.items(), key=lambda q: (-q[1], q[0]))[:RECOVERY_CHOICES]
                found.append((x, [{"y0": y, "y1": y, "score": v} for y, v in best]))
            again = lines.fit_with_retries(np.array([(x, p["y0"]) for x, p in lines.best_path(found, h, c)], float).reshape(-1, 2), w, c)
            if again.valid:
                recovered = True
                top, bottom = (top, again) if name == "bottom" else (again, bottom)
    reason = top.reason or bottom.reason or lines.geometry_reason(top, bottom, (h, w), c)
    status = "needs_review" if reason else "recovered" if recovered else "fitted"
    return out | {
        "status": status, "reason": reason, "found": bool(top.rmse is not None and bottom.rmse is not None), "top_slope": top.slope, "top_intercept": top.intercept, "top_rmse": top.rmse, "top_inlier_ratio": top.inlier_ratio,
        "bottom_slope": bottom.slope, "bottom_intercept": bottom.intercept, "bottom_rmse": bottom.rmse, "bottom_inlier_ratio": bottom.inlier_ratio, "points_json": json.dumps([p.tolist() for p in points]),
    }


def detect(images: DataFrame, modes: list[str], config: lines.Config | None = None) -> DataFrame:
    """images: rel_path, content -> one row per image and mode. An unreadable image is skipped with its reason."""
    c = config or lines.Config()

    def work(row: dict) -> Iterator[dict]:
        image = codec.decode(row["content"])
        for mode in modes:
            out = {"rel_path": row["rel_path"], "mode": mode, "status": "skipped", "reason": "unreadable_reference", "found": False}
            if image is not None:
                out |= {"input_height": image.shape[0], "input_width": image.shape[1], "channels": 1 if image.ndim == 2 else image.shape[2], "dtype": str(image.dtype)}
                out |= detect_image(image, mode, c)
            yield out | {"needs_review": out["status"] in ("needs_review", "no_roi", "skipped")}

    return images.select("rel_path", "content").mapInArrow(_rows(DETECTED, work), DETECTED)


def detect_bands(images: DataFrame, config: dict) -> DataFrame:
    """images: rel_path, content -> a row for each candidate of the boundary mode; one without a method where there is none, without a size where the image can't be read."""

    def work(row: dict) -> Iterator[dict]:
        image = codec.decode(row["content"])
        base = {"rel_path": row["rel_path"], "roi_detected": False, "was_recovered": False}
        if image is None:
            yield base
            return
        base |= {"input_height": image.shape[0], "input_width": image.shape[1]}
        e = bands.measure(image, config)
        found = bands.candidates(e, config)
        for c in found:
            out = base | {k: c[k] for k in ("method", "roi_detected", "recovery_method", "candidate_counts")} | {f"part_{k}": v for k, v in c["parts"].items()}
            out |= {"was_recovered": bool(c["recovery_method"]), "ends": c["ends"].tolist(), "beyond": []}
            for s, (side, f) in enumerate(zip(bands.SIDE_NAMES, c["lines"], strict=True)):
                out |= {f"{side}_{k}": v for k, v in (("slope", f.slope), ("intercept", f.intercept), ("valid", f.valid), ("rmse", f.rmse), ("median_residual", f.median_residual), ("inlier_ratio", f.inlier_ratio), ("x_coverage", f.span_ratio), ("max_gap_ratio", f.max_gap_ratio), ("least_third", min(f.thirds)))}
                out["beyond"] += [{"side": side, "x": x, "out": o, "inside": i} for x, o, i in bands.beyond(e, f, s, config)]
            yield out
        if not found:
            yield base

    return images.select("rel_path", "content").mapInArrow(_rows(BANDS, work), BANDS)


def crop(targets: DataFrame, margin: int = 0, rounding: tuple[int, int] | None = None) -> DataFrame:
    """targets: rel_path, content, mode, found, lines and size of the reference -> rel_path, mode, status, image (PNG, black outside the region; alpha kept opaque).

    rounding: margins above and below a region whose last row counts and whose rows are the nearest ones (the boundary mode); else rows
    are rounded outwards, and the last one doesn't count.
    """

    schema = "rel_path string, mode string, status string, image binary"

    def work(r: dict) -> Iterator[dict]:
        out = {"rel_path": r["rel_path"], "mode": r["mode"], "image": None}
        image = codec.decode(r["content"])
        if image is None:
            yield out | {"status": "unreadable_target"}
            return
        h, w = image.shape[:2]
        if (h, w) != (r["input_height"], r["input_width"]):
            yield out | {"status": "reference_size_mismatch"}
            return
        if not r["found"]:
            yield out | {"status": "no_roi"}
            return
        top, bottom = (lines.Line(slope=r[f"{s}_slope"], intercept=r[f"{s}_intercept"]) for s in ("top", "bottom"))
        first, after = lines.rasterise(top, bottom, (h, w), margin) if rounding is None else lines.rasterise_nearest(top, bottom, (h, w), *rounding)
        y = np.arange(h)[:, None]
        keep = (y >= first) & (y < after)
        image = np.where(keep if image.ndim == 2 else keep[:, :, None], image, 0).astype(image.dtype)
        if image.ndim == 3 and image.shape[2] == 4:
            image[:, :, 3] = np.iinfo(image.dtype).max
        yield out | {"status": "cropped", "image": codec.encode_png(image)}

    return targets.mapInArrow(_rows(schema, work), schema)


def label(images: DataFrame, size: int = 101, sigma: float = 10.0, threshold: int | None = None, min_area: float = 0.0, ratio: float = 0.0, class_id: int = 0) -> DataFrame:
    """images: rel_path, content -> rel_path, mask (PNG), labels (one line per polygon), error."""
    from ..functions import masks

    schema = "rel_path string, mask binary, labels array<string>, error string"

    def work(r: dict) -> Iterator[dict]:
        image = codec.decode(r["content"])
        if image is None:
            yield {"rel_path": r["rel_path"], "error": "unreadable_image"}
            return
        mask = masks.defect_mask(image, size, sigma, threshold, min_area)
        yield {"rel_path": r["rel_path"], "mask": codec.encode_png(mask), "labels": masks.label_lines(masks.polygons(mask, ratio), class_id)}

    return images.select("rel_path", "content").mapInArrow(_rows(schema, work), schema)


def brush_tasks(masks_: DataFrame, class_name: str, per_file: int = 10) -> DataFrame:
    """rel_path, mask -> rel_path, task (JSON of the annotation tool), batch. Result ids are a hash of the path, so that reruns agree."""
    from ..functions import masks

    @F.pandas_udf("array<int>")
    def code(m: pd.Series) -> pd.Series:
        return m.map(lambda x: masks.rle_encode(codec.decode(bytes(x))) if x is not None else None)

    @F.pandas_udf("struct<h:int,w:int>")
    def shape(m: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([codec.decode(bytes(x)).shape[:2] for x in m], columns=["h", "w"])

    value = F.struct(F.lit("rle").alias("format"), code("mask").alias("rle"), F.array(F.lit(class_name)).alias("brushlabels"))
    result = F.struct(
        F.substring(F.sha2("rel_path", 256), 1, 10).alias("id"), F.lit("tag").alias("from_name"), F.lit("image").alias("to_name"), F.lit("brushlabels").alias("type"), F.lit("manual").alias("origin"),
        F.col("_s.w").alias("original_width"), F.col("_s.h").alias("original_height"), F.lit(0).alias("image_rotation"), value.alias("value"),
    )
    task = F.struct(F.struct(F.col("rel_path").alias("image")).alias("data"), F.array(F.struct(F.array(result).alias("result"))).alias("annotations"))
    rows = masks_.where("mask IS NOT NULL").withColumn("_s", shape("mask"))
    numbered = exports.ranked(masks_.where("mask IS NOT NULL").select("rel_path").distinct(), "rel_path")
    return rows.select("rel_path", F.to_json(task).alias("task")).join(numbered, "rel_path").select("rel_path", "task", F.floor(F.col("rank") / per_file).cast("long").alias("batch"))
