"""Evaluation of detected boundaries against ground truth, and the case-disjoint annotation manifest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lines import boundary_metrics
from .reference import exact_total
from .regions import _rows

ACCEPTED = ("PASS", "RECOVERED", "auto", "auto_fallback", "fitted", "recovered")
METRICS = tuple(f"{s}_{m}" for s in ("top", "bottom") for m in ("mae_px", "rmse_px", "max_error_px", "p95_error_px")) + ("under_crop_pixels", "over_crop_pixels", "under_crop_fraction", "over_crop_fraction", "mask_iou")
_OUT = "source string, split string, evaluation_status string, auto_pass boolean, geometry_evaluated boolean, acceptable boolean, false_pass boolean, " + ", ".join(f"{m} double" for m in METRICS)


def scenes(report: DataFrame, truth: DataFrame, mode: str, min_iou: float = 0.98, max_under: float = 0.005, max_p95: float = 15.0) -> DataFrame:
    """One row per approved ground truth, whether or not the report has it. An accepted prediction without a region is a false pass."""
    rows = report.where((F.col("mode") == mode) & F.col("is_reference")).select("source", "status", "found", "top_slope", "top_intercept", "bottom_slope", "bottom_intercept")
    rows = rows.withColumn("key", F.lower("source")).drop("source").withColumn("known", F.lit(True))
    both = truth.where("status = 'approved' AND problem IS NULL").drop("status", "problem").withColumn("key", F.lower("source")).join(rows, "key", "left")

    def work(r: dict):
        accepted = r["status"] in ACCEPTED
        out = {"source": r["source"], "split": r["split"], "auto_pass": accepted, "geometry_evaluated": False, "acceptable": False}
        if not r["known"]:
            out["evaluation_status"] = "unavailable"
        elif not r["found"] or r["top_slope"] is None or r["bottom_slope"] is None:
            out["evaluation_status"] = "no_localized_roi"
        else:
            x = np.arange(r["width"])
            line = lambda p: np.interp(x, [q[0] for q in p], [q[1] for q in p])
            m = boundary_metrics(r["top_slope"] * x + r["top_intercept"], r["bottom_slope"] * x + r["bottom_intercept"], line(r["top"]), line(r["bottom"]), r["height"])
            good = m["mask_iou"] >= min_iou and m["under_crop_fraction"] <= max_under and max(m["top_p95_error_px"], m["bottom_p95_error_px"]) <= max_p95
            out |= m | {"evaluation_status": "evaluated", "geometry_evaluated": True, "acceptable": bool(good), "under_crop_pixels": float(m["under_crop_pixels"]), "over_crop_pixels": float(m["over_crop_pixels"])}
        yield out | {"false_pass": accepted and not out["acceptable"]}

    return both.mapInArrow(_rows(_OUT, work), _OUT)


def summary(found: DataFrame) -> DataFrame:
    """Both splits, even empty ones: counts, null-safe rates and means over evaluated scenes."""
    splits = found.sparkSession.createDataFrame([("tune",), ("validation",)], "split string")
    s = found.groupBy("split").agg(
        F.count(F.lit(1)).alias("approved_gt_scenes"), F.count_if("geometry_evaluated").alias("geometry_evaluated"), F.count_if("auto_pass").alias("automatic_pass_count"), F.count_if("false_pass").alias("false_pass_count"),
        *(F.avg(F.when(F.col("geometry_evaluated"), F.col(m))).alias(f"mean_{m}") for m in METRICS),
    )
    counts = ["approved_gt_scenes", "geometry_evaluated", "automatic_pass_count", "false_pass_count"]
    s = F.broadcast(splits).join(s, "split", "left").na.fill(0, counts)
    rate = lambda a, b: F.try_divide(F.col(a), F.expr(f"nullif({b}, 0)"))
    return s.withColumns({"scene_pass_rate": rate("automatic_pass_count", "approved_gt_scenes"), "false_pass_rate": rate("false_pass_count", "automatic_pass_count"), "false_pass_per_gt_scene": rate("false_pass_count", "approved_gt_scenes")})


def manifest(report: DataFrame, mode: str, validation_count: int, review_only: bool = True) -> DataFrame:
    """Reference rows to annotate, split so that no case stands in both splits and validation gets exactly validation_count rows."""
    rows = report.where((F.col("mode") == mode) & F.col("is_reference"))
    rows = rows.where("needs_review") if review_only else rows
    rows = rows.select("source", F.lower(F.substring_index(F.split("source", "/")[0], "-", 1)).alias("case_key"), F.col("input_height").alias("height"), F.col("input_width").alias("width"))
    sizes = [(r.case_key, r.n) for r in rows.groupBy("case_key").agg(F.count(F.lit(1)).alias("n")).collect()]  # a row for each case
    if not 0 < validation_count < sum(n for _, n in sizes):
        raise ValueError("validation_count: more than none and fewer than all rows")
    chosen = exact_total(sizes, validation_count)
    if chosen is None:
        raise ValueError("no set of cases has exactly that many rows")
    return rows.select("source", F.when(F.col("case_key").isin(chosen), "validation").otherwise("tune").alias("split"), F.lit("pending").alias("status"), "height", "width", F.lit(None).cast("string").alias("top_points_json"), F.lit(None).cast("string").alias("bottom_points_json"))
