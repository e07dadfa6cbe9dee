"""The wide report: one row per image and mode, 162 columns; what wasn't measured is blank, never zero."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The report's columns and types, in order.
BASE = """
source string, scene string, camera string, exposure string, mode string, roi_source string, reference_exposure string, is_reference boolean,
roi_reused boolean, status string, reason string, found boolean, needs_review boolean, output_written boolean, output_path string,
image_output string, input_height int, input_width int, channels int, dtype string, output_height int, output_width int,
output_origin_y int, margin int, y0 int, y1_exclusive int, roi_area_ratio double, height_left double, height_right double,
height_ratio_mean double, roi_gray_mean double, roi_gray_std double, roi_zero_fraction double, roi_saturated_fraction double,
selected_pair_count int, candidate_column_count int, empty_candidate_columns int, pair_score_mean double, anchor_x double,
height_mean_px double, height_std_px double, height_change_ratio double, pair_inlier_ratio double, gt_split string,
gt_auto_status string, gt_auto_found boolean, gt_top_mae_px double, gt_bottom_mae_px double, auto_accepted boolean,
export_eligible boolean, roi_detected boolean, roi_quality double, roi_candidate_count int, selection_method string,
fallback_used boolean, quality_components_json string, candidates_json string, fusion_sources_json string, fusion_count int,
consensus_count int, consensus_spread_px double, registration_source string, registration_correlation double,
registration_transform_json string, output_warning string"""
SIDE = """
valid boolean, point_count int, inlier_count int, inlier_ratio double, span_ratio double, slope double, angle_deg double,
intercept double, y_left double, y_right double, rmse_px double, tolerance_px double, attempt_count int, reacquired boolean,
rejection_reason string, initial_rejection_reason string, points_json string, inliers_json string, x_coverage double,
max_gap_ratio double, left_support int, center_support int, right_support int, median_residual_px double"""
PROVENANCE = """
homography_json string, detector string, run_started_utc string, parameters_json string"""
BOUNDARY = """
scene_id string, image_path string, exposure_us int, reference_image string, quality_status string, angle_diff_deg double,
roi_height_left double, roi_height_center double, roi_height_right double, height_variation_px double, top_longest_gap double,
bottom_longest_gap double, top_ransac_rmse double, bottom_ransac_rmse double, best_candidate_score double,
second_candidate_score double, candidate_score_gap double, candidate_boundary_gap_px double, ambiguous_candidate_score double,
ambiguous_boundary_gap_px double, outside_texture_top double, outside_texture_bottom double, consensus_total int,
consensus_ratio double, was_recovered boolean, recovery_method string, needs_review_reason string, manual_override boolean,
roi_margin_top int, roi_margin_bottom int, mask_rounding string, quality_details_json string, automatic_prediction_json string,
debug_path string, gt_top_rmse_px double, gt_bottom_rmse_px double, gt_top_max_error_px double, gt_bottom_max_error_px double,
gt_top_p95_error_px double, gt_bottom_p95_error_px double, gt_under_crop_pixels int, gt_over_crop_pixels int,
gt_under_crop_fraction double, gt_over_crop_fraction double, gt_mask_iou double"""


def schema() -> StructType:
    side = [x.strip() for x in SIDE.split(",")]
    sides = ", ".join(f"{s}_{x}" for s in ("top", "bottom") for x in side)
    return StructType.fromDDL(", ".join(x.replace("\n", " ").strip() for x in (BASE, sides, PROVENANCE, BOUNDARY)))


def conform(rows: DataFrame) -> DataFrame:
    """rows in the report's columns: missing ones null, others of the plan left out."""
    have = set(rows.columns)
    return rows.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema()))


def from_inspection(report: DataFrame, reference_exposure: str, margin: int, started_utc: str) -> DataFrame:
    """The report of the chained plan: geometry only where a region was found, points on reference rows alone."""
    found = F.col("found") & (F.col("status") != "skipped")
    parts = F.split("rel_path", "/")
    ref = F.coalesce("is_reference", F.lit(False))
    at = lambda side, x: F.when(found, F.col(f"{side}_slope") * x + F.col(f"{side}_intercept"))
    right = F.col("input_width") - 1
    sides = {}
    for s in ("top", "bottom"):
        sides |= {f"{s}_valid": F.when(found, F.lit(True)), f"{s}_y_left": at(s, F.lit(0)), f"{s}_y_right": at(s, right), f"{s}_rmse_px": F.when(found, F.col(f"{s}_rmse")), f"{s}_angle_deg": F.when(found, F.degrees(F.atan(f"{s}_slope")))}
    left, end = at("bottom", F.lit(0)) - at("top", F.lit(0)), at("bottom", right) - at("top", right)
    rows = report.withColumns(
        {
            "source": F.col("rel_path"), "scene": F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "/"), "exposure": F.try_element_at(parts, F.lit(-2)), "camera": F.substring_index(F.try_element_at(parts, F.lit(-1)), "_", 1),
            "roi_source": F.col("ref_id"), "reference_exposure": F.lit(reference_exposure), "margin": F.when(found, F.lit(margin)), "roi_detected": found, "height_left": left, "height_right": end,
            "height_ratio_mean": (left + end) / 2 / F.col("input_height"), "top_points_json": F.when(ref, F.get_json_object("points_json", "$[0]")), "bottom_points_json": F.when(ref, F.get_json_object("points_json", "$[1]")),
            "detector": F.concat(F.col("mode"), F.lit("_lines")), "run_started_utc": F.lit(started_utc), "image_output": F.when(F.col("output_written"), F.lit("masked")),
            **sides,
        }
    )
    return conform(rows)


def write_csv(rows: DataFrame, path: str) -> int:
    """One UTF-8 file with a byte-order mark and a header, booleans as 1 and 0, rows in order of source and mode; never over an existing file.

    Rows come to the writer a partition at a time.
    """
    n = 0
    with open(path, "x", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(rows.columns)
        for r in rows.orderBy("source", "mode").toLocalIterator():
            out.writerow(["" if v is None else int(v) if isinstance(v, bool) else v for v in r])
            n += 1
    return n


def read_csv(spark, path: str) -> DataFrame:
    """A report back in its types; a missing required column is an error."""
    raw = spark.read.option("header", "true").csv(path)
    lost = {"source", "mode", "status", "found", "is_reference"} - set(raw.columns)
    if lost:
        raise ValueError(f"report lacks {sorted(lost)}")
    flags = [f.name for f in schema() if f.dataType.simpleString() == "boolean" and f.name in raw.columns]
    return conform(raw.withColumns({c: F.col(c) == "1" for c in flags}))
