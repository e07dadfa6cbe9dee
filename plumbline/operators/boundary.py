"""Boundary lines as relations: geometry, rescaling, rectification, vetoes, outside checks, votes, ambiguity and final states.

A line is a struct or pair of columns `<side>_slope`, `<side>_intercept`; a candidate is a row with both sides' lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fits

SIDES = ("top", "bottom")


def at(side: str, x: Column | float) -> Column:
    """The row of a side's line at x."""
    return F.col(f"{side}_intercept") + F.col(f"{side}_slope") * x


def thickness(x: Column | float) -> Column:
    """The rows between both lines at x; lines are subtracted first, so that it is the same everywhere between parallel ones."""
    return F.col("bottom_intercept") - F.col("top_intercept") + (F.col("bottom_slope") - F.col("top_slope")) * x


def endpoints(width: Column) -> Column:
    """Rows of top and bottom at the first and last column."""
    return F.array(*(at(s, x) for s in SIDES for x in (F.lit(0.0), width - 1)))


def distance(a: str, b: str) -> Column:
    """The greatest distance of two arrays of endpoints."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def pair_quality(rows: DataFrame, height: Column, width: Column) -> DataFrame:
    """Mean and deviation of the thickness over all columns (closed forms of a line's), and its change as a part of the height."""
    slope = F.col("bottom_slope") - F.col("top_slope")
    first = F.col("bottom_intercept") - F.col("top_intercept")
    return rows.withColumns(
        {
            "height_mean_px": first + slope * (width - 1) / 2,
            "height_std_px": F.abs(slope) * F.sqrt((width * width - 1) / 12.0),
            "height_change_ratio": F.abs(slope) * (width - 1) / height,
        }
    )


def support_overlap(rows: DataFrame, keys: list[str], side: Column, x: str) -> DataFrame:
    """Supporting positions that both sides (true and false of `side`) share, those of either, and their ratio; keys with one side alone are left out."""
    s = rows.groupBy(*keys).agg(F.collect_set(F.when(side, F.col(x))).alias("_a"), F.collect_set(F.when(~side, F.col(x))).alias("_b")).where((F.size("_a") > 0) & (F.size("_b") > 0))
    common, either = F.size(F.array_intersect("_a", "_b")).cast("long"), F.size(F.array_union("_a", "_b")).cast("long")
    return s.select(*keys, common.alias("common"), either.alias("either"), (common / either).alias("pair_inlier_ratio"))


def pair_reason(height: Column, width: Column, max_tilt: float, min_height: float, max_height: float, max_change: float, min_support: float) -> Column:
    """The first veto of a fitted pair, or null. Columns: top_valid, bottom_valid, the lines, pair_inlier_ratio."""
    ends = [(at("top", x), at("bottom", x)) for x in (F.lit(0.0), width - 1)]
    thick = F.least(*(F.least(b, height) - F.greatest(t, F.lit(0.0)) for t, b in ends))
    tall = F.greatest(*(b - t for t, b in ends))
    steep = F.greatest(F.abs("top_slope"), F.abs("bottom_slope"))
    change = F.abs(F.col("bottom_slope") - F.col("top_slope")) * (width - 1) / height
    return fits.first_reason(
        {
            "insufficient_consistent_points": ~(F.col("top_valid") & F.col("bottom_valid")),
            "tilt_exceeds_limit": steep > F.tan(F.radians(F.lit(max_tilt))),
            "crossed_or_outside_boundaries": thick < F.greatest(F.lit(1.0), height * min_height),
            "height_exceeds_limit": tall > height * max_height,
            "excessive_height_change": change > max_change,
            "insufficient_joint_support": F.col("pair_inlier_ratio") < min_support,
        }
    )


def rescale(side: str, sx: Column, sy: Column) -> tuple[Column, Column]:
    """A side's line found on an image sx, sy times as wide and high, on the original's pixel centres: slope, intercept."""
    slope, intercept = F.col(f"{side}_slope"), F.col(f"{side}_intercept")
    return slope * sx / sy, (intercept + 0.5 + slope * (sx - 1) / 2) / sy - 0.5


def rescale_point(x: Column, s: Column) -> Column:
    return (x + 0.5) / s - 0.5


def rectified_size(width: Column, margin: float = 0.0) -> tuple[Column, Column]:
    """Width and height of the upright image of a region: its longer opposite sides, at least 2."""
    right = width - 1
    top = [at("top", x) - margin for x in (F.lit(0.0), right)]
    bottom = [at("bottom", x) + margin - 1 for x in (F.lit(0.0), right)]
    along = F.greatest(*(F.sqrt(right * right + (b - a) * (b - a)) for a, b in (top, bottom)))
    across = F.greatest(*(F.abs(b - t) for t, b in zip(top, bottom, strict=True)))
    size = lambda x: F.greatest(F.lit(2), F.bround(x).cast("int") + 1)
    return size(along), size(across)


def parallel(rows: DataFrame, keys: list[str], x: str = "x", y0: str = "y0", y1: str = "y1") -> DataFrame:
    """A band of constant thickness through paths (x, top, bottom): the middle's least-squares line and the median thickness."""
    middle = (F.col(y0) + F.col(y1)) / 2
    g = rows.groupBy(*keys).agg(F.regr_slope(middle, F.col(x)).alias("s"), F.regr_intercept(middle, F.col(x)).alias("i"), F.median(F.col(y1) - F.col(y0)).alias("thickness"))
    half = F.col("thickness") / 2
    return g.select(*keys, "thickness", *(c for s, sign in (("top", -1), ("bottom", 1)) for c in (F.col("s").alias(f"{s}_slope"), (F.col("i") + sign * half).alias(f"{s}_intercept"))))


def unlike(candidates: DataFrame, scene: list[str], order: list[Column], ends: str = "ends", apart: float = 1.0) -> DataFrame:
    """Candidates in order, without those within `apart` of one kept before. A scene has a few candidates."""
    w = Window.partitionBy(*scene).orderBy(*order)
    row = F.struct(*(F.col(f"`{c}`") for c in candidates.columns))
    listed = candidates.withColumn("_n", F.row_number().over(w)).groupBy(*scene).agg(F.array_sort(F.collect_list(F.struct("_n", row.alias("row")))).alias("_all"))
    near = lambda kept, x: F.exists(kept, lambda y: F.array_max(F.zip_with(y["row"][ends], x["row"][ends], lambda p, q: F.abs(p - q))) <= apart)
    kept = F.aggregate("_all", F.slice("_all", 1, 0), lambda acc, x: F.when(near(acc, x), acc).otherwise(F.concat(acc, F.array(x))))
    return listed.select(F.explode(kept).alias("_k")).select("_k.row.*")


def ambiguity(candidates: DataFrame, scene: list[str], quality: str, ends: str, score_gap: float, boundary_gap: float) -> DataFrame:
    """Each scene's best candidate, its best unlike rival, and whether one of near quality lies far away."""
    w = Window.partitionBy(*scene)
    best = F.max_by(F.struct(F.col(quality).alias("q"), F.col(ends).alias("e")), F.col(quality)).over(w)
    rows = candidates.withColumn("_best", best).withColumn("_gap", F.array_max(F.zip_with(F.col("_best.e"), F.col(ends), lambda a, b: F.abs(a - b))))
    rival = F.col("_gap") > 1.0
    near = rival & (F.col("_best.q") - F.col(quality) < score_gap) & (F.col("_gap") > boundary_gap)
    out = rows.groupBy(*scene).agg(
        F.max(quality).alias("best_score"), F.max(F.when(rival, F.col(quality))).alias("second_score"), F.max_by(F.when(rival, F.col("_gap")), F.when(rival, F.col(quality))).alias("boundary_gap"), F.bool_or(near).alias("ambiguous")
    )
    return out.withColumn("score_gap", F.col("best_score") - F.col("second_score"))


def votes(best: DataFrame, anchors: DataFrame, scene: list[str], within: float) -> DataFrame:
    """best: a row per scene with `ends`; anchors: accepted lines of its exposures with `vote` (ends) -> consensus_count, consensus_total."""
    near = F.array_max(F.zip_with("ends", "vote", lambda a, b: F.abs(a - b))) <= within
    n = best.select(*scene, "ends").join(anchors, scene).groupBy(*scene).agg(F.count_if(near).alias("consensus_count"), F.count("vote").alias("votes"))
    return best.join(n, scene, "left").na.fill(0, ["consensus_count", "votes"])


def outside_check(strips: DataFrame, keys: list[str], x: str, out: str, inside: str, min_energy: float, min_inside: float, ratio: float, min_fraction: float, min_run: int, min_valid: float) -> DataFrame:
    """Texture beyond a line, strip by strip (null where the strip can't tell): P90 of out / inside, share and longest run of flags, clipped, unavailable."""
    usable = F.col(out).isNotNull() & F.col(inside).isNotNull()
    r = F.when(usable, F.col(out) / F.greatest(F.col(inside), F.lit(max(min_inside, 1e-6))))
    rows = strips.withColumns({"_r": r, "_f": F.coalesce((F.col(out) >= min_energy) & (r >= ratio), F.lit(False)), "_u": usable})
    w = Window.partitionBy(*keys).orderBy(x)
    # a run of flags: flagged strips with the same number of unflagged ones before
    rows = rows.withColumn("_run", F.sum((~F.col("_f")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = rows.groupBy(*keys, "_run").agg(F.count_if("_f").alias("_len"), F.count_if("_u").alias("_usable"), F.count(F.lit(1)).alias("_n"), F.collect_list("_r").alias("_rs"))
    g = per.groupBy(*keys).agg(F.max("_len").alias("longest_run"), F.sum("_len").alias("_flags"), F.sum("_usable").alias("_usable"), F.sum("_n").alias("_n"), F.flatten(F.collect_list("_rs")).alias("_rs"))
    rs = F.array_sort("_rs")
    place = (F.size(rs) - 1) * 0.9
    low = F.floor(place).cast("int")
    low_value, high_value = F.try_element_at(rs, low + 1), F.try_element_at(rs, F.least(low + 2, F.size(rs)))
    p90 = F.when(F.size(rs) > 0, low_value + (high_value - low_value) * (place - low))
    share = F.col("_flags") / F.greatest(F.lit(1), F.col("_usable"))
    return g.select(
        *keys, p90.alias("ratio"), share.alias("flag_fraction"), "longest_run", (F.col("_usable") / F.col("_n") < min_valid).alias("unavailable"), ((share >= min_fraction) | (F.col("longest_run") >= min_run)).alias("clipped")
    )


def assess(rows: DataFrame, q: dict, height: Column, width: Column) -> DataFrame:
    """All failing gates of a scene's best candidate, and its state.

    Columns: the lines; for each side <side>_valid, _inlier_ratio, _x_coverage, _max_gap_ratio, _rmse, _median_residual, _least_third, _unavailable,
    _clipped; ambiguous, consensus_count, consensus_total, roi_quality, was_recovered. q: the limits by name (see sources.config).
    """
    xs = (F.lit(0.0), (width - 1) / 2, width - 1)
    tops, bottoms = [at("top", x) for x in xs], [at("bottom", x) for x in xs]
    thick = [thickness(x) for x in xs]
    angles = [F.degrees(F.atan(F.col(f"{s}_slope"))) for s in SIDES]
    variation = F.greatest(*thick) - F.least(*thick)
    tests = {
        "INVALID_GEOMETRY": fits.bad(F.greatest(*tops, *bottoms)) | (F.least(*thick) <= 0) | (F.least(*tops) < 0) | (F.greatest(*bottoms) >= height),
        "IMPLAUSIBLE_HEIGHT": (F.least(*thick) < height * q["min_height_ratio"]) | (F.greatest(*thick) > height * q["max_height_ratio"]),
        "EXCESSIVE_TILT": F.greatest(*(F.abs(a) for a in angles)) > q["max_tilt_deg"],
        "LARGE_ANGLE_DIFFERENCE": F.abs(angles[0] - angles[1]) > q["max_angle_diff_deg"],
        "LARGE_HEIGHT_VARIATION": variation > q["max_height_variation_px"],
    }
    for s in SIDES:
        c = lambda k, s=s: F.col(f"{s}_{k}")
        up = s.upper()
        tests |= {
            f"RANSAC_FAILED_{up}": ~c("valid"),
            f"LOW_INLIER_RATIO_{up}": fits.bad(c("inlier_ratio")) | (c("inlier_ratio") < q["min_inlier_ratio"]),
            f"LOW_X_COVERAGE_{up}": fits.bad(c("x_coverage")) | (c("x_coverage") < q["min_x_coverage"]),
            f"LONG_UNSUPPORTED_GAP_{up}": fits.bad(c("max_gap_ratio")) | (c("max_gap_ratio") > q["max_gap_ratio"]),
            f"HIGH_RANSAC_RMSE_{up}": fits.bad(c("rmse")) | (c("rmse") > q["max_rmse_px"]),
            f"HIGH_MEDIAN_RESIDUAL_{up}": fits.bad(c("median_residual")) | (c("median_residual") > q["max_median_residual_px"]),
            f"MISSING_THIRD_SUPPORT_{up}": c("least_third") < q["min_third_support"],
            f"OUTSIDE_CHECK_UNAVAILABLE_{up}": c("unavailable"),
            f"FABRIC_OUTSIDE_{up}": c("clipped"),
        }
    share = F.when(F.col("consensus_total") > 0, F.col("consensus_count") / F.col("consensus_total")).otherwise(0.0)
    tests |= {
        "AMBIGUOUS_CANDIDATES": F.col("ambiguous"),
        "LOW_MULTI_EXPOSURE_CONSENSUS": (F.col("consensus_total") > 1) & (share < q["min_consensus_ratio"]),
        "LOW_BOUNDARY_SCORE": fits.bad(F.col("roi_quality")) | (F.col("roi_quality") < q["min_score"]),
    }
    reasons = fits.gates(tests)
    out = rows.withColumns({"_reasons": reasons, "roi_height_left": thick[0], "roi_height_center": thick[1], "roi_height_right": thick[2], "height_variation_px": variation, "angle_diff_deg": F.abs(angles[0] - angles[1]), "consensus_ratio": share})
    out = out.withColumns({"needs_review_reason": F.array_join("_reasons", ";"), "quality_status": fits.status(F.col("_reasons"), F.col("was_recovered"))})
    return out.drop("_reasons")


def exportable(found: Column, needs_review: Column, allow_review: Column) -> Column:
    """Whether an image is exported: a found region that needs no review, or may be shown with it."""
    return F.coalesce(found, F.lit(False)) & (~F.coalesce(needs_review, F.lit(False)) | F.coalesce(allow_review, F.lit(False)))


def full_frame(rows: DataFrame, height: Column) -> DataFrame:
    """Scenes without a candidate keep their whole frame: level lines at the first and last row, nothing fitted."""
    lost = F.col("top_slope").isNull() | F.col("bottom_slope").isNull()
    keep = {f"{s}_{k}": F.when(lost, v).otherwise(F.col(f"{s}_{k}")) for s, i in (("top", F.lit(0.0)), ("bottom", height - 1.0)) for k, v in (("slope", F.lit(0.0)), ("intercept", i))}
    return rows.withColumn("fallback_used", lost).withColumns(keep)


PREDICTION = "struct<top_line:struct<slope:double,intercept:double>,bottom_line:struct<slope:double,intercept:double>,quality_status:string,roi_detected:boolean,roi_margin_top:double,roi_margin_bottom:double,mask_rounding:string>"


def prediction(rows: DataFrame) -> Column:
    """The prediction that a report row stands for: its snapshot, else one made of its numbers; null for manual rows and rows without lines."""
    have = set(rows.columns)
    text = lambda k: F.nullif(F.col(k).cast("string"), F.lit("")) if k in have else F.lit(None).cast("string")
    number = lambda *ks: F.coalesce(*(text(k).cast("double") for k in ks), F.lit(0.0))
    lines = [F.struct(text(f"{s}_slope").cast("double").alias("slope"), text(f"{s}_intercept").cast("double").alias("intercept")).alias(f"{s}_line") for s in SIDES]
    made = F.struct(
        *lines, F.coalesce(text("quality_status"), text("status")).alias("quality_status"), F.coalesce(F.coalesce(text("roi_detected"), text("found")) == "1", F.lit(False)).alias("roi_detected"),
        number("roi_margin_top", "margin").alias("roi_margin_top"), number("roi_margin_bottom", "margin").alias("roi_margin_bottom"), F.coalesce(text("mask_rounding"), F.lit("floor_ceil_exclusive")).alias("mask_rounding"),
    )
    whole = F.lit(True)
    for s in SIDES:
        for k in ("slope", "intercept"):
            whole = whole & text(f"{s}_{k}").isNotNull()
    manual = F.coalesce((text("manual_override") == "1") | (text("status") == "manual"), F.lit(False))
    return F.coalesce(F.from_json(text("automatic_prediction_json"), PREDICTION), F.when(~manual & whole, made))
