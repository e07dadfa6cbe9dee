"""The auto mode's relations: candidates of several generators as one relation, their score, the choice for each group and its state."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import first_per_group

#: What each part of a candidate's quality weighs, and the methods that count as fallbacks.
WEIGHTS = {"texture": 0.25, "edge": 0.20, "line": 0.15, "coverage": 0.10, "consistency": 0.15, "pair": 0.05, "geometry": 0.10}
FALLBACKS = ("edge_hough", "registration", "full_frame_fallback")


def union(generators: Mapping[str, DataFrame]) -> DataFrame:
    """One relation of all generators' candidates, each with its generator's name as `method`; columns that a generator lacks are null."""
    out = None
    for name, rows in generators.items():
        rows = rows.withColumn("method", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no generators")
    return out


def line_part(residual: float) -> Column:
    """Both sides' fits: exp(-rmse / residual) by inlier ratio, averaged."""
    return sum(F.exp(-F.col(f"{s}_rmse") / max(1.0, residual)) * F.col(f"{s}_inlier_ratio") for s in ("top", "bottom")) / 2


def coverage_part(min_coverage: float, max_gap: float) -> Column:
    """Both sides' support along x, less where a gap is wider than allowed."""
    one = lambda s: F.least(F.lit(1.0), F.col(f"{s}_x_coverage") / min_coverage) * F.exp(-F.greatest(F.lit(0.0), F.col(f"{s}_max_gap_ratio") - max_gap) / 0.15)
    return (one("top") + one("bottom")) / 2


def consistency_part(distances: Column, exposures: Column, height: Column) -> Column:
    """Nearness to the other exposures' lines (distances: an array, one for each anchor); nothing below two anchors, less where few exposures have one."""
    near = F.aggregate(F.transform(distances, lambda d: F.exp(-d / F.greatest(F.lit(2.0), height * 0.015))), F.lit(0.0), lambda a, x: a + x)
    n = F.size(distances)
    return F.when(n >= 2, near / n * F.least(F.lit(1.0), n / F.greatest(F.lit(1), exposures))).otherwise(F.lit(0.0))


def geometry_part() -> Column:
    change = F.coalesce("height_change_ratio", F.lit(0.0)) / 0.06
    return F.exp(-change * change / 2)


def score(parts: Mapping[str, Column]) -> Column:
    """The weighted sum of all seven parts."""
    return sum(parts[k] * w for k, w in WEIGHTS.items())


def choose(candidates: DataFrame, groups: DataFrame, key: str, min_quality: float, height: Column) -> DataFrame:
    """A row for each group: its best candidate (roi_quality, then method), or its whole frame, with state, warning and flags.

    candidates: key, method, roi_quality, lines; groups: key and what `height` needs. Nothing is ever left out of the export.
    """
    best = first_per_group(candidates, [key], [F.desc("roi_quality"), F.asc("method")]).drop("rank")
    counts = candidates.groupBy(key).agg(F.count(F.lit(1)).alias("roi_candidate_count"))
    rows = groups.join(best, key, "left").join(counts, key, "left").na.fill(0, ["roi_candidate_count"])
    none = F.col("method").isNull()
    rows = rows.withColumns({f"{s}_{k}": F.when(none, v).otherwise(F.col(f"{s}_{k}")) for s, i in (("top", F.lit(0.0)), ("bottom", height - 1.0)) for k, v in (("slope", F.lit(0.0)), ("intercept", i))})
    method = F.coalesce("method", F.lit("full_frame_fallback"))
    accepted = ~none & (F.col("roi_quality") >= min_quality)
    fallback = method.startswith("gabor_fallback") | method.isin(*FALLBACKS)
    return rows.withColumns(
        {
            "method": method,
            "found": F.lit(True),
            "needs_review": ~accepted,
            "roi_detected": ~none,
            "fallback_used": fallback,
            "status": F.when(accepted & fallback, "auto_fallback").when(accepted, "auto").when(none, "full_frame_fallback").otherwise("low_confidence"),
            "output_warning": F.when(none, "no_localized_roi_full_frame_preserved").when(~accepted, "low_quality_candidate_exported_for_review"),
        }
    )


def scaled(scale: Column, std_kernel: int, window: int, stride: int, low: float, high: float, gap: int, reach: int, residual: float, most: float) -> dict[str, Column]:
    """Analysis parameters of an image shrunk by `scale`: rounded half to even, kernels odd, frequencies inversely scaled."""
    whole = lambda x: F.bround(x * scale).cast("int")
    near = F.greatest(F.lit(1), whole(F.lit(float(gap))))
    least = F.greatest(F.lit(1.0), F.lit(residual) * scale)
    return {
        "std_kernel": F.greatest(F.lit(3), whole(F.lit(float(std_kernel)))).bitwiseOR(1),
        "fft_window": F.greatest(F.lit(8), whole(F.lit(float(window)))),
        "fft_stride": F.greatest(F.lit(1), whole(F.lit(float(stride)))),
        "fft_min_frequency": F.least(F.lit(0.45), F.lit(low) / scale),
        "fft_max_frequency": F.least(F.lit(0.5), F.lit(high) / scale),
        "texture_gap": near,
        "texture_window": F.greatest(near + 1, whole(F.lit(float(reach)))),
        "ransac_residual": least,
        "ransac_max_residual": F.greatest(least, F.lit(most) * scale),
    }
