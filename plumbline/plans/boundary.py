"""The boundary mode as a plan: candidates of every exposure, votes of those that pass alone, scores, gates and states of each reference, crops of its targets.

Images are read and measured in one pass that moves no bytes; all that follows works on narrow rows: a few candidates for each image.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boundary, catalog, reference, regions
from ..sources import images
from ..sources.tables import kept, small

PARTS = ("boundary", "line", "coverage", "consensus", "geometry")


@dataclass
class Result:
    scenes: DataFrame  # a row for each reference: lines, state, reasons, diagnostics
    candidates: DataFrame  # a row for each candidate of each image
    report: DataFrame  # a row for each image: its scene's state and whether it was written
    crops: DataFrame  # rel_path, mode, status, image


def _quality(rows: DataFrame, config: dict, agreement) -> DataFrame:
    weights = config["quality"]["weights"]
    parts = {k: agreement if k == "consensus" else F.col(f"part_{k}") for k in PARTS}
    return rows.withColumn("roi_quality", sum(parts[k] * (w / sum(weights)) for k, w in zip(PARTS, weights, strict=True)))


def judged(rows: DataFrame, config: dict, key: str) -> DataFrame:
    """The best candidate of each key with its outside check, ambiguity and gates. rows: candidates with roi_quality, consensus_count and consensus_total."""
    o, q = config["outside"], config["quality"] | config["pair"]
    best = catalog.first_per_group(rows.where("method IS NOT NULL"), [key], [F.desc("roi_quality"), F.asc("method")]).drop("rank")
    strips = best.select(key, F.explode("beyond").alias("b")).select(key, "b.*")
    checked = boundary.outside_check(strips, [key, "side"], "x", "out", "inside", o["min_energy"], o["min_inside_energy"], o["ratio_threshold"], o["min_bin_fraction"], o["min_adjacent_bins"], o["min_valid_fraction"])
    sides = checked.groupBy(key).agg(*(F.max(F.when(F.col("side") == s, F.col(c))).alias(n) for s in boundary.SIDES for c, n in (("unavailable", f"{s}_unavailable"), ("clipped", f"{s}_clipped"), ("ratio", f"outside_texture_{s}"))))
    rivals = boundary.ambiguity(rows.where("method IS NOT NULL"), [key], "roi_quality", "ends", q["ambiguity_score_gap"], q["ambiguity_boundary_gap_px"])
    found = best.join(sides, key).join(rivals, key)
    return boundary.assess(found, q, F.col("input_height"), F.col("input_width"))


def run(spark: SparkSession, root: str, config: dict, reference_exposure: str = "10000us", prefix: str = "mono_", extensions: tuple[str, ...] = (".png", ".bmp", ".jpg", ".jpeg", ".tif", ".tiff"), fusion_exposures: int = 0) -> Result:
    files = images.scan(spark, root).where(catalog.scan_predicate(None, prefix, list(extensions)))
    meta = files.select("rel_path", "scene", "exposure_us", F.lower("camera").alias("camera"), F.lower("name").alias("name"), F.lower("exposure").alias("exposure"))
    meta = meta.withColumn("scene", F.regexp_replace("scene", "/[^/]*us$", ""))
    assigned = kept(reference.assign_references(meta, ["scene", "camera"], "name", "exposure", reference_exposure.lower(), "rel_path").join(meta.select("rel_path", "exposure_us"), "rel_path"))
    jobs = assigned.where("ref_id IS NOT NULL").select("rel_path", "ref_id", "exposure_us")
    voters = catalog.evenly_spaced(jobs, ["ref_id"], F.col("rel_path") == F.col("ref_id"), catalog.exposure_order(), fusion_exposures) if fusion_exposures else jobs
    found = kept(regions.detect_bands(files.select("rel_path", "content").join(small(kept(voters.select("rel_path"))), "rel_path", "left_semi"), config))
    sizes = found.select("rel_path", "input_height", "input_width").distinct()

    # each exposure by itself: what passes all gates alone votes with its lines
    alone = _quality(found, config, F.lit(0.0)).withColumns({"consensus_count": F.lit(0), "consensus_total": F.lit(0)})
    passed = judged(alone, config, "rel_path").where("quality_status <> 'NEEDS_REVIEW' AND roi_detected").select("rel_path", F.col("ends").alias("vote"))
    refs = jobs.select(F.col("ref_id").alias("rel_path")).distinct().join(sizes, "rel_path")
    same = voters.join(sizes, "rel_path").join(refs.select(F.col("rel_path").alias("ref_id"), F.col("input_height").alias("_h"), F.col("input_width").alias("_w")), "ref_id").where("input_height = _h AND input_width = _w")
    total = same.groupBy("ref_id").agg(F.count(F.lit(1)).cast("int").alias("consensus_total"), F.to_json(F.array_sort(F.collect_list("rel_path"))).alias("fusion_sources_json"))  # a scene has a few exposures
    anchors = kept(same.join(passed, "rel_path").select(F.col("ref_id").alias("rel_path"), "vote"))

    # the reference's candidates with their agreement with the votes
    near = config["quality"]["consensus_distance_px"]
    of = found.join(refs.select("rel_path"), "rel_path", "left_semi")
    gap = boundary.distance("ends", "vote")
    agreed = of.join(anchors, "rel_path").groupBy("rel_path", "method").agg(F.avg(F.exp(-gap / near)).alias("agreement"), F.count_if(gap <= near).cast("int").alias("consensus_count"), F.count(F.lit(1)).alias("votes"))
    scored = of.join(agreed, ["rel_path", "method"], "left").join(total.withColumnRenamed("ref_id", "rel_path"), "rel_path").na.fill(0, ["consensus_count"])
    scored = _quality(scored, config, F.when(F.col("votes") >= 2, F.col("agreement")).otherwise(0.0))
    states = judged(scored, config, "rel_path")
    scenes = of.groupBy("rel_path").agg(F.max("input_height").alias("input_height"), F.max("input_width").alias("input_width"), F.count("method").alias("roi_candidate_count"))
    scenes = scenes.where("input_height IS NOT NULL").join(states.drop("input_height", "input_width", "beyond"), "rel_path", "left")
    scenes = boundary.full_frame(scenes, F.col("input_height").cast("double"))
    none = F.col("method").isNull()
    scenes = scenes.withColumns(
        {
            "quality_status": F.when(none, "NEEDS_REVIEW").otherwise(F.col("quality_status")),
            "needs_review_reason": F.when(none, "RANSAC_FAILED_TOP;RANSAC_FAILED_BOTTOM").otherwise(F.col("needs_review_reason")),
            "method": F.coalesce("method", F.lit("full_frame_preserved")),
            "roi_detected": F.coalesce("roi_detected", F.lit(False)),
            "was_recovered": F.coalesce("was_recovered", F.lit(False)),
        }
    )
    scenes = kept(scenes.withColumns({"found": F.lit(True), "needs_review": F.col("quality_status") == "NEEDS_REVIEW"}).withColumn("export_eligible", boundary.exportable(F.col("found"), F.col("needs_review"), F.lit(True))))

    mask = config["mask"]
    cut = scenes.select(F.col("rel_path").alias("ref_id"), "found", "input_height", "input_width", *(f"{s}_{k}" for s in boundary.SIDES for k in ("slope", "intercept")))
    targets = kept(jobs.select("rel_path", "ref_id").join(cut, "ref_id").drop("ref_id").withColumn("mode", F.lit("gabor_boundary")))
    crops = kept(regions.crop(files.select("rel_path", "content").join(small(targets), "rel_path"), rounding=(mask["margin_top"], mask["margin_bottom"])))
    done = assigned.join(crops.select("rel_path", "status"), "rel_path", "left").join(scenes.select(F.col("rel_path").alias("ref_id"), "quality_status", "needs_review", "needs_review_reason", "export_eligible", "method"), "ref_id", "left")
    bad = F.when(F.col("status").isin("unreadable_target", "reference_size_mismatch"), F.col("status"))
    why = F.coalesce("reason", F.when(F.col("quality_status").isNull(), "unreadable_reference"), bad)
    report = done.select(
        "rel_path", "ref_id", F.when(why.isNotNull(), "skipped").otherwise(F.col("quality_status")).alias("status"), F.coalesce(why, F.nullif("needs_review_reason", F.lit(""))).alias("reason"),
        (why.isNotNull() | F.coalesce("needs_review", F.lit(True))).alias("needs_review"), (why.isNull() & (F.col("status") == "cropped")).alias("output_written"), "export_eligible",
    )
    return Result(scenes, found, report, crops)
