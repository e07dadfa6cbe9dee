"""The chained plan: scan, reference assignment, detection on references, reuse on their targets, masks, labels, exports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines
from ..operators import catalog, reference, regions
from ..sources import images
from ..sources.tables import kept, small


@dataclass(frozen=True)
class Options:
    reference_exposure: str = "10000us"
    prefix: str = "mono_"
    extensions: tuple[str, ...] = (".png", ".bmp", ".jpg", ".jpeg", ".tif", ".tiff")
    modes: tuple[str, ...] = ("std",)
    margin: int = 0
    lines: lines.Config = field(default_factory=lines.Config)


@dataclass
class Result:
    report: DataFrame  # a row for each image and mode, skipped ones too
    crops: DataFrame  # rel_path, mode, status, image
    labels: DataFrame  # rel_path, mask, labels, error


def run(spark: SparkSession, root: str, options: Options | None = None) -> Result:
    o = options or Options()
    files = images.scan(spark, root).where(catalog.scan_predicate(None, o.prefix, list(o.extensions)))
    meta = files.select("rel_path", "scene", F.lower("camera").alias("camera"), F.lower("name").alias("name"), F.lower("exposure").alias("exposure"))
    meta = meta.withColumn("scene", F.regexp_replace("scene", "/[^/]*us$", ""))
    assigned = reference.assign_references(meta, ["scene", "camera"], "name", "exposure", o.reference_exposure.lower(), "rel_path")
    assigned = kept(assigned)
    jobs = assigned.where("ref_id IS NOT NULL")
    content = files.select("rel_path", "content")  # joined to narrow rows, whose side moves where it is small
    refs = content.join(small(kept(jobs.select(F.col("ref_id").alias("rel_path")).distinct())), "rel_path", "left_semi")
    found = kept(regions.detect(refs, list(o.modes), o.lines))
    targets = jobs.select("rel_path", "ref_id").join(found.withColumnRenamed("rel_path", "ref_id"), "ref_id")
    crops = regions.crop(content.join(small(targets.select("rel_path", "mode", "found", "input_height", "input_width", *(f"{s}_{k}" for s in ("top", "bottom") for k in ("slope", "intercept")))), "rel_path"), o.margin)
    crops = kept(crops)
    done = targets.join(crops.select("rel_path", "mode", F.col("status").alias("output")), ["rel_path", "mode"])
    bad = F.col("output").isin("unreadable_target", "reference_size_mismatch")
    done = done.withColumns(
        {
            "is_reference": F.col("rel_path") == F.col("ref_id"),
            "roi_reused": F.col("rel_path") != F.col("ref_id"),
            "status": F.when(bad, "skipped").otherwise(F.col("status")),
            "reason": F.when(bad, F.col("output")).otherwise(F.col("reason")),
            "output_written": F.col("output") == "cropped",
        }
    ).drop("output")
    rejects = assigned.where("ref_id IS NULL").select("rel_path", "reason", F.lit("skipped").alias("status"), F.lit(True).alias("needs_review"), F.explode(F.array(*map(F.lit, o.modes))).alias("mode"))
    labels = regions.label(crops.where("image IS NOT NULL").select(F.concat_ws("/", "mode", "rel_path").alias("rel_path"), F.col("image").alias("content")))
    return Result(done.unionByName(rejects, allowMissingColumns=True), crops, labels)
