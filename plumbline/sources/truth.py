"""Ground truth and manual overrides: files to rows, each row checked; what fails a check comes back with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POINTS = "array<array<double>>"
TRUTH_CSV = "source string, split string, status string, height int, width int, top_points_json string, bottom_points_json string"


def _line(p: str, width: str, height: str) -> Column:
    """Finite pairs, x strictly rising from 0 to width - 1, y within 0..height."""
    x = F.transform(F.col(p), lambda q: q[0])
    rising = F.forall(F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1))), lambda i: F.try_element_at(x, i.cast("int")) < F.try_element_at(x, (i + 1).cast("int")))
    sound = F.forall(F.col(p), lambda q: (F.size(q) == 2) & ~F.isnan(q[0]) & ~F.isnan(q[1]) & q[1].between(0, F.col(height)))
    return (F.size(p) >= 2) & sound & rising & (F.element_at(x, 1) == 0) & (F.element_at(x, -1) == F.col(width) - 1)


def checked(rows: DataFrame) -> DataFrame:
    """rows: source, split, status, height, width, top, bottom -> with `problem`, null where all is well."""
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lower("source")))
    approved = F.col("status") == "approved"
    crossing = F.element_at(F.col("top"), 1)[1] >= F.element_at(F.col("bottom"), 1)[1]
    crossing = crossing | (F.element_at(F.col("top"), -1)[1] >= F.element_at(F.col("bottom"), -1)[1])
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return rows.withColumn("_n", n).withColumn(
        "problem",
        F.when(F.coalesce(F.col("source"), F.lit("")) == "", "missing_source").when(F.col("_n") > 1, "duplicate_source").when(no(F.col("split").isin("tune", "validation")), "unknown_split")
        .when(no(F.col("status").isin("pending", "approved")), "unknown_status").when(approved & no((F.col("height") > 0) & (F.col("width") > 0)), "bad_shape")
        .when(approved & no(_line("top", "width", "height")), "bad_top").when(approved & no(_line("bottom", "width", "height")), "bad_bottom").when(approved & no(~crossing), "crossing_lines"),
    ).drop("_n")


def read_truth_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", "true").option("mode", "FAILFAST").schema(TRUTH_CSV).csv(path)
    return checked(raw.select("source", "split", "status", "height", "width", F.from_json("top_points_json", POINTS).alias("top"), F.from_json("bottom_points_json", POINTS).alias("bottom")))


def read_truth_json(spark: SparkSession, path: str) -> DataFrame:
    """An object by source: shape, split, status, and lines or four corners (TL, TR, BR, BL)."""
    kind = f"map<string,struct<shape:array<int>,split:string,status:string,corners:{POINTS},top_points:{POINTS},bottom_points:{POINTS}>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("source", "v"))
    corner = lambda a, b: F.when(F.size("v.corners") == 4, F.array(F.col("v.corners")[a], F.col("v.corners")[b]))
    rows = raw.select(
        "source", F.col("v.split").alias("split"), F.coalesce("v.status", F.lit("approved")).alias("status"), F.col("v.shape")[0].alias("height"), F.col("v.shape")[1].alias("width"),
        F.coalesce("v.top_points", corner(0, 1)).alias("top"), F.coalesce("v.bottom_points", corner(3, 2)).alias("bottom"),
    )
    return checked(rows)


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """An object path -> mode -> {shape, top_y, bottom_y}: rel_path, mode, height, width, slopes and intercepts."""
    kind = "map<string,map<string,struct<shape:array<int>,top_y:array<double>,bottom_y:array<double>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("rel_path", "m")).select("rel_path", F.explode("m").alias("mode", "v"))
    w = F.greatest(F.col("v.shape")[1] - 1, F.lit(1))
    line = lambda s: ((F.col(f"v.{s}_y")[1] - F.col(f"v.{s}_y")[0]) / w, F.col(f"v.{s}_y")[0])
    columns = [c.alias(f"{s}_{k}") for s in ("top", "bottom") for k, c in zip(("slope", "intercept"), line(s), strict=True)]
    return raw.select("rel_path", "mode", F.col("v.shape")[0].alias("height"), F.col("v.shape")[1].alias("width"), *columns)


def apply_overrides(found: DataFrame, overrides: DataFrame) -> DataFrame:
    """Detected rows with manual lines instead where there are any; one for another shape is fatal."""
    names = [f"{s}_{k}" for s in ("top", "bottom") for k in ("slope", "intercept")]
    o = overrides.select("rel_path", "mode", F.col("height").alias("_h"), F.col("width").alias("_w"), *(F.col(c).alias(f"_{c}") for c in names))
    rows = found.join(o, ["rel_path", "mode"], "left")
    given = F.col("_h").isNotNull()
    wrong = given & ((F.col("_h") != F.col("input_height")) | (F.col("_w") != F.col("input_width")))
    status = F.when(wrong, F.raise_error(F.concat(F.lit("override of another shape: "), F.col("rel_path"))).cast("string")).when(given, "manual").otherwise(F.col("status"))
    return rows.withColumns({"status": status, "found": F.col("found") | given, "needs_review": F.col("needs_review") & ~given, **{c: F.coalesce(f"_{c}", c) for c in names}}).drop("_h", "_w", *(f"_{c}" for c in names))


def overrides_from_truth(truth: DataFrame, modes: list[str]) -> DataFrame:
    """Approved two-point lines as overrides of each mode; lines of more points are for evaluation alone, and fatal here."""
    rows = truth.where("status = 'approved' AND problem IS NULL")
    two = (F.size("top") == 2) & (F.size("bottom") == 2)
    known = F.when(two, F.col("source")).otherwise(F.raise_error(F.concat(F.lit("more than two points in a line: "), F.col("source"))).cast("string"))
    w = F.greatest(F.col("width") - 1, F.lit(1))
    lines = [c for s in ("top", "bottom") for c in (((F.col(s)[1][1] - F.col(s)[0][1]) / w).alias(f"{s}_slope"), F.col(s)[0][1].alias(f"{s}_intercept"))]
    return rows.select(known.alias("rel_path"), F.explode(F.array(*map(F.lit, modes))).alias("mode"), "height", "width", *lines)
