"""Line fits, their statistics, gates and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_fit(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least squares for each group and vertical residuals: slope, intercept, n, rmse, median_residual."""
    line = rows.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    r = rows.join(line, keys).withColumn("_r", F.col(y) - F.col("slope") * F.col(x) - F.col("intercept"))
    stats = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("_r") * F.col("_r"))).alias("rmse"), F.median(F.abs("_r")).alias("median_residual"))
    return line.join(stats, keys)


def retry_ladder(rows: DataFrame, keys: list[str], value: str, tolerances: list[float], min_ratio: float) -> DataFrame:
    """The first tolerance under which enough of a group lies within it of the median: keys, attempt, tolerance, inliers."""
    centre = rows.groupBy(*keys).agg(F.median(value).alias("_m"), F.count(F.lit(1)).alias("n"))
    r = rows.join(centre, keys)
    counts = r.groupBy(*keys, "n").agg(*(F.count_if(F.abs(F.col(value) - F.col("_m")) <= t).alias(f"_{k}") for k, t in enumerate(tolerances)))
    tries = counts.withColumn("_t", F.explode(F.array(*(F.struct(F.lit(k + 1).alias("attempt"), F.lit(t).alias("tolerance"), F.col(f"_{k}").alias("inliers")) for k, t in enumerate(tolerances)))))
    ok = tries.where(F.col("_t.inliers") >= F.col("n") * min_ratio)
    return ok.groupBy(*keys, "n").agg(F.min("_t").alias("_t")).select(*keys, "n", "_t.attempt", "_t.tolerance", "_t.inliers")


def height_stats(rows: DataFrame, keys: list[str], height: Column, zero: Column) -> DataFrame:
    x = rows.withColumn("_h", height)
    return x.groupBy(*keys).agg(F.avg("_h").alias("mean"), F.stddev_pop("_h").alias("std"), (F.max("_h") - F.min("_h")).alias("variation"), F.avg(zero.cast("double")).alias("zero_fraction"))


def gates(reasons: dict[str, Column]) -> Column:
    """All failing reasons in order; a null or NaN measure must be tested as failing by its own column."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in reasons.items())))


def first_reason(reasons: dict[str, Column]) -> Column:
    """The first failing reason, or null."""
    out = F.lit(None).cast("string")
    for k, c in reversed(reasons.items()):
        out = F.when(F.coalesce(c, F.lit(True)), F.lit(k)).otherwise(out)
    return out


def status(reasons: Column, recovered: Column) -> Column:
    return F.when(F.size(reasons) > 0, "NEEDS_REVIEW").when(recovered, "RECOVERED").otherwise("PASS")


def bad(x: Column) -> Column:
    """Null or not finite."""
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def errors(rows: DataFrame, keys: list[str], a: Column, b: Column) -> DataFrame:
    """Boundary errors: mae, rmse, worst, p95."""
    d = rows.withColumn("_d", F.abs(a - b))
    return d.groupBy(*keys).agg(F.avg("_d").alias("mae"), F.sqrt(F.avg(F.col("_d") * F.col("_d"))).alias("rmse"), F.max("_d").alias("worst"), F.percentile("_d", F.lit(0.95)).alias("p95"))


def interval_overlap(rows: DataFrame, keys: list[str], a0: Column, a1: Column, b0: Column, b1: Column) -> DataFrame:
    """Areas of intervals by column: truth [a0, a1), prediction [b0, b1): under, over, fractions of the truth (at least 1), IoU (1 without union)."""
    size = lambda lo, hi: F.greatest(hi - lo, F.lit(0.0))
    x = rows.withColumns({"_a": size(a0, a1), "_b": size(b0, b1), "_i": size(F.greatest(a0, b0), F.least(a1, b1))})
    s = x.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), F.sum("_i").alias("_i"))
    union = F.col("_a") + F.col("_b") - F.col("_i")
    return s.select(
        *keys, (F.col("_a") - F.col("_i")).alias("under"), (F.col("_b") - F.col("_i")).alias("over"), ((F.col("_a") - F.col("_i")) / F.greatest(F.col("_a"), F.lit(1.0))).alias("under_fraction"),
        ((F.col("_b") - F.col("_i")) / F.greatest(F.col("_a"), F.lit(1.0))).alias("over_fraction"), F.when(union > 0, F.col("_i") / union).otherwise(F.lit(1.0)).alias("iou"),
    )
