"""Row-profile algebra in long form: (key, position, value) relations and windows over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def minmax(value: str, keys: list[str]) -> Column:
    """Values scaled to 0..1 in each group; a flat group gives 0. Flat: spread below max(1e-6, max(|lo|, |hi|) * 1e-6)."""
    w = Window.partitionBy(*keys)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    flat = (hi - lo) <= F.greatest(F.lit(1e-6), F.greatest(F.abs(lo), F.abs(hi)) * 1e-6)
    return F.when(flat, F.lit(0.0)).otherwise((F.col(value) - lo) / (hi - lo))


def percentile_scale(rows: DataFrame, keys: list[str], value: str, low: float, high: float, out: str = "scaled") -> DataFrame:
    """Values scaled between two percentiles of their group and clipped; a degenerate group gives 0."""
    p = rows.groupBy(*keys).agg(F.percentile(value, F.lit(low)).alias("_lo"), F.percentile(value, F.lit(high)).alias("_hi"))
    x = (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return rows.join(p, keys).withColumn(out, F.when(F.col("_hi") > F.col("_lo"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))).otherwise(F.lit(0.0))).drop("_lo", "_hi")


def along(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def box(value: str, keys: list[str], order: str, half: int) -> tuple[Column, Column]:
    """Mean and population deviation of a window of 2 * half + 1 rows, cut at the ends."""
    w = along(keys, order).rowsBetween(-half, half)
    return F.avg(value).over(w), F.stddev_pop(value).over(w)


def gradient(value: str, keys: list[str], order: str) -> Column:
    """Central differences, one-sided at the ends."""
    w = along(keys, order)
    before, after, x = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(before.isNull(), after - x).when(after.isNull(), x - before).otherwise((after - before) / 2)


def two_sided_contrast(value: str, keys: list[str], order: str, gap: int, window: int) -> Column:
    """Mean of the values after, in [gap, window), minus that of the values before; null where a side has none."""
    w = along(keys, order)
    return F.avg(value).over(w.rowsBetween(gap, window - 1)) - F.avg(value).over(w.rowsBetween(-window, -gap - 1))


def local_peaks(rows: DataFrame, keys: list[str], order: str, value: str, height: float) -> DataFrame:
    """Rows above both neighbours (ends excluded) and at least `height`."""
    w = along(keys, order)
    x = rows.withColumns({"_b": F.lag(value).over(w), "_a": F.lead(value).over(w)})
    return x.where((F.col(value) > F.col("_b")) & (F.col(value) > F.col("_a")) & (F.col(value) >= height)).drop("_a", "_b")


def otsu(rows: DataFrame, keys: list[str], level: str, levels: int = 256) -> DataFrame:
    """The threshold of greatest between-class variance of each group's histogram (values above it are foreground); the least on ties.

    The histogram has at most `levels` rows a group whatever the number of pixels.
    """
    h = rows.where(F.col(level).between(0, levels - 1)).groupBy(*keys, level).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    run = w.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumns({"n0": F.sum("n").over(run), "s0": F.sum(F.col("n") * F.col(level)).over(run), "n1": F.sum("n").over(w), "s1": F.sum(F.col("n") * F.col(level)).over(w)})
    rest = F.col("n1") - F.col("n0")
    m0, m1 = F.col("s0") / F.col("n0"), (F.col("s1") - F.col("s0")) / rest
    h = h.withColumn("between", F.when(rest > 0, F.col("n0") * rest * (m0 - m1) * (m0 - m1) / (F.col("n1") * F.col("n1"))).otherwise(F.lit(0.0)))
    return h.groupBy(*keys).agg(F.max_by(level, F.struct("between", -F.col(level))).alias("threshold"), F.max("between").alias("variance"))


def runs(rows: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """Maximal runs of equal flags: keys, flag, start, length."""
    w = along(keys, order)
    x = rows.withColumn("flag", flag)
    x = x.withColumn("_new", F.coalesce((F.col("flag") != F.lag("flag").over(w)).cast("int"), F.lit(1)))
    x = x.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*keys, "_run", "flag").agg(F.min(order).alias("start"), F.count(F.lit(1)).alias("length")).drop("_run")


def largest_gap(rows: DataFrame, keys: list[str], x: str, left: float, right: float) -> DataFrame:
    """The widest gap between sorted points, both ends of the image included: keys, max_gap."""
    ends = rows.groupBy(*keys).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    w = Window.partitionBy(*keys).orderBy(x)
    inner = rows.withColumn("_g", F.lead(x).over(w) - F.col(x)).groupBy(*keys).agg(F.max("_g").alias("_g"))
    return ends.join(inner, keys).select(*keys, F.greatest(F.coalesce("_g", F.lit(0.0)), F.col("lo") - left, F.lit(right) - F.col("hi")).alias("max_gap"))


def median_fuse(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.median(value).alias("fused"), F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def prefix_means(rows: DataFrame, keys: list[str], order: str, value: str, before: int, after: int) -> Column:
    """Mean of the rows [-before, after] around each, by the engine's moving frame."""
    return F.avg(value).over(along(keys, order).rowsBetween(-before, after))


def positive_unit(rows: DataFrame, keys: list[str], value: str, out: str = "unit") -> DataFrame:
    """Values by the 99th percentile of their size in their group, cut to 0..1."""
    top = rows.groupBy(*keys).agg(F.percentile(F.abs(F.col(value)), F.lit(0.99)).alias("_top"))
    x = F.col(value) / F.greatest(F.col("_top"), F.lit(1e-8))
    return rows.join(top, keys).withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))).drop("_top")
