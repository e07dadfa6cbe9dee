"""Candidate pairs, corridors, votes and ambiguity: band-limited joins on a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def banded(rows: DataFrame, x: str, width: float) -> DataFrame:
    return rows.withColumn("_band", F.floor(F.col(x) / width).cast("long"))


def band_pairs(rows: DataFrame, key: str, x: str, low: float, high: float, columns: list[str]) -> DataFrame:
    """Pairs (0, 1) of one key with low <= x1 - x0 <= high, by an equi-join on bands as wide as the corridor.

    Each row meets the bands its partners can lie in, not all rows of its key, so that a hot key's pairs are
    bounded by the band's density.
    """
    width = max(high, 1e-9)
    first = banded(rows, x, width).select(key, "_band", *(F.col(c).alias(f"{c}0") for c in [x, *columns]))
    reach = range(int(low // width), int(high // width) + 2)
    first = first.withColumn("_band", F.explode(F.array(*(F.col("_band") + d for d in reach))))
    second = banded(rows, x, width).select(key, "_band", *(F.col(c).alias(f"{c}1") for c in [x, *columns]))
    return first.join(second, [key, "_band"]).where((F.col(f"{x}1") - F.col(f"{x}0")).between(low, high)).drop("_band")


def top(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= n)


def corridor(rows: DataFrame, anchors: DataFrame, key: str, x: str, centre: str, radius: float, penalty: float, score: str) -> DataFrame:
    """Rows within `radius` of their key's anchor, their score less `penalty` for each radius of distance."""
    d = F.abs(F.col(x) - F.col(centre))
    return rows.join(anchors, key).where(d <= radius).withColumn("corridor_score", F.col(score) - penalty * d / radius)


def interpolate(samples: DataFrame, points: DataFrame, key: str, x: str, y: str, at: str) -> DataFrame:
    """Piecewise-linear values at points, clamped at the ends: the last sample at or before and the first at or after.

    A union of both and running windows, so that no point meets more than two samples. Samples of one x: the last by y.
    """
    s = samples.groupBy(key, x).agg(F.max(y).alias(y)).select(key, F.col(x).alias("_x"), F.lit(0).alias("_k"), F.col(y).alias("_y"), F.lit(None).cast("long").alias("_id"))
    p = points.select(key, F.col(at).alias("_x"), F.lit(1).alias("_k"), F.lit(None).cast("double").alias("_y"), F.col("point_id").alias("_id"))
    w = Window.partitionBy(key).orderBy("_x", "_k")
    b = Window.partitionBy(key).orderBy(F.desc("_x"), "_k")
    is_sample = F.col("_k") == 0
    u = s.union(p).withColumns(
        {f"_{n}{side}": F.last(F.when(is_sample, F.col(c)), ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0)) for side, over in (("0", w), ("1", b)) for n, c in (("px", "_x"), ("py", "_y"))}
    )
    value = (
        F.when(F.col("_px0").isNull(), F.col("_py1"))
        .when(F.col("_px1").isNull() | (F.col("_px0") == F.col("_px1")), F.col("_py0"))
        .otherwise(F.col("_py0") + (F.col("_py1") - F.col("_py0")) * (F.col("_x") - F.col("_px0")) / (F.col("_px1") - F.col("_px0")))
    )
    return u.where("_k = 1").select(key, F.col("_id").alias("point_id"), F.col("_x").alias(at), value.alias(y))


def consensus(rows: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """Robust vote: rows within `tolerance` of the group's median; a group needs max(2, n // 2 + 1) of them: key, n, votes, centre, spread."""
    centre = rows.groupBy(key).agg(F.median(value).alias("m"), F.count(F.lit(1)).alias("n"))
    near = rows.join(centre, key).where(F.abs(F.col(value) - F.col("m")) <= tolerance)
    again = near.groupBy(key).agg(F.median(value).alias("centre"), F.count(F.lit(1)).alias("votes"), F.max("n").alias("n"))
    again = again.where(F.col("votes") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2) + 1))
    spread = near.join(again.select(key, "centre"), key).groupBy(key).agg(F.median(F.abs(F.col(value) - F.col("centre"))).alias("spread"))
    return again.join(spread, key).select(key, "n", "votes", "centre", "spread")


def second_best(rows: DataFrame, key: str, score: str, position: str, order: str, max_gap: float, min_distance: float) -> DataFrame:
    """Each key's best row, its second, and whether a distant rival scores within max_gap of the best."""
    r = top(rows, [key], [F.desc(score), F.asc(order)], 2)
    best = r.where("rank = 1").select(key, F.col(score).alias("best"), F.col(position).alias("at"))
    second = r.where("rank = 2").select(key, F.col(score).alias("second"))
    rival = rows.join(best, key).where((F.col("best") - F.col(score) < max_gap) & (F.abs(F.col(position) - F.col("at")) > min_distance))
    rival = rival.groupBy(key).agg(F.count(F.lit(1)).alias("rivals"))
    return best.join(second, key, "left").join(rival, key, "left").select(key, "best", "second", (F.col("best") - F.col("second")).alias("score_gap"), F.coalesce("rivals", F.lit(0)).alias("rivals"), (F.coalesce("rivals", F.lit(0)) > 0).alias("ambiguous"))


def weighted(parts: dict[str, tuple[Column, float]]) -> Column:
    """A score of parts under weights that are normalised by their sum."""
    total = sum(w for _, w in parts.values())
    if not total > 0:
        raise ValueError("weights: not all zero")
    out = F.lit(0.0)
    for x, w in parts.values():
        out = out + x * (w / total)
    return out
