"""Reference assignment and joins between catalogue rows, reports, labels and ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_references(rows: DataFrame, group: list[str], name: str, exposure: str, reference: str, ident: str) -> DataFrame:
    """Each row's reference in its group, or why there is none: ident, ref_id, reason.

    The reference of the same name (the last of several) goes first; else the group's only reference, if no exposure
    folder holds several frames; else `missing_reference` or `ambiguous_reference`.
    """
    is_ref = F.col(exposure) == reference
    frames = rows.groupBy(*group, exposure).agg(F.count(F.lit(1)).alias("frames"))
    per = frames.groupBy(*group).agg(F.max("frames").alias("most"), F.sum(F.when(is_ref, F.col("frames")).otherwise(0)).alias("refs"))
    refs = rows.where(is_ref)
    named = refs.groupBy(*group, name).agg(F.max(ident).alias("named_id"))
    alone = refs.groupBy(*group).agg(F.max(ident).alias("lone_id"))
    out = rows.join(per, group).join(named, [*group, name], "left").join(alone, group, "left")
    lone = (F.col("refs") == 1) & (F.col("most") == 1)
    ref = F.coalesce("named_id", F.when(lone, F.col("lone_id")))
    reason = F.when(ref.isNotNull(), F.lit(None)).when(F.col("refs") == 0, F.lit("missing_reference")).otherwise(F.lit("ambiguous_reference"))
    return out.select(ident, ref.alias("ref_id"), reason.cast("string").alias("reason"))


def reuse_geometry(parents: DataFrame, children: DataFrame, key: str, parent_value: Column, child_value: Column) -> DataFrame:
    """One-to-many reuse: children whose value equals the parent's take its geometry, others become mismatches."""
    return parents.join(children, key).withColumn("status", F.when(parent_value == child_value, "reused").otherwise("reference_size_mismatch"))


def missing_companions(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return rows.join(others.select(key).distinct(), key, "left_anti")


def duplicate_keys(rows: DataFrame, *keys: Column) -> DataFrame:
    """Values that occur more than once under any of the keys (having count > 1, union distinct): key."""
    out = None
    for k in keys:
        d = rows.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        out = d if out is None else out.union(d)
    return out.distinct()


def template_match(rows: DataFrame, ident: str, attributes: list[str], score: str, low: Column, top: int = 3) -> DataFrame:
    """For each row that `low` marks, the best other rows with equal attributes: ident, template, rank.

    Only the best top + 1 rows of each attribute group can be templates, so the join stays in proportion to the rows.
    """
    w = Window.partitionBy(*attributes).orderBy(F.desc(score), ident)
    best = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top + 1)
    best = best.select(*attributes, F.col(ident).alias("template"), F.col("_r"))
    pairs = rows.where(low).select(ident, *attributes).join(best, attributes).where(F.col(ident) != F.col("template"))
    w = Window.partitionBy(ident).orderBy("_r")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(ident, "template", F.col("rank").cast("long").alias("rank"))


def case_splits(rows: DataFrame, case: str, split: str) -> DataFrame:
    """Cases that stand in several splits, an error of the manifest."""
    return rows.groupBy(case).agg(F.count_distinct(split).alias("splits"), F.count(F.lit(1)).alias("n")).where("splits > 1")


def exact_total(sizes: list[tuple[str, int]], wanted: int) -> list[str] | None:
    """Keys whose sizes sum to wanted exactly: keys in order, the first set found for each total stays; None if there is none."""
    found: dict[int, list[str]] = {0: []}
    for key, n in sorted(sizes):
        for total, keys in sorted(found.items()):
            if total + n <= wanted and total + n not in found:
                found[total + n] = [*keys, key]
    return found.get(wanted)
