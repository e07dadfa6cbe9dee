"""Identity, filters and configuration of an image catalogue: one row per file, attributes derived from its relative path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def path_parts(rel: Column) -> dict[str, Column]:
    """Columns of `<case>[-variant]/<capture>/<direction>/<N>us/<camera>_<rest>.<ext>`."""
    parts = F.split(rel, "/")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    name = at(-1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    folder = at(-2)
    return {
        "name": name,
        "ext": F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1)),
        "stem": stem,
        "camera": F.substring_index(stem, "_", 1),
        "exposure": folder,
        "exposure_us": _exposure_us(folder),
        "scene": F.array_join(F.when(F.size(parts) > 2, F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0)))).otherwise(F.array().cast("array<string>")), "/"),
        "case_key": F.lower(F.substring_index(at(1), "-", 1)),
        "label_path": F.concat(F.regexp_replace(rel, r"(?<=[^/])\.[^./]*$", ""), F.lit(".txt")),
    }


def _exposure_us(folder: Column) -> Column:
    digits = F.regexp_extract(F.coalesce(folder, F.lit("")), r"(?i)^(\d+)us$", 1)
    return F.when(digits != "", digits.cast("long"))


def with_identity(files: DataFrame, rel: str = "rel_path") -> DataFrame:
    return files.withColumns(path_parts(F.col(rel)))


def parse_extensions(text: str) -> list[str]:
    """`PNG, .jpg;png` -> ['.png', '.jpg']: trimmed, lower-case, with a dot, distinct, in order."""
    out = []
    for x in text.replace(";", ",").split(","):
        x = x.strip().lower()
        if x:
            out.append(x if x.startswith(".") else f".{x}")
    return list(dict.fromkeys(out))


def target_predicate(exposure: str, prefix: str, extensions: list[str]) -> Column:
    """Extraction: exposure folder and prefix without case, extension in the set."""
    return (F.lower("exposure") == exposure.lower()) & F.lower("name").startswith(prefix.lower()) & F.col("ext").isin(extensions)


def scan_predicate(exposure: str | None, prefix: str, extensions: list[str]) -> Column:
    """Region stage: the prefix with its case; one exposure folder, or any of digits and `us`."""
    where = (F.col("exposure") == exposure) if exposure else F.col("exposure").rlike("(?i)^[0-9]+us$")
    return where & F.col("name").startswith(prefix) & F.col("ext").isin(extensions)


def class_ids(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Label map: blank names drop out; ids are positions from 0. The map is a short list by its nature."""
    kept = rows.where(F.trim(name) != "")
    return kept.select((F.row_number().over(Window.orderBy(order)) - 1).cast("long").alias("class_id"), F.trim(name).alias("class_name"))


def first_per_group(rows: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str = "rank") -> DataFrame:
    """The first n rows of each group by a total order."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def limit_groups(rows: DataFrame, group: str, n: int) -> DataFrame:
    """All rows of the first n groups by key: the keys are limited, not the rows."""
    first = rows.select(group).distinct().orderBy(group).limit(n)
    return rows.join(F.broadcast(first), group)


def dataset_name(folder: Column) -> Column:
    """`20261010_case16_(0)raw` -> `20261010_case16`: what stands before `_(0)`, without trailing underscores; the whole name where nothing is left."""
    name = F.regexp_replace(F.substring_index(folder, "_(0)", 1), "_+$", "")
    return F.when(name != "", name).otherwise(folder)


def first_existing(files: DataFrame, folder: str, name: str, preferred: list[str]) -> DataFrame:
    """Each folder's file that comes first in the list of preferred names."""
    rank = F.array_position(F.array(*map(F.lit, preferred)), F.col(name))
    return files.where(rank > 0).groupBy(folder).agg(F.min_by(name, rank).alias(name))


def evenly_spaced(rows: DataFrame, scene: list[str], reference: Column, order: list[Column], n: int) -> DataFrame:
    """Of each scene the reference and n - 1 others at even distances in order, first and last included; all where there are no more than n."""
    w = Window.partitionBy(*scene, "_ref")
    x = rows.withColumn("_ref", reference).withColumns({"_k": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(w), "_all": F.count(F.lit(1)).over(Window.partitionBy(*scene))})
    steps = F.sequence(F.lit(0), F.lit(max(n - 2, 0)))
    # place i of n - 1 is floor(i * (others - 1) / (n - 2)); one alone is the first
    wanted = F.transform(steps, lambda i: F.floor(i * (F.col("_n") - 1) / F.lit(max(n - 2, 1)))) if n > 1 else F.array().cast("array<bigint>")
    keep = F.col("_ref") | (F.col("_all") <= n) | F.array_contains(wanted, F.col("_k").cast("long"))
    return x.where(keep).drop("_ref", "_k", "_n", "_all")


def exposure_order() -> list[Column]:
    """By exposure as a number, then by path."""
    return [F.asc("exposure_us"), F.asc("rel_path")]
