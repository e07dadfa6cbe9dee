"""Sinks that people read: crops by mode, label maps, annotation packages and evaluation files. Existing files are never overwritten."""

from __future__ import annotations

import csv
import json
import os
from xml.sax.saxutils import quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import images


def _new(path: str, text: str, encoding: str = "utf-8") -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "x", encoding=encoding, newline="") as f:
        f.write(text)


def crop_path(mode: Column, rel_path: Column) -> Column:
    """`crops/<mode>/<folder>/<name>_roi.png`."""
    return F.concat(F.lit("crops/"), mode, F.lit("/"), F.regexp_replace(rel_path, r"(?<=[^/])\.[^./]*$", ""), F.lit("_roi.png"))


def write_crops(crops: DataFrame, root: str) -> DataFrame:
    """The images of a plan's crops as files; their paths come back."""
    return images.write_files(crops.withColumn("path", crop_path(F.col("mode"), F.col("rel_path"))), root, "path", "image")


def write_label_map(names: list[str], folder: str) -> None:
    """One class name in a line, in both files that annotation tools look for."""
    names = [n.strip() for n in names if n.strip()]
    if not names:
        raise ValueError("a class name is needed")
    for leaf in ("labelmap.txt", "classes.txt"):
        _new(os.path.join(folder, leaf), "\n".join(names) + "\n")


def write_annotation_package(pictures: DataFrame, tasks: DataFrame, root: str, class_names: list[str]) -> tuple[int, int]:
    """Images and masks under their own trees, tasks whole and in batches, the labelling interface, a README: how many tasks and batches.

    pictures: rel_path, content, mask; tasks: rel_path, task (JSON), batch, as regions.brush_tasks gives them. An image without a mask is fatal
    before anything is written. The files of images are written by executors; batches are streamed, one at a time, in order.
    """
    lost = pictures.where("mask IS NULL").select("rel_path").orderBy("rel_path").limit(10).collect()
    if lost:
        raise ValueError(f"no masks: {[r[0] for r in lost]}")
    whole = os.path.join(root, "tasks.json")
    _new(whole, "")
    for kind, column in (("images", "content"), ("masks", "mask")):
        images.write_files(pictures.withColumn("path", F.concat(F.lit(f"{kind}/"), "rel_path")), root, "path", column).count()
    n = batches = 0
    files = tasks.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("rel_path", "task"))).alias("rows")).orderBy("batch")  # a batch holds a few tasks
    with open(whole, "w", encoding="utf-8") as out:
        for r in files.toLocalIterator():
            made = [json.loads(x.task) for x in r.rows]
            for t in made:
                t["data"]["image"] = "/data/local-files/?d=images/" + t["data"]["image"]
            batches += 1
            _new(os.path.join(root, "imports", f"tasks_{batches:03d}.json"), json.dumps(made, ensure_ascii=False, indent=2))
            for t in made:
                out.write(("[\n" if not n else ",\n") + json.dumps(t, ensure_ascii=False))
                n += 1
        out.write("\n]\n" if n else "[]\n")
    labels = "".join(f"    <Label value={quoteattr(x)}/>\n" for x in class_names)
    _new(os.path.join(root, "label_config.xml"), f'<View>\n  <Image name="image" value="$image"/>\n  <BrushLabels name="tag" toName="image">\n{labels}  </BrushLabels>\n</View>\n')
    _new(os.path.join(root, "README.md"), f"# Masks to correct\n\n{n} tasks, in `tasks.json` at once and in `imports/` in {batches} batches. Serve this folder as the tool's local files, paste\n`label_config.xml` as the labelling interface, and import either.\n")
    return n, batches


def write_evaluation(scenes: DataFrame, summary: DataFrame, folder: str) -> None:
    """scene_metrics.csv (with a byte-order mark) and summary.json (no NaN): an approved scene is a row made by hand, so both fit the driver."""
    columns = scenes.columns
    path = os.path.join(folder, "scene_metrics.csv")
    _new(path, "", "utf-8")
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(columns)
        for r in scenes.orderBy("source").toLocalIterator():
            w.writerow(["" if x is None else x for x in r])
    rows = [r.asDict() for r in summary.orderBy("split").collect()]  # two splits
    _new(os.path.join(folder, "summary.json"), json.dumps({r.pop("split"): r for r in rows}, ensure_ascii=False, indent=2, allow_nan=False))
