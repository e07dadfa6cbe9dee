"""Sinks for people: files, names, and refusal to overwrite."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import codec
from plumbline.operators import auto, evaluate, regions
from plumbline.sources import packages


@pytest.fixture
def pictures(spark):
    png = lambda k: codec.encode_png(np.full((4, 6), k, np.uint8))
    rows = [(f"a/{k:02d}.x.png", png(k), codec.encode_png(np.eye(4, 6, dtype=np.uint8) * 255)) for k in range(23)]
    return spark.createDataFrame(rows, "rel_path string, content binary, mask binary").repartition(3)


def test_annotation_package(pictures, tmp_path):
    tasks = regions.brush_tasks(pictures.select("rel_path", "mask"), "defect")
    assert packages.write_annotation_package(pictures, tasks, str(tmp_path / "p"), ["a & b", "defect"]) == (23, 3)
    whole = json.loads((tmp_path / "p" / "tasks.json").read_text())
    parts = [json.loads((tmp_path / "p" / "imports" / f"tasks_{k:03d}.json").read_text()) for k in (1, 2, 3)]
    assert [len(x) for x in parts] == [10, 10, 3] and sum(parts, []) == whole
    assert [t["data"]["image"] for t in whole] == [f"/data/local-files/?d=images/a/{k:02d}.x.png" for k in range(23)]
    assert (tmp_path / "p" / "images" / "a" / "07.x.png").exists() and (tmp_path / "p" / "masks" / "a" / "22.x.png").exists()
    assert 'value="a &amp; b"' in (tmp_path / "p" / "label_config.xml").read_text() and (tmp_path / "p" / "README.md").exists()
    with pytest.raises(FileExistsError):
        packages.write_annotation_package(pictures, tasks, str(tmp_path / "p"), ["x"])
    with pytest.raises(ValueError, match="no masks"):
        packages.write_annotation_package(pictures.withColumn("mask", F.lit(None).cast("binary")), tasks, str(tmp_path / "q"), ["x"])
    assert not (tmp_path / "q").exists()


def test_crops_and_label_maps(spark, pictures, tmp_path):
    crops = pictures.select("rel_path", F.lit("std").alias("mode"), F.col("content").alias("image"))
    assert packages.write_crops(crops, str(tmp_path)).count() == 23 and (tmp_path / "crops" / "std" / "a" / "03.x_roi.png").exists()
    packages.write_label_map([" defect ", ""], str(tmp_path / "labels"))
    assert (tmp_path / "labels" / "labelmap.txt").read_text() == (tmp_path / "labels" / "classes.txt").read_text() == "defect\n"
    with pytest.raises(FileExistsError):
        packages.write_label_map(["x"], str(tmp_path / "labels"))
    with pytest.raises(ValueError):
        packages.write_label_map([" "], str(tmp_path / "none"))


def test_evaluation_files(spark, tmp_path):
    columns = "source string, split string, geometry_evaluated boolean, auto_pass boolean, false_pass boolean, " + ", ".join(f"{m} double" for m in evaluate.METRICS)
    scenes = spark.createDataFrame([("b", "tune", True, True, False, *[1.5] * len(evaluate.METRICS)), ("a", "tune", False, False, False, *[None] * len(evaluate.METRICS))], columns)
    packages.write_evaluation(scenes, evaluate.summary(scenes), str(tmp_path / "e"))
    lines = (tmp_path / "e" / "scene_metrics.csv").read_text(encoding="utf-8-sig").splitlines()
    assert lines[0].startswith("source,split") and lines[1].startswith("a,tune,False") and len(lines) == 3
    got = json.loads((tmp_path / "e" / "summary.json").read_text())
    assert got["tune"]["approved_gt_scenes"] == 2 and got["validation"]["scene_pass_rate"] is None
    with pytest.raises(FileExistsError):
        packages.write_evaluation(scenes, evaluate.summary(scenes), str(tmp_path / "e"))


def test_union_of_generators(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "g int, x double"), spark.createDataFrame([(1, "p")], "g int, y string")
    assert sorted((r.method, r.x, r.y) for r in auto.union({"a": a, "b": b}).collect()) == [("a", 2.0, None), ("b", None, "p")]
    with pytest.raises(ValueError):
        auto.union({})
