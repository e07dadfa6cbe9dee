import json

import pytest

from plumbline.operators import evaluate
from plumbline.plans import inspection
from plumbline.functions import lines
from plumbline.sources import report, truth

from .test_plans import tree  # noqa: F401


def test_schema_has_162_columns(spark):
    names = report.schema().names
    assert len(names) == len(set(names)) == 162
    assert names[65] == "top_valid" and names[-1] == "gt_mask_iou"


def test_report_round_trip(spark, tree, tmp_path):  # noqa: F811
    r = inspection.run(spark, str(tree), inspection.Options(lines=lines.Config(smooth=9, gap=4, window=20)))
    rows = report.from_inspection(r.report, "10000us", 0, "2024-01-01T00:00:00+00:00")
    assert report.write_csv(rows, str(tmp_path / "r.csv")) == 8
    with pytest.raises(FileExistsError):
        report.write_csv(rows, str(tmp_path / "r.csv"))
    back = {x.source: x for x in report.read_csv(spark, str(tmp_path / "r.csv")).collect()}
    x = back["case01/01/000/10000us/mono_a.png"]
    assert x.is_reference and x.scene == "case01/01/000" and x.top_points_json and 40 < x.height_left < 70
    assert back["case04/01/000/5000us/mono_a.png"].height_left is None and not back["case01/01/000/5000us/mono_a.png"].is_reference
    m = evaluate.manifest(report.read_csv(spark, str(tmp_path / "r.csv")), "std", 1, review_only=False).collect()
    assert sum(x.split == "validation" for x in m) == 1
    with pytest.raises(ValueError, match="validation_count"):
        evaluate.manifest(rows, "std", 99)


def test_truth_and_evaluation(spark, tmp_path):
    line = lambda a, b: [[0, a], [9, b]]
    good = {"shape": [100, 10], "split": "tune", "status": "approved", "top_points": line(20, 20), "bottom_points": line(60, 60)}
    corners = {"shape": [100, 10], "split": "validation", "corners": [[0, 20], [9, 20], [9, 60], [0, 60]]}
    (tmp_path / "gt.json").write_text(json.dumps({"a/x.png": good, "b/x.png": corners, "c/x.png": {**good, "top_points": line(70, 70)}, "d/x.png": {**good, "split": "odd"}, "e/x.png": {**good, "top_points": [[0, 20], [0, 21]]}, "f/x.png": good}))
    t = truth.read_truth_json(spark, str(tmp_path / "gt.json"))
    assert {r.source: r.problem for r in t.collect()} == {"a/x.png": None, "b/x.png": None, "c/x.png": "crossing_lines", "d/x.png": "unknown_split", "e/x.png": "bad_top", "f/x.png": None}
    rows = report.conform(spark.createDataFrame([("A/x.png", "std", "fitted", True, True, 0.0, 22.0, 0.0, 62.0), ("b/x.png", "std", "fitted", False, True, None, None, None, None)], "source string, mode string, status string, found boolean, is_reference boolean, top_slope double, top_intercept double, bottom_slope double, bottom_intercept double"))
    found = evaluate.scenes(rows, t, "std")
    by = {r.source: r for r in found.collect()}
    assert by["a/x.png"].mask_iou == pytest.approx(39 / 43) and by["a/x.png"].top_mae_px == 2 and by["a/x.png"].false_pass
    assert by["b/x.png"].evaluation_status == "no_localized_roi" and by["b/x.png"].false_pass and by["f/x.png"].evaluation_status == "unavailable"
    s = {r.split: r for r in evaluate.summary(found).collect()}
    assert s["tune"].approved_gt_scenes == 2 and s["tune"].false_pass_rate == 1 and s["validation"].mean_mask_iou is None
    (tmp_path / "gt.csv").write_text('source,split,status,height,width,top_points_json,bottom_points_json\na,tune,approved,100,10,"[[0,20],[9,20]]","[[0,60],[9,60]]"\nA,tune,pending,,,,\n')
    assert {r.problem for r in truth.read_truth_csv(spark, str(tmp_path / "gt.csv")).collect()} == {"duplicate_source"}


def test_overrides(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"a.png": {"std": {"shape": [100, 11], "top_y": [10, 20], "bottom_y": [50, 60]}}}))
    o = truth.read_overrides(spark, str(tmp_path / "o.json"))
    schema = "rel_path string, mode string, status string, found boolean, needs_review boolean, input_height int, input_width int, top_slope double, top_intercept double, bottom_slope double, bottom_intercept double"
    found = spark.createDataFrame([("a.png", "std", "no_roi", False, True, 100, 11, None, None, None, None), ("b.png", "std", "fitted", True, False, 100, 11, 0.0, 1.0, 0.0, 9.0)], schema)
    by = {r.rel_path: r for r in truth.apply_overrides(found, o).collect()}
    assert (by["a.png"].status, by["a.png"].found, by["a.png"].top_slope, by["a.png"].bottom_intercept) == ("manual", True, 1.0, 50.0) and by["b.png"].status == "fitted"
    wrong = spark.createDataFrame([("a.png", "std", "no_roi", False, True, 90, 11, None, None, None, None)], schema)
    with pytest.raises(Exception, match="override of another shape"):
        truth.apply_overrides(wrong, o).collect()
