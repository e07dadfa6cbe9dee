import io
import json
import zipfile

import duckdb
import numpy as np
import pytest

from plumbline.functions import codec, lines
from plumbline.operators import reference, regions
from plumbline.plans import inspection, registry
from plumbline.sources import images

from .test_kernels import band

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v.item() if hasattr(v, "item") else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in columns]
    b = sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=repr)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y, abs=2e-6) if all(isinstance(v, int | float) for v in x + y) else x == y


def test_other_queries_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, SF).count() > 0


def test_references(spark):
    rows = spark.createDataFrame(
        [("a1", "s1", "c", "m_a", "ref"), ("a2", "s1", "c", "m_a", "5"), ("b1", "s2", "c", "m_r", "ref"), ("b2", "s2", "c", "m_t", "5"), ("c1", "s3", "c", "m_1", "ref"), ("c2", "s3", "c", "m_2", "ref"), ("c3", "s3", "c", "m_9", "5"), ("d1", "s4", "c", "m_a", "5")],
        "id string, scene string, camera string, name string, exposure string",
    )
    out = {r.id: (r.ref_id, r.reason) for r in reference.assign_references(rows, ["scene", "camera"], "name", "exposure", "ref", "id").collect()}
    assert out["a2"] == ("a1", None) and out["b2"] == ("b1", None) and out["c1"] == ("c1", None)
    assert out["c3"] == (None, "ambiguous_reference") and out["d1"] == (None, "missing_reference")


@pytest.fixture
def tree(tmp_path):
    def put(path, data):
        p = tmp_path / "tree" / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)

    x = band()
    for case in ("case01", "case[9]"):
        put(f"{case}/01/000/10000us/mono_a.png", codec.encode_png(x))
        put(f"{case}/01/000/5000us/mono_a.png", codec.encode_png((x // 2).astype(np.uint8)))
    put("case04/01/000/5000us/mono_a.png", codec.encode_png(x))
    put("case10/01/000/10000us/mono_g.png", b"text")
    put("case11/01/000/10000us/mono_h.png", codec.encode_png(x))
    put("case11/01/000/5000us/mono_h.png", codec.encode_png(x[:80]))
    put("case12/01/000/10000us/color_a.png", codec.encode_png(x))
    return tmp_path / "tree"


def test_inspection_end_to_end(spark, tree, tmp_path):
    o = inspection.Options(lines=lines.Config(smooth=9, gap=4, window=20))
    r = inspection.run(spark, str(tree), o)
    report = {x.rel_path: x for x in r.report.collect()}
    assert len(report) == 8
    assert report["case01/01/000/10000us/mono_a.png"].status in ("fitted", "recovered")
    assert report["case[9]/01/000/5000us/mono_a.png"].roi_reused
    assert report["case04/01/000/5000us/mono_a.png"].reason == "missing_reference"
    assert report["case10/01/000/10000us/mono_g.png"].status == "skipped"
    assert report["case11/01/000/5000us/mono_h.png"].reason == "reference_size_mismatch"
    labels = r.labels.collect()
    assert len(labels) == 5 and all(x.error is None for x in labels)
    images.write_report(r.report, str(tmp_path / "report"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        images.write_report(r.report, str(tmp_path / "report"))
    tasks = regions.brush_tasks(r.labels, "defect").collect()
    task = json.loads(tasks[0].task)
    assert task["annotations"][0]["result"][0]["value"]["format"] == "rle" and tasks[0].batch == 0
    written = images.write_files(r.crops.where("image IS NOT NULL"), str(tmp_path / "out"), "rel_path", "image").collect()
    assert len(written) == 5 and (tmp_path / "out" / written[0].rel_path).exists()


def test_package(spark, tmp_path):
    x = codec.encode_png(np.zeros((4, 4), np.uint8))
    rows = spark.createDataFrame([("a/x.png", x, ["0 0 0 1 0 1 1"]), ("b/y.png", x, [])], "rel_path string, content binary, labels array<string>")
    assert images.package(rows, str(tmp_path / "d.zip"), ["defect"]) == 2
    names = zipfile.ZipFile(io.BytesIO((tmp_path / "d.zip").read_bytes())).namelist()
    assert "train/labels/x.txt" in names and "data.yaml" in names
    with pytest.raises(ValueError, match="duplicate"):
        images.package(rows.union(spark.createDataFrame([("c/X.jpg", x, [])], rows.schema)), str(tmp_path / "e.zip"), ["defect"])


def test_streamed_labels(spark, tree, tmp_path):
    from plumbline.streaming.arrivals import label_arrivals

    seen = []
    q = label_arrivals(spark, str(tree), str(tmp_path / "cp"), lambda rows, epoch: seen.extend(r.error for r in rows.collect()), size=21)
    q.awaitTermination(120)
    assert len(seen) == 9 and seen.count("unreadable_image") == 1


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
