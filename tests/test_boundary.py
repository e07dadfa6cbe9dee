"""The boundary mode: kernels on made bands, the relational gates, the plan on a tree of images."""

import itertools
import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import bands, codec, lattice, lines
from plumbline.operators import boundary, catalog, exports
from plumbline.plans import boundary as plan
from plumbline.plans import registry
from plumbline.sources import config, images

from .test_kernels import band


def test_paths_through_any_layer_are_the_cheapest():
    rng = np.random.default_rng(8)
    x = np.array([0.0, 10, 20, 40, 50])
    rows = [rng.integers(0, 50, (n, 2)).astype(float) for n in (2, 3, 1, 4, 3)]
    reward = [rng.random(len(r)) for r in rows]
    net = lattice.boundaries(x, rows, reward, 100, 10.0, 1.0, 12.0)

    def cost(path):
        total = -sum(r[k] for r, k in zip(reward, path, strict=True))
        total += sum(net.edge(k, k + 1)[path[k], path[k + 1]] for k in range(4))
        return total + sum(net.bend(k, k + 1, k + 2)[path[k], path[k + 1], path[k + 2]] for k in range(3))

    best = min(cost(p) for p in itertools.product(*(range(len(r)) for r in rows)))
    assert cost(net.best()) == pytest.approx(best)
    assert all(cost(net.through(k)) == pytest.approx(best) for k in range(5))
    assert lattice.boundaries(x[:1], rows[:1], reward[:1], 100, 1.0, 1.0, 1.0).best() == [int(np.argmax(reward[0]))]


def test_consensus_line_of_most_points():
    rng = np.random.default_rng(1)
    x = np.arange(20.0)
    y = 3 + 0.5 * x + rng.normal(0, 0.1, 20)
    y[[2, 7, 11]] += 30
    fit = lines.fit_line(np.stack([x, y], 1), 20, 1.0, lines.Config())
    assert fit.valid and abs(fit.slope - 0.5) < 0.05 and fit.n_inliers == 17
    assert lines.fit_line(np.stack([np.ones(5), x[:5]], 1), 20, 1.0, lines.Config()).reason == "no_model"
    assert lines.fit_line(np.stack([x[:3], x[:3]], 1), 20, 1.0, lines.Config()).reason == "insufficient_points"


@pytest.mark.parametrize("slope", [0.0, 0.05, -0.03])
def test_bands_are_found(slope):
    c = config.load()
    e = bands.measure(band(h=260, w=300, slope=slope), c)
    best = bands.candidates(e, c)[0]
    top, bottom = best["lines"]
    assert best["roi_detected"] and abs(top.intercept - 50) < 8 and abs(bottom.intercept - 105) < 8 and abs(top.slope - slope) < 0.03


def test_a_lost_side_comes_back_from_the_other():
    c = config.load({"recovery": {"search_margin": 20}})
    e = bands.measure(band(h=260, w=300), c)
    known = lines.Line(valid=True, slope=0.0, intercept=50.0)
    again = bands.other_side(e, known, 1, 55.0, c)
    assert bands.failures(again, c) == 0 and abs(again.intercept - 105) < 8
    assert bands.failures(lines.Line(), c) == 99
    assert bands.candidates(bands.measure(np.full((90, 80), 7, np.uint8), c), c) == []


@pytest.mark.parametrize(
    "bad", [{"nothing": {}}, {"gabor": 3}, {"gabor": {"size": 3}}, {"gabor": {"kernel_size": 4}}, {"gabor": {"orientations": 2.5}}, {"preprocess": {"clahe": 1}}, {"candidate": {"aggregation": "max"}}, {"candidate": {"weights": [0, 0, 0, 0]}}, {"pair": {"min_height_ratio": 0.9}}, {"ransac": {"thresholds": [8, 8, 9]}}, {"quality": {"min_score": 1.5}}, {"quality": {"max_tilt_deg": 90}}, {"outside": {"window": 0}}, "[1]"]
)
def test_configuration_is_strict(bad):
    with pytest.raises(ValueError):
        config.load(bad)


def test_configuration_lays_over_the_defaults():
    got = config.load(json.dumps({"gabor": {"kernel_size": 11}}))
    assert got["gabor"]["kernel_size"] == 11 and got["gabor"]["sigma"] == config.DEFAULTS["gabor"]["sigma"] and config.DEFAULTS["gabor"]["kernel_size"] == 21


def test_outside_check_against_a_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(x), None if rng.random() < 0.2 else float(rng.random()), float(rng.random())) for k in range(12) for x in range(9)]
    got = boundary.outside_check(spark.createDataFrame(rows, "k int, x double, out double, inside double"), ["k"], "x", "out", "inside", 0.35, 0.05, 0.8, 0.5, 3, 0.7).collect()
    for r in got:
        of = sorted(x for x in rows if x[0] == r.k)
        ratios = [o / max(i, 0.05) for _, _, o, i in of if o is not None]
        flags = [o is not None and o >= 0.35 and o / max(i, 0.05) >= 0.8 for _, _, o, i in of]
        longest = max((len(list(g)) for f, g in itertools.groupby(flags) if f), default=0)
        assert r.ratio == pytest.approx(np.percentile(ratios, 90)) and r.longest_run == longest and r.flag_fraction == pytest.approx(sum(flags) / len(ratios))
        assert r.clipped == (sum(flags) / len(ratios) >= 0.5 or longest >= 3) and r.unavailable == (len(ratios) / 9 < 0.7)


def test_unlike_and_evenly_spaced_and_ranked(spark):
    rows = spark.createDataFrame([(1, 0.9, [0.0, 0.0]), (1, 0.8, [0.5, 0.9]), (1, 0.7, [0.5, 1.6]), (1, 0.6, [1.7, 2.7]), (2, 0.1, [0.0, 0.0])], "s int, q double, ends array<double>")
    assert sorted((r.s, r.q) for r in boundary.unlike(rows, ["s"], [F.desc("q")]).collect()) == [(1, 0.6), (1, 0.7), (1, 0.9), (2, 0.1)]
    shots = spark.createDataFrame([(s, e, f"{s}/{e}", e == 5) for s, n in ((1, 12), (2, 3)) for e in range(n)], "scene int, exposure_us int, rel_path string, ref boolean")
    got = {}
    for r in catalog.evenly_spaced(shots.withColumn("ref", F.col("exposure_us") == F.when(F.col("scene") == 1, 5).otherwise(1)), ["scene"], F.col("ref"), catalog.exposure_order(), 4).collect():
        got.setdefault(r.scene, []).append(r.exposure_us)
    others = [e for e in range(12) if e != 5]
    assert sorted(got[1]) == sorted([5, *(others[i] for i in np.linspace(0, 10, 3, dtype=int))]) and sorted(got[2]) == [0, 1, 2]
    names = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("p")).repartition(7)
    assert [r.p for r in sorted(exports.ranked(names, "p").collect(), key=lambda r: r["rank"])] == sorted(r.p for r in names.collect())


@pytest.fixture
def tree(tmp_path):
    def put(path, data):
        p = tmp_path / "tree" / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)

    x = band(h=260, w=300)
    for e in (10000, 5000, 2000):
        put(f"case01/01/000/{e}us/mono_a.png", codec.encode_png((x * (0.4 + e / 20000)).astype(np.uint8)))
    put("case02/01/000/10000us/mono_a.png", codec.encode_png(np.full((200, 220), 9, np.uint8)))
    put("case03/01/000/5000us/mono_a.png", codec.encode_png(x))
    put("case04/01/000/10000us/mono_a.png", b"")
    put("case05/01/000/10000us/mono_a.png", codec.encode_png(x))
    put("case05/01/000/5000us/mono_a.png", codec.encode_png(x[:200]))
    return tmp_path / "tree"


def test_plan(spark, tree):
    r = plan.run(spark, str(tree), config.load())
    scenes = {x.rel_path.split("/")[0]: x for x in r.scenes.collect()}
    a = scenes["case01"]
    assert a.quality_status in ("PASS", "RECOVERED"), a.needs_review_reason
    assert a.consensus_total == 3 and a.consensus_count >= 2 and abs(a.top_intercept - 50) < 8 and a.export_eligible
    assert scenes["case02"].method == "full_frame_preserved" and scenes["case02"].needs_review and scenes["case02"].bottom_intercept == 199
    report = {x.rel_path: x for x in r.report.collect()}
    assert len(report) == 8
    assert report["case03/01/000/5000us/mono_a.png"].reason == "missing_reference"
    assert report["case04/01/000/10000us/mono_a.png"].reason == "unreadable_reference"
    assert report["case05/01/000/5000us/mono_a.png"].reason == "reference_size_mismatch"
    crop = codec.decode(next(bytes(x.image) for x in r.crops.collect() if x.rel_path == a.rel_path))
    assert not crop[:40].any() and crop[60:95].any() and not crop[115:].any()
    few = plan.run(spark, str(tree), config.load(), fusion_exposures=2)
    assert {x.rel_path.split("/")[0]: x.consensus_total for x in few.scenes.collect()}["case01"] == 2


def test_paths_are_safe(tmp_path):
    (tmp_path / "in").mkdir()
    assert images.check_paths(str(tmp_path / "in"), str(tmp_path / "out"))[1].endswith("out")
    for out in ("in", "in/below"):
        with pytest.raises(ValueError):
            images.check_paths(str(tmp_path / "in"), str(tmp_path / out))
    with pytest.raises(NotADirectoryError):
        images.check_paths(str(tmp_path / "none"), str(tmp_path / "out"))


def test_parallel_lines_at_the_height_limit(spark, tmp_path):
    """Parallel lines just as far apart as the least height allows, for every slope and place that orders can make, are high enough at every column."""
    path = f"{tmp_path}/orders.parquet"
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT k AS o_orderkey, c AS o_custkey, 'O' AS o_orderstatus, 90000.0::DOUBLE AS o_totalprice FROM range(850) a(k), range(840) b(c)
        WHERE 60 + c % 120 = 20 + k % 50 AND c % 21 - 10 = k % 17 - 8) TO '{path}' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}'")
    want = con.execute(f"SELECT o_orderkey, reasons, status FROM ({registry.oracle_sql()['scene_states']}) ORDER BY ALL").fetchall()
    got = sorted(tuple(r) for r in registry.queries()["scene_states"](spark, str(tmp_path)).select("o_orderkey", "reasons", "status").collect())
    assert len(got) > 50 and got == want and not any("IMPLAUSIBLE_HEIGHT" in r[1] for r in got)
