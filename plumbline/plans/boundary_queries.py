"""Boundary operators over the supplied tables: lines and strips are made of orders' and events' numbers, DuckDB SQL stands beside each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import auto, boundary, catalog, profiles
from ..sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


# two lines an order: rows of 200, columns of 100
_LINES = """lines AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus <> 'P' AS top_valid, o_orderkey % 7 <> 0 AS bottom_valid, (o_custkey % 21 - 10) / 40.0 AS top_slope, (o_orderkey % 50) * 1.0 AS top_intercept,
  (o_orderkey % 17 - 8) / 40.0 AS bottom_slope, 60.0 + (o_custkey % 120) AS bottom_intercept, (o_orderkey % 10) / 10.0 AS pair_inlier_ratio FROM orders)"""


def _lines(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", (F.col("o_orderstatus") != "P").alias("top_valid"), (k % 7 != 0).alias("bottom_valid"), ((c % 21 - 10) / 40.0).alias("top_slope"),
        (k % 50).cast("double").alias("top_intercept"), ((k % 17 - 8) / 40.0).alias("bottom_slope"), (F.lit(60.0) + c % 120).cast("double").alias("bottom_intercept"), ((k % 10) / 10.0).alias("pair_inlier_ratio"),
    )


@query(
    f"""
WITH {_LINES}, e AS (SELECT *, top_intercept AS t0, top_intercept + top_slope * 99 AS t1, bottom_intercept AS b0, bottom_intercept + bottom_slope * 99 AS b1 FROM lines)
SELECT o_orderkey, CASE WHEN NOT (top_valid AND bottom_valid) THEN 'insufficient_consistent_points' WHEN greatest(abs(top_slope), abs(bottom_slope)) > tan(radians(12.0)) THEN 'tilt_exceeds_limit'
  WHEN least(least(b0, 200) - greatest(t0, 0), least(b1, 200) - greatest(t1, 0)) < 20 THEN 'crossed_or_outside_boundaries' WHEN greatest(b0 - t0, b1 - t1) > 150 THEN 'height_exceeds_limit'
  WHEN abs(bottom_slope - top_slope) * 99 / 200 > 0.1 THEN 'excessive_height_change' WHEN pair_inlier_ratio < 0.5 THEN 'insufficient_joint_support' END AS reason FROM e"""
)
def pair_veto(spark, sf):
    return _lines(spark, sf).select("o_orderkey", boundary.pair_reason(F.lit(200.0), F.lit(100.0), 12.0, 0.1, 0.75, 0.1, 0.5).alias("reason"))


@query(
    f"""
WITH {_LINES}, h AS (SELECT o_orderkey, unnest(range(100)) AS x, top_slope, top_intercept, bottom_slope, bottom_intercept FROM lines)
SELECT o_orderkey, round(avg(bottom_intercept - top_intercept + (bottom_slope - top_slope) * x), 6) AS mean, round(stddev_pop(bottom_intercept - top_intercept + (bottom_slope - top_slope) * x), 6) AS std,
  round((max(bottom_intercept - top_intercept + (bottom_slope - top_slope) * x) - min(bottom_intercept - top_intercept + (bottom_slope - top_slope) * x)) / 200, 6) AS change FROM h GROUP BY 1"""
)
def pair_thickness(spark, sf):
    """Closed forms; the SQL walks all columns."""
    out = boundary.pair_quality(_lines(spark, sf), F.lit(200.0), F.lit(100.0))
    return out.select("o_orderkey", F.round("height_mean_px", 6).alias("mean"), F.round("height_std_px", 6).alias("std"), F.round("height_change_ratio", 6).alias("change"))


@query(
    f"""
WITH {_LINES}, p AS (SELECT o_orderkey, top_slope AS a, top_intercept AS b FROM lines)
SELECT o_orderkey, round(((a * 40 + b + 0.5) / 2 - 0.5 - ((a * 20 + b + 0.5) / 2 - 0.5)) / ((40 + 0.5) / 4 - (20 + 0.5) / 4), 6) AS slope,
  round((a * 20 + b + 0.5) / 2 - 0.5 - ((a * 40 + b - a * 20 - b) / 2) / (20 / 4.0) * ((20 + 0.5) / 4 - 0.5), 6) AS intercept FROM p"""
)
def line_rescale(spark, sf):
    """A line from an image 4 times as wide and 2 times as high; the SQL moves two of its points and joins them."""
    slope, intercept = boundary.rescale("top", F.lit(4.0), F.lit(2.0))
    return _lines(spark, sf).select("o_orderkey", F.round(slope, 6).alias("slope"), F.round(intercept, 6).alias("intercept"))


@query(
    f"""
WITH {_LINES}, q AS (SELECT o_orderkey, top_intercept - 2 AS a, top_intercept + top_slope * 99 - 2 AS b, bottom_intercept + 1 AS d, bottom_intercept + bottom_slope * 99 + 1 AS c FROM lines)
SELECT o_orderkey, greatest(2, CAST(round_even(greatest(sqrt(99 * 99 + (b - a) * (b - a)), sqrt(99 * 99 + (c - d) * (c - d))), 0) AS INTEGER) + 1) AS width,
  greatest(2, CAST(round_even(greatest(abs(d - a), abs(c - b)), 0) AS INTEGER) + 1) AS height FROM q"""
)
def rectified_size(spark, sf):
    w, h = boundary.rectified_size(F.lit(100.0), 2.0)
    return _lines(spark, sf).select("o_orderkey", w.alias("width"), h.alias("height"))


@query(
    f"""
WITH {_LINES}, s AS (SELECT o_custkey % 40 AS scene, o_orderkey, o_orderkey % 9 AS x, top_intercept AS y0, bottom_intercept AS y1 FROM lines),
g AS (SELECT scene, regr_slope((y0 + y1) / 2, x) AS s, regr_intercept((y0 + y1) / 2, x) AS i, median(y1 - y0) AS t FROM s GROUP BY 1)
SELECT scene, round(t, 6) AS thickness, round(s, 6) AS slope, round(i - t / 2, 6) AS top_intercept, round(i + t / 2, 6) AS bottom_intercept FROM g"""
)
def parallel_band(spark, sf):
    rows = _lines(spark, sf).select((F.col("o_custkey") % 40).alias("scene"), (F.col("o_orderkey") % 9).alias("x"), F.col("top_intercept").alias("y0"), F.col("bottom_intercept").alias("y1"))
    out = boundary.parallel(rows, ["scene"])
    return out.select("scene", *(F.round(c, 6).alias(n) for c, n in (("thickness", "thickness"), ("top_slope", "slope"), ("top_intercept", "top_intercept"), ("bottom_intercept", "bottom_intercept"))))


# candidates: the orders of a customer, scored by price, with endpoints of their lines
_CANDS = f"{_LINES}, c AS (SELECT o_custkey AS scene, o_orderkey, o_totalprice / 600000.0 AS q, [round(top_intercept, 6), round(bottom_intercept, 6)] AS ends FROM lines)"


def _candidates(spark, sf):
    return _lines(spark, sf).select(F.col("o_custkey").alias("scene"), "o_orderkey", (F.col("o_totalprice") / 600000.0).alias("q"), F.array(F.round("top_intercept", 6), F.round("bottom_intercept", 6)).alias("ends"))


@query(
    f"""
WITH {_CANDS}, b AS (SELECT scene, max(q) AS q, max_by(ends, q) AS e FROM c GROUP BY 1),
g AS (SELECT c.scene, b.q AS best, c.q, greatest(abs(c.ends[1] - b.e[1]), abs(c.ends[2] - b.e[2])) AS gap FROM c JOIN b USING (scene))
SELECT scene, round(max(best), 6) AS best_score, round(max(q) FILTER (gap > 1), 6) AS second_score, round(max_by(gap, q) FILTER (gap > 1), 6) AS boundary_gap,
  bool_or(gap > 1 AND best - q < 0.05 AND gap > 30) AS ambiguous FROM g GROUP BY 1"""
)
def ambiguous_candidates(spark, sf):
    out = boundary.ambiguity(_candidates(spark, sf), ["scene"], "q", "ends", 0.05, 30.0)
    return out.select("scene", *(F.round(c, 6).alias(c) for c in ("best_score", "second_score", "boundary_gap")), "ambiguous")


@query(
    f"""
WITH RECURSIVE {_CANDS}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY q DESC, o_orderkey) AS k FROM c),
w AS (SELECT scene, k, o_orderkey, [ends] AS kept, TRUE AS stays FROM n WHERE k = 1
  UNION ALL SELECT n.scene, n.k, n.o_orderkey, CASE WHEN len(list_filter(w.kept, lambda e: greatest(abs(e[1] - n.ends[1]), abs(e[2] - n.ends[2])) <= 5)) = 0 THEN list_append(w.kept, n.ends) ELSE w.kept END,
    len(list_filter(w.kept, lambda e: greatest(abs(e[1] - n.ends[1]), abs(e[2] - n.ends[2])) <= 5)) = 0 FROM w JOIN n ON n.scene = w.scene AND n.k = w.k + 1)
SELECT scene, o_orderkey FROM w WHERE stays"""
)
def unlike_candidates(spark, sf):
    """The first of each neighbourhood stays."""
    return boundary.unlike(_candidates(spark, sf), ["scene"], [F.desc("q"), F.asc("o_orderkey")], apart=5.0).select("scene", "o_orderkey")


@query(
    f"""
WITH {_CANDS}, b AS (SELECT scene, max_by(ends, q) AS ends FROM c GROUP BY 1)
SELECT b.scene, CAST(count(*) FILTER (greatest(abs(b.ends[1] - c.ends[1]), abs(b.ends[2] - c.ends[2])) <= 40) AS BIGINT) AS consensus_count, count(*) AS votes FROM b JOIN c USING (scene) GROUP BY 1"""
)
def exposure_votes(spark, sf):
    c = _candidates(spark, sf)
    best = c.groupBy("scene").agg(F.max_by("ends", "q").alias("ends"))
    return boundary.votes(best, c.select("scene", F.col("ends").alias("vote")), ["scene"], 40.0).select("scene", "consensus_count", "votes")


@query(
    """
WITH s AS (SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 100.0 END AS o, (event_id % 100) / 100.0 AS i FROM events),
r AS (SELECT *, o / greatest(i, 0.05) AS r, coalesce(o >= 0.35 AND o / greatest(i, 0.05) >= 0.8, FALSE) AS f FROM s),
n AS (SELECT *, sum(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM r),
u AS (SELECT user_id, max(c) AS longest_run FROM (SELECT user_id, k, count(*) FILTER (f) AS c FROM n GROUP BY ALL) GROUP BY 1),
t AS (SELECT user_id, quantile_cont(r, 0.9) AS ratio, count(*) FILTER (f) / greatest(1, count(o)) AS share, count(o) / count(*) < 0.85 AS unavailable FROM r GROUP BY 1)
SELECT user_id, round(ratio, 6) AS ratio, round(share, 6) AS flag_fraction, longest_run, unavailable, share >= 0.6 OR longest_run >= 9 AS clipped FROM t JOIN u USING (user_id)"""
)
def outside_texture(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value") / 100.0).alias("o"), ((F.col("event_id") % 100) / 100.0).alias("i"))
    out = boundary.outside_check(e, ["user_id"], "event_id", "o", "i", 0.35, 0.05, 0.8, 0.6, 9, 0.85)
    return out.select("user_id", F.round("ratio", 6).alias("ratio"), F.round("flag_fraction", 6).alias("flag_fraction"), "longest_run", "unavailable", "clipped")


_LIMITS = {"min_height_ratio": 0.1, "max_height_ratio": 0.9, "max_tilt_deg": 13.0, "max_angle_diff_deg": 12.0, "max_height_variation_px": 20.0, "min_inlier_ratio": 0.3, "min_x_coverage": 0.2, "max_gap_ratio": 0.9, "max_rmse_px": 8.0, "max_median_residual_px": 5.0, "min_third_support": 1, "min_consensus_ratio": 0.5, "min_score": 0.05}


@query(
    f"""
WITH {_LINES}, a AS (SELECT *, bottom_intercept - top_intercept AS h0, bottom_intercept - top_intercept + (bottom_slope - top_slope) * 49.5 AS h1, bottom_intercept - top_intercept + (bottom_slope - top_slope) * 99 AS h2,
    o_orderkey % 12 AS rmse, o_custkey % 3 AS third, o_totalprice / 600000.0 AS q, o_orderkey % 4 AS votes FROM lines),
r AS (SELECT *, list_filter([
  CASE WHEN least(h0, h1, h2) <= 0 OR least(top_intercept, top_intercept + top_slope * 49.5, top_intercept + top_slope * 99) < 0 OR greatest(bottom_intercept, bottom_intercept + bottom_slope * 49.5, bottom_intercept + bottom_slope * 99) >= 200 THEN 'INVALID_GEOMETRY' END,
  CASE WHEN least(h0, h1, h2) < 20 OR greatest(h0, h1, h2) > 180 THEN 'IMPLAUSIBLE_HEIGHT' END,
  CASE WHEN greatest(abs(degrees(atan(top_slope))), abs(degrees(atan(bottom_slope)))) > 13 THEN 'EXCESSIVE_TILT' END,
  CASE WHEN abs(degrees(atan(top_slope)) - degrees(atan(bottom_slope))) > 12 THEN 'LARGE_ANGLE_DIFFERENCE' END,
  CASE WHEN greatest(h0, h1, h2) - least(h0, h1, h2) > 20 THEN 'LARGE_HEIGHT_VARIATION' END,
  CASE WHEN NOT top_valid THEN 'RANSAC_FAILED_TOP' END, CASE WHEN pair_inlier_ratio < 0.3 THEN 'LOW_INLIER_RATIO_TOP' END, CASE WHEN rmse > 8 THEN 'HIGH_RANSAC_RMSE_TOP' END, CASE WHEN third < 1 THEN 'MISSING_THIRD_SUPPORT_TOP' END,
  CASE WHEN NOT bottom_valid THEN 'RANSAC_FAILED_BOTTOM' END, CASE WHEN pair_inlier_ratio < 0.3 THEN 'LOW_INLIER_RATIO_BOTTOM' END, CASE WHEN rmse > 8 THEN 'HIGH_RANSAC_RMSE_BOTTOM' END, CASE WHEN third < 1 THEN 'MISSING_THIRD_SUPPORT_BOTTOM' END,
  CASE WHEN votes / 3.0 < 0.5 THEN 'LOW_MULTI_EXPOSURE_CONSENSUS' END, CASE WHEN q < 0.05 THEN 'LOW_BOUNDARY_SCORE' END], lambda x: x IS NOT NULL) AS reasons FROM a)
SELECT o_orderkey, array_to_string(reasons, ';') AS reasons, CASE WHEN len(reasons) > 0 THEN 'NEEDS_REVIEW' WHEN votes = 2 THEN 'RECOVERED' ELSE 'PASS' END AS status FROM r"""
)
def scene_states(spark, sf):
    """All gates of the boundary mode and the state that follows."""
    k = F.col("o_orderkey")
    rows = _lines(spark, sf).withColumns({"ambiguous": F.lit(False), "consensus_count": k % 4, "consensus_total": F.lit(3), "roi_quality": F.col("o_totalprice") / 600000.0, "was_recovered": k % 4 == 2})
    for s in boundary.SIDES:
        rows = rows.withColumns({f"{s}_inlier_ratio": F.col("pair_inlier_ratio"), f"{s}_x_coverage": F.lit(0.9), f"{s}_max_gap_ratio": F.lit(0.1), f"{s}_rmse": (k % 12).cast("double"), f"{s}_median_residual": F.lit(1.0), f"{s}_least_third": F.col("o_custkey") % 3, f"{s}_unavailable": F.lit(False), f"{s}_clipped": F.lit(False)})
    out = boundary.assess(rows, _LIMITS, F.lit(200.0), F.lit(100.0))
    return out.select("o_orderkey", F.col("needs_review_reason").alias("reasons"), F.col("quality_status").alias("status"))


@query(
    """
WITH x AS (SELECT doc_id, quality = 1 AS found, toxic = 1 AS review, doc_id % 3 = 0 AS allowed FROM labels)
SELECT doc_id, coalesce(found, FALSE) AND (NOT coalesce(review, FALSE) OR coalesce(allowed, FALSE)) AS export_eligible FROM x"""
)
def export_eligible(spark, sf):
    x = table(spark, sf, "labels")
    return x.select("doc_id", boundary.exportable(F.col("quality") == 1, F.col("toxic") == 1, F.col("doc_id") % 3 == 0).alias("export_eligible"))


@query(
    """
WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1),
o AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, n FROM conversations JOIN n USING (conv_id) WHERE turn > 0)
SELECT conv_id, turn FROM conversations WHERE turn = 0
UNION ALL SELECT conv_id, turn FROM o WHERE n <= 3 OR k IN (0, n - 2)"""
)
def spaced_exposures(spark, sf):
    """The first turn and two others at even distances."""
    return catalog.evenly_spaced(table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id"], F.col("turn") == 0, [F.asc("turn")], 3)


@query(
    """
SELECT page_id, CASE WHEN rtrim(string_split(leaf, '_(0)')[1], '_') <> '' THEN rtrim(string_split(leaf, '_(0)')[1], '_') ELSE leaf END AS dataset
FROM (SELECT page_id, string_split(url, '/')[3] || CASE page_id % 3 WHEN 0 THEN '_(0)raw' WHEN 1 THEN '__' ELSE '' END AS leaf FROM pages)"""
)
def dataset_name(spark, sf):
    tail = F.when(F.col("page_id") % 3 == 0, "_(0)raw").when(F.col("page_id") % 3 == 1, "__").otherwise("")
    return table(spark, sf, "pages").select("page_id", catalog.dataset_name(F.concat(F.split("url", "/")[2], tail)).alias("dataset"))


@query(
    """
SELECT o_custkey, CASE min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 END) WHEN 1 THEN '1-URGENT' ELSE '3-MEDIUM' END AS o_orderpriority
FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') GROUP BY 1"""
)
def first_existing(spark, sf):
    return catalog.first_existing(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", ["1-URGENT", "3-MEDIUM"])


@query(
    """
WITH p AS (SELECT user_id, quantile_cont(abs(value - 20), 0.99) AS p FROM events GROUP BY 1)
SELECT event_id, round(greatest(0, least(1, (value - 20) / greatest(p, 1e-8))), 6) AS unit FROM events JOIN p USING (user_id)"""
)
def positive_unit(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", (F.col("value") - 20).alias("v"))
    return profiles.positive_unit(e, ["user_id"], "v").select("event_id", F.round("unit", 6).alias("unit"))


# candidates of two generators: urgent orders by one method, others by another; customers are the groups
_AUTO = """a AS (SELECT o_custkey AS g, CASE WHEN o_orderpriority LIKE '1%' THEN 'gabor_fallback' WHEN o_orderpriority LIKE '2%' THEN 'registration' ELSE 'std' END AS method, o_orderkey,
    (o_orderkey % 10) / 10.0 AS p, o_custkey % 9 AS rmse, o_totalprice / 600000.0 AS texture, [o_orderkey % 7, o_custkey % 5] AS d FROM orders WHERE o_orderpriority NOT LIKE '5%'),
q AS (SELECT *, 0.25 * texture + 0.2 * p + 0.15 * (exp(-rmse / 6.0) * p + exp(-(rmse + 1) / 6.0) * p) / 2 + 0.1 * (least(1, p / 0.7) * exp(-greatest(0, 0.4 - 0.25) / 0.15) + least(1, 0.9 / 0.7)) / 2
    + 0.15 * (exp(-d[1] / 3.0) + exp(-d[2] / 3.0)) / 2 * 2 / 3.0 + 0.05 * p + 0.1 * exp(-(p / 10 / 0.06) * (p / 10 / 0.06) / 2) AS quality FROM a)"""


def _auto(spark, sf):
    p = (F.col("o_orderkey") % 10) / 10.0
    rows = table(spark, sf, "orders").where(~F.col("o_orderpriority").startswith("5"))
    shape = {
        "top_rmse": (F.col("o_custkey") % 9).cast("double"), "bottom_rmse": (F.col("o_custkey") % 9 + 1).cast("double"), "top_inlier_ratio": p, "bottom_inlier_ratio": p, "top_x_coverage": p, "bottom_x_coverage": F.lit(0.9),
        "top_max_gap_ratio": F.lit(0.4), "bottom_max_gap_ratio": F.lit(0.1), "height_change_ratio": p / 10, "pair_inlier_ratio": p, "texture": F.col("o_totalprice") / 600000.0,
        "d": F.array((F.col("o_orderkey") % 7).cast("double"), (F.col("o_custkey") % 5).cast("double")), **{f"{s}_{k}": F.lit(1.0) for s in boundary.SIDES for k in ("slope", "intercept")},
    }
    rows = rows.withColumns(shape)
    kinds = {"gabor_fallback": rows.where("o_orderpriority LIKE '1%'"), "registration": rows.where("o_orderpriority LIKE '2%'"), "std": rows.where("o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%'")}
    parts = {
        "texture": F.col("texture"), "edge": F.col("top_inlier_ratio"), "line": auto.line_part(6.0), "coverage": auto.coverage_part(0.7, 0.25), "consistency": auto.consistency_part(F.col("d"), F.lit(3), F.lit(200.0)),
        "pair": F.col("pair_inlier_ratio"), "geometry": auto.geometry_part(),
    }
    return auto.union(kinds).withColumn("roi_quality", auto.score(parts))


@query(f"WITH {_AUTO} SELECT o_orderkey, method, round(quality, 6) AS quality FROM q")
def auto_scores(spark, sf):
    """Candidates of all generators with the weighted sum of their seven parts."""
    return _auto(spark, sf).select("o_orderkey", "method", F.round("roi_quality", 6).alias("quality"))


@query(
    f"""
WITH {_AUTO}, r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round(quality, 9) DESC, method, o_orderkey) AS k, count(*) OVER (PARTITION BY g) AS n FROM q), b AS (SELECT * FROM r WHERE k = 1)
SELECT c_custkey, coalesce(method, 'full_frame_fallback') AS method, coalesce(n, 0) AS roi_candidate_count, CASE WHEN method IS NULL THEN 'full_frame_fallback' WHEN quality < 0.55 THEN 'low_confidence' WHEN method = 'std' THEN 'auto' ELSE 'auto_fallback' END AS status,
  CASE WHEN method IS NULL THEN 'no_localized_roi_full_frame_preserved' WHEN quality < 0.55 THEN 'low_quality_candidate_exported_for_review' END AS output_warning, CASE WHEN method IS NULL THEN 199.0 ELSE 1.0 END AS bottom_intercept
FROM customer LEFT JOIN b ON g = c_custkey"""
)
def auto_states(spark, sf):
    """The best candidate of each group, or its whole frame, and the state that follows."""
    groups = table(spark, sf, "customer").select("c_custkey")
    c = _auto(spark, sf).withColumnRenamed("o_custkey", "c_custkey").withColumn("roi_quality", F.round("roi_quality", 9))
    out = auto.choose(c, groups, "c_custkey", 0.55, F.lit(200.0))
    return out.select("c_custkey", "method", "roi_candidate_count", "status", "output_warning", "bottom_intercept")


@query(
    """
WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity / 50.0 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, greatest(3, CAST(round_even(31 * s, 0) AS INTEGER)) | 1 AS std_kernel, greatest(8, CAST(round_even(32 * s, 0) AS INTEGER)) AS fft_window, greatest(1, CAST(round_even(8 * s, 0) AS INTEGER)) AS fft_stride,
  round(least(0.45, 0.08 / s), 9) AS fft_min_frequency, round(least(0.5, 0.45 / s), 9) AS fft_max_frequency, greatest(1, CAST(round_even(6 * s, 0) AS INTEGER)) AS texture_gap,
  greatest(greatest(1, CAST(round_even(6 * s, 0) AS INTEGER)) + 1, CAST(round_even(40 * s, 0) AS INTEGER)) AS texture_window, round(greatest(1, 6 * s), 9) AS ransac_residual, round(greatest(greatest(1, 6 * s), 18 * s), 9) AS ransac_max_residual FROM s"""
)
def scaled_parameters(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 50.0).alias("s"))
    made = auto.scaled(F.col("s"), 31, 32, 8, 0.08, 0.45, 6, 40, 6.0, 18.0)
    exact = ("fft_min_frequency", "fft_max_frequency", "ransac_residual", "ransac_max_residual")
    return li.select("l_orderkey", "l_linenumber", *((F.round(c, 9) if k in exact else c).alias(k) for k, c in made.items()))
