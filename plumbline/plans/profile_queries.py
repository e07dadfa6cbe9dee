"""Profile, candidate, vote and fit operators over the supplied tables, with DuckDB SQL beside each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import candidates, exports, fits, profiles
from ..sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


def _rounded(rows, *columns, places=6):
    return rows.select(*(F.round(c, places).alias(c) if c in columns else F.col(c) for c in rows.columns))


_LONG = "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"


def _profile(spark, sf):
    # whole vectors move, not their numbers: what follows keeps their distribution
    return table(spark, sf, "embeddings").select("vec_id", "embedding").repartition("vec_id").select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))


@query(
    """
WITH p AS (SELECT a.user_id, a.event_id AS event_id0, b.event_id AS event_id1, b.value - a.value AS height,
             (a.event_id % 97 + b.event_id % 89) / 186.0 - 0.15 * abs(b.value - a.value - 15) / 10 AS score
  FROM events a JOIN events b ON a.user_id = b.user_id AND b.value - a.value BETWEEN 10 AND 20),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, event_id0, event_id1) AS rank FROM p WHERE score > 0.15)
SELECT user_id, event_id0, event_id1, round(height, 6) AS height, round(score, 6) AS score, rank FROM r WHERE rank <= 48"""
)
def pair_candidates(spark, sf):
    """Top and bottom rows of one scene whose distance lies in a band, scored; the best 48 of each scene."""
    e = _events(spark, sf).select("user_id", "event_id", "value")
    p = candidates.band_pairs(e, "user_id", "value", 10, 20, ["event_id"])
    height = F.col("value1") - F.col("value0")
    score = (F.col("event_id0") % 97 + F.col("event_id1") % 89) / F.lit(186.0) - F.lit(0.15) * F.abs(height - 15) / 10
    p = p.withColumns({"height": height, "score": score}).where("score > 0.15")
    p = candidates.top(p, ["user_id"], [F.desc(F.round("score", 9)), F.asc("event_id0"), F.asc("event_id1")], 48)
    return _rounded(p.select("user_id", "event_id0", "event_id1", "height", "score", "rank"), "height", "score")


@query(
    """
WITH m AS (SELECT user_id, median(value) AS centre FROM events GROUP BY 1)
SELECT event_id, user_id, round(value - 0.15 * abs(value - centre) / 8, 9) AS corridor_score FROM events JOIN m USING (user_id) WHERE abs(value - centre) <= 8"""
)
def corridor_join(spark, sf):
    e = _events(spark, sf)
    m = e.groupBy("user_id").agg(F.median("value").alias("centre"))
    return _rounded(candidates.corridor(e, m, "user_id", "value", "centre", 8.0, 0.15, "value").select("event_id", "user_id", "corridor_score"), "corridor_score", places=9)


@query(
    """
WITH r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events WHERE event_type IN ('view', 'click'))
SELECT a.user_id, a.event_id AS top_id, b.event_id AS bottom_id, round(a.value + b.value, 6) AS score FROM r a JOIN r b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'click' WHERE a.k <= 4 AND b.k <= 4"""
)
def topk_cross(spark, sf):
    """The four best of each side of a key, all sixteen combinations: bounded by the key's count."""
    e = _events(spark, sf).where(F.col("event_type").isin("view", "click"))
    r = candidates.top(e, ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")], 4)
    a = r.where("event_type = 'view'").select("user_id", F.col("event_id").alias("top_id"), F.col("value").alias("a"))
    b = r.where("event_type = 'click'").select("user_id", F.col("event_id").alias("bottom_id"), F.col("value").alias("b"))
    return a.join(b, "user_id").select("user_id", "top_id", "bottom_id", F.round(F.col("a") + F.col("b"), 6).alias("score"))


@query(
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM events),
b AS (SELECT user_id, value AS best, event_id AS pos FROM r WHERE k = 1), s AS (SELECT user_id, value AS second FROM r WHERE k = 2),
v AS (SELECT user_id, count(*) AS rivals FROM events JOIN b USING (user_id) WHERE best - value < 30 AND abs(event_id - pos) > 100 GROUP BY 1)
SELECT b.user_id, best, second, round(best - second, 6) AS score_gap, coalesce(rivals, 0) AS rivals, coalesce(rivals, 0) > 0 AS ambiguous FROM b LEFT JOIN s USING (user_id) LEFT JOIN v USING (user_id)"""
)
def ambiguity_second_best(spark, sf):
    return _rounded(candidates.second_best(_events(spark, sf), "user_id", "value", "event_id", "event_id", 30, 100), "score_gap")


@query(
    """
WITH s AS (SELECT user_id, CAST(event_id AS DOUBLE) AS x, value AS y FROM events WHERE event_type <> 'view'),
p AS (SELECT event_id AS point_id, user_id, CAST(event_id AS DOUBLE) AS x FROM events WHERE event_type = 'view'),
lo AS (SELECT p.point_id, arg_max(s.x, s.x) AS x0, arg_max(s.y, s.x) AS y0 FROM p JOIN s ON s.user_id = p.user_id AND s.x <= p.x GROUP BY 1),
hi AS (SELECT p.point_id, arg_min(s.x, s.x) AS x1, arg_min(s.y, s.x) AS y1 FROM p JOIN s ON s.user_id = p.user_id AND s.x >= p.x GROUP BY 1)
SELECT p.user_id, p.point_id, p.x, round(CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x0 = x1 THEN y0 ELSE y0 + (y1 - y0) * (p.x - x0) / (x1 - x0) END, 6) AS value FROM p LEFT JOIN lo USING (point_id) LEFT JOIN hi USING (point_id)"""
)
def interp_asof(spark, sf):
    e = _events(spark, sf).withColumn("x", F.col("event_id").cast("double"))
    points = e.where("event_type = 'view'").select("user_id", "x", F.col("event_id").alias("point_id"))
    return _rounded(candidates.interpolate(e.where("event_type <> 'view'"), points, "user_id", "x", "value", "x"), "value")


@query(
    """
WITH c AS (SELECT user_id, median(value) AS m, count(*) AS n FROM events GROUP BY 1),
k AS (SELECT user_id, value, n FROM events JOIN c USING (user_id) WHERE abs(value - m) <= 30),
a AS (SELECT user_id, median(value) AS centre, count(*) AS votes, max(n) AS n FROM k GROUP BY 1 HAVING count(*) >= greatest(2, max(n) // 2 + 1)),
s AS (SELECT user_id, median(abs(value - centre)) AS spread FROM k JOIN a USING (user_id) GROUP BY 1)
SELECT user_id, n, votes, round(centre, 6) AS centre, round(spread, 6) AS spread FROM a JOIN s USING (user_id)"""
)
def consensus_vote(spark, sf):
    return _rounded(candidates.consensus(_events(spark, sf), "user_id", "value", 30.0), "centre", "spread")


@query("SELECT user_id, event_type, round(median(value), 6) AS fused, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY ALL")
def median_fuse(spark, sf):
    return _rounded(profiles.median_fuse(_events(spark, sf), ["user_id", "event_type"], "value"), "fused", "mean")


@query(
    """
WITH l AS (SELECT user_id, regr_slope(value, event_id) AS slope, regr_intercept(value, event_id) AS intercept FROM events GROUP BY 1),
r AS (SELECT user_id, value - slope * event_id - intercept AS r FROM events JOIN l USING (user_id))
SELECT user_id, round(any_value(slope), 7) AS slope, round(any_value(intercept), 4) AS intercept, count(*) AS n, round(sqrt(avg(r * r)), 5) AS rmse, round(median(abs(r)), 5) AS median_residual FROM r JOIN l USING (user_id) GROUP BY 1"""
)
def line_fit(spark, sf):
    out = fits.line_fit(_events(spark, sf), ["user_id"], "event_id", "value")
    return out.select("user_id", F.round("slope", 7).alias("slope"), F.round("intercept", 4).alias("intercept"), "n", F.round("rmse", 5).alias("rmse"), F.round("median_residual", 5).alias("median_residual"))


@query(
    """
WITH c AS (SELECT user_id, median(value) AS m, count(*) AS n FROM events GROUP BY 1),
t AS (SELECT * FROM (VALUES (1, 10.0), (2, 20.0), (3, 40.0)) v(attempt, tolerance)),
k AS (SELECT user_id, any_value(n) AS n, attempt, CAST(tolerance AS DOUBLE) AS tolerance, count(*) FILTER (abs(value - m) <= tolerance) AS inliers FROM events JOIN c USING (user_id), t GROUP BY user_id, attempt, tolerance)
SELECT user_id, n, attempt, tolerance, inliers FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY attempt) AS r FROM k WHERE inliers >= 0.6 * n) WHERE r = 1"""
)
def fit_retry_ladder(spark, sf):
    return fits.retry_ladder(_events(spark, sf), ["user_id"], "value", [10.0, 20.0, 40.0], 0.6)


@query(
    """
SELECT event_id, round(CASE WHEN hi - lo <= greatest(1e-6, greatest(abs(lo), abs(hi)) * 1e-6) THEN 0 ELSE (value - lo) / (hi - lo) END, 6) AS scaled
FROM (SELECT event_id, value, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY user_id))"""
)
def minmax_normalize(spark, sf):
    return _events(spark, sf).select("event_id", F.round(profiles.minmax("value", ["user_id"]), 6).alias("scaled"))


@query(
    """
WITH p AS (SELECT user_id, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events GROUP BY 1)
SELECT event_id, round(CASE WHEN hi > lo THEN least(1.0, greatest(0.0, (value - lo) / (hi - lo))) ELSE 0 END, 6) AS scaled FROM events JOIN p USING (user_id)"""
)
def percentile_scale(spark, sf):
    return profiles.percentile_scale(_events(spark, sf), ["user_id"], "value", 0.01, 0.99).select("event_id", F.round("scaled", 6).alias("scaled"))


@query(
    """
WITH h AS (SELECT event_type, CAST(least(255, floor(value)) AS BIGINT) AS level, count(*) AS n FROM events GROUP BY ALL),
c AS (SELECT *, sum(n) OVER r AS n0, sum(n * level) OVER r AS s0, sum(n) OVER w AS n1, sum(n * level) OVER w AS s1 FROM h WINDOW w AS (PARTITION BY event_type), r AS (PARTITION BY event_type ORDER BY level ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, CASE WHEN n1 > n0 THEN CAST(n0 AS DOUBLE) * (n1 - n0) * power(s0 / n0 - (s1 - s0) / (n1 - n0), 2) / (CAST(n1 AS DOUBLE) * n1) ELSE 0 END AS v FROM c)
SELECT event_type, level AS threshold, round(v, 4) AS variance FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY v DESC, level) AS k FROM b) WHERE k = 1"""
)
def otsu_threshold(spark, sf):
    rows = _events(spark, sf).withColumn("level", F.least(F.lit(255), F.floor("value")).cast("long"))
    return _rounded(profiles.otsu(rows, ["event_type"], "level"), "variance", places=4)


@query(
    """
SELECT user_id, event_id, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(s, 9) DESC, event_id) AS k FROM
  (SELECT user_id, event_id, (0.25 * least(1, value / 100) + 0.2 * (event_id % 7) / 7 + 0.15 * (event_id % 11) / 11) / 0.6 AS s FROM events)) WHERE k = 1"""
)
def weighted_score(spark, sf):
    score = candidates.weighted({"texture": (F.least(F.lit(1.0), F.col("value") / 100), 0.25), "edge": ((F.col("event_id") % 7) / 7.0, 0.2), "line": ((F.col("event_id") % 11) / 11.0, 0.15)})
    rows = candidates.top(_events(spark, sf).withColumn("score", score), ["user_id"], [F.desc(F.round("score", 9)), F.asc("event_id")], 1)
    return _rounded(rows.select("user_id", "event_id", "score"), "score")


@query(
    """
WITH f AS (SELECT user_id, event_id, value, value > 20 AS flag FROM events),
g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, flag ORDER BY event_id) AS isl FROM f),
r AS (SELECT user_id, flag, isl, count(*) AS n FROM g GROUP BY ALL)
SELECT f.user_id, coalesce(max(l.longest), 0) AS longest, round(avg(CASE WHEN flag THEN 1.0 ELSE 0.0 END), 6) AS fraction, round(quantile_cont(value, 0.9), 6) AS p90
FROM f LEFT JOIN (SELECT user_id, max(n) AS longest FROM r WHERE flag GROUP BY 1) l USING (user_id) GROUP BY 1"""
)
def longest_run(spark, sf):
    e = _events(spark, sf)
    r = profiles.runs(e, ["user_id"], "event_id", F.col("value") > 20).where("flag").groupBy("user_id").agg(F.max("length").alias("longest"))
    s = e.groupBy("user_id").agg(F.round(F.avg((F.col("value") > 20).cast("double")), 6).alias("fraction"), F.round(F.percentile("value", F.lit(0.9)), 6).alias("p90"))
    return s.join(r, "user_id", "left").select("user_id", F.coalesce("longest", F.lit(0)).alias("longest"), "fraction", "p90")


@query(
    """
SELECT event_id, round(avg(value) OVER w, 6) AS mean, round(stddev_pop(value) OVER w, 5) AS std FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"""
)
def box_filter_std(spark, sf):
    mean, std = profiles.box("value", ["user_id"], "event_id", 2)
    return _events(spark, sf).select("event_id", F.round(mean, 6).alias("mean"), F.round(std, 5).alias("std"))


@query(
    f"""
WITH p AS ({_LONG})
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(CASE WHEN lag(x) OVER w IS NULL THEN lead(x) OVER w - x WHEN lead(x) OVER w IS NULL THEN x - lag(x) OVER w ELSE (lead(x) OVER w - lag(x) OVER w) / 2 END, 9) AS g
FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY pos)"""
)
def profile_gradient(spark, sf):
    return _profile(spark, sf).select("vec_id", "pos", F.round(profiles.gradient("x", ["vec_id"], "pos"), 9).alias("g"))


@query(
    f"""
WITH p AS ({_LONG})
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(avg(x) OVER (PARTITION BY vec_id ORDER BY pos ROWS BETWEEN 2 FOLLOWING AND 5 FOLLOWING)
  - avg(x) OVER (PARTITION BY vec_id ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 3 PRECEDING), 9) AS c FROM p"""
)
def two_sided_contrast(spark, sf):
    return _profile(spark, sf).select("vec_id", "pos", F.round(profiles.two_sided_contrast("x", ["vec_id"], "pos", 2, 6), 9).alias("c"))


@query(
    f"""
WITH p AS ({_LONG}), n AS (SELECT *, lag(x) OVER w AS b, lead(x) OVER w AS a FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY pos))
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x, 9) AS x FROM n WHERE x > b AND x > a AND x >= 0.05"""
)
def local_peaks(spark, sf):
    return _rounded(profiles.local_peaks(_profile(spark, sf), ["vec_id"], "pos", "x", 0.05), "x", places=9)


@query(
    """
WITH x AS (SELECT user_id, event_type, CAST(event_id AS DOUBLE) AS x, (SELECT max(event_id) FROM events) AS r FROM events),
g AS (SELECT user_id, event_type, any_value(r) AS r, min(x) AS lo, max(x) AS hi, max(d) AS d FROM (SELECT *, lead(x) OVER (PARTITION BY user_id, event_type ORDER BY x) - x AS d FROM x) GROUP BY ALL)
SELECT user_id, event_type, greatest(coalesce(d, 0), lo - 0, CAST(r AS DOUBLE) - hi) AS max_gap FROM g"""
)
def support_gap(spark, sf):
    e = _events(spark, sf).select("user_id", "event_type", F.col("event_id").cast("double").alias("x"))
    right = e.agg(F.max("x")).first()[0]
    return profiles.largest_gap(e, ["user_id", "event_type"], "x", 0.0, right or 0.0)


@query(
    f"""
WITH p AS ({_LONG}), f AS (SELECT vec_id, pos, x >= 0 AS flag FROM p),
g AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY pos) - row_number() OVER (PARTITION BY vec_id, flag ORDER BY pos) AS isl FROM f)
SELECT vec_id, flag, CAST(min(pos) AS INTEGER) AS start, count(*) AS length FROM g GROUP BY vec_id, flag, isl"""
)
def rle_runs(spark, sf):
    return profiles.runs(_profile(spark, sf), ["vec_id"], "pos", F.col("x") >= 0)


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 9) AS energy FROM embeddings")
def vector_energy(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(exports.vector_energy(F.col("embedding")), 9).alias("energy"))
