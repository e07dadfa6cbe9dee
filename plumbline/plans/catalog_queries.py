"""Catalogue, reference, join and evaluation operators over the supplied tables, with DuckDB SQL beside each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boundary, catalog, evaluate, fits, reference
from ..sources import truth
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


_REL = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"


@query(
    f"""
WITH r AS (SELECT page_id, {_REL} AS rel, string_split({_REL}, '/') AS p FROM pages)
SELECT page_id, rel, p[-1] AS name, regexp_extract(p[1], '^([^.]*)', 1) AS host_case, lower(string_split(p[1], '-')[1]) AS case_key,
       CASE WHEN len(p) > 2 THEN array_to_string(p[1:len(p) - 2], '/') ELSE '' END AS scene,
       string_split(regexp_replace(p[-1], '^(.+)\\.[^.]*$', '\\1'), '_')[1] AS camera, regexp_replace(rel, '([^/])\\.[^./]*$', '\\1') || '.txt' AS label_path
FROM r"""
)
def scan_identity(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "").alias("rel"))
    rows = catalog.with_identity(rows, "rel")
    return rows.select("page_id", "rel", "name", F.regexp_extract(F.split("rel", "/")[0], "^([^.]*)", 1).alias("host_case"), "case_key", "scene", "camera", "label_path")


@query(
    f"""
SELECT page_id, {_REL} AS rel FROM pages
WHERE lower(string_split({_REL}, '/')[-2]) IN ('en', 'fr') AND {_REL} LIKE '%.com/%' AND regexp_matches(string_split({_REL}, '/')[-1], '^[0-9]+$')
ORDER BY string_split({_REL}, '/')"""
)
def scan_filter(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "").alias("rel"))
    p = F.split("rel", "/")
    rows = rows.where(F.lower(F.try_element_at(p, F.lit(-2))).isin("en", "fr") & F.col("rel").contains(".com/") & F.try_element_at(p, F.lit(-1)).rlike("^[0-9]+$"))
    return rows.orderBy(p)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), 'default') AS option FROM events")
def json_option_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("default")).alias("option"))


@query("SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS class_id, trim(n_name) AS class_name FROM nation WHERE trim(n_name) <> ''")
def label_map(spark, sf):
    return catalog.class_ids(table(spark, sf, "nation"), "n_nationkey", "n_name")


@query(
    """
WITH e AS (SELECT event_id, user_id, event_type, props AS name FROM events),
f AS (SELECT user_id, event_type, count(*) AS frames FROM e GROUP BY ALL),
g AS (SELECT user_id, max(frames) AS most, sum(CASE WHEN event_type = 'signup' THEN frames ELSE 0 END) AS refs FROM f GROUP BY ALL),
n AS (SELECT user_id, name, max(event_id) AS named_id FROM e WHERE event_type = 'signup' GROUP BY ALL),
l AS (SELECT user_id, max(event_id) AS lone_id FROM e WHERE event_type = 'signup' GROUP BY ALL),
r AS (SELECT e.event_id, coalesce(named_id, CASE WHEN refs = 1 AND most = 1 THEN lone_id END) AS ref_id, refs
      FROM e JOIN g USING (user_id) LEFT JOIN n ON n.user_id = e.user_id AND n.name = e.name LEFT JOIN l ON l.user_id = e.user_id)
SELECT event_id, ref_id, CASE WHEN ref_id IS NOT NULL THEN NULL WHEN refs = 0 THEN 'missing_reference' ELSE 'ambiguous_reference' END AS reason FROM r"""
)
def reference_assign(spark, sf):
    return reference.assign_references(table(spark, sf, "events").select("event_id", "user_id", "event_type", "props"), ["user_id"], "props", "event_type", "signup", "event_id")


@query(
    """
SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, o_orderstatus AS parent, l_linestatus AS child,
       CASE WHEN o_orderstatus = l_linestatus THEN 'reused' ELSE 'reference_size_mismatch' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def geometry_reuse(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("parent"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_linestatus").alias("child"))
    return reference.reuse_geometry(o, li, "orderkey", F.col("parent"), F.col("child")).select("orderkey", "linenumber", "parent", "child", "status")


@query(
    """
WITH d AS (SELECT doc_id, doc_id % 5 <> 0 AS found, doc_id % 3 = 0 AS review, (doc_id % 11) / 10.0 AS slope FROM documents)
SELECT doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'manual' WHEN found THEN 'fitted' ELSE 'no_roi' END AS status, found OR l.doc_id IS NOT NULL AS found, review AND l.doc_id IS NULL AS needs_review,
  CASE WHEN l.doc_id IS NOT NULL THEN CAST(quality AS DOUBLE) WHEN found THEN CAST(slope AS DOUBLE) END AS top_slope FROM d LEFT JOIN labels l USING (doc_id)"""
)
def override_coalesce(spark, sf):
    """Detected rows under manual ones: documents as images, labels as overrides."""
    i, found = F.col("doc_id"), F.col("doc_id") % 5 != 0
    lines = lambda v: [v.cast("double").alias(f"{s}_{k}") for s in ("top", "bottom") for k in ("slope", "intercept")]
    d = table(spark, sf, "documents").select(
        i.cast("string").alias("rel_path"), F.lit("std").alias("mode"), F.when(found, "fitted").otherwise("no_roi").alias("status"), found.alias("found"), (i % 3 == 0).alias("needs_review"), F.lit(100).alias("input_height"),
        F.lit(50).alias("input_width"), *lines(F.when(found, (i % 11) / 10.0)),
    )
    o = table(spark, sf, "labels").select(i.cast("string").alias("rel_path"), F.lit("std").alias("mode"), F.lit(100).alias("height"), F.lit(50).alias("width"), *lines(F.col("quality")))
    return truth.apply_overrides(d, o).select(F.col("rel_path").cast("long").alias("doc_id"), "status", "found", "needs_review", "top_slope")


@query(
    """
WITH x AS (SELECT s.split, d.doc_id, l.quality = 0 AS evaluated, l.toxic = 0 AS passed, d.n_chars
  FROM (VALUES ('tune'), ('validation')) s(split) LEFT JOIN documents d ON d.source <> 'none' AND s.split = CASE WHEN d.doc_id % 4 = 0 THEN 'validation' ELSE 'tune' END LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT split, count(doc_id) AS approved_gt_scenes, count(*) FILTER (evaluated) AS geometry_evaluated, count(*) FILTER (passed) AS automatic_pass_count, count(*) FILTER (passed AND NOT coalesce(evaluated, FALSE)) AS false_pass_count,
  round(count(*) FILTER (passed) / nullif(count(doc_id), 0), 6) AS scene_pass_rate, round(count(*) FILTER (passed AND NOT coalesce(evaluated, FALSE)) / nullif(count(*) FILTER (passed), 0), 6) AS false_pass_rate,
  round(avg(CASE WHEN evaluated THEN n_chars END), 6) AS mean_top_mae_px FROM x GROUP BY split"""
)
def gt_left_eval(spark, sf):
    """The evaluation's summary by split: every ground truth counts, known to the report or not."""
    d = table(spark, sf, "documents").where("source <> 'none'").select("doc_id", F.col("n_chars").cast("double").alias("n"), F.when(F.col("doc_id") % 4 == 0, "validation").otherwise("tune").alias("split"))
    x = d.join(table(spark, sf, "labels"), "doc_id", "left")
    done, passed = F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce(F.col("toxic") == 0, F.lit(False))
    x = x.select("split", done.alias("geometry_evaluated"), passed.alias("auto_pass"), (passed & ~done).alias("false_pass"), *(F.col("n").alias(m) for m in evaluate.METRICS))
    out = evaluate.summary(x)
    return out.select("split", "approved_gt_scenes", "geometry_evaluated", "automatic_pass_count", "false_pass_count", *(F.round(c, 6).alias(c) for c in ("scene_pass_rate", "false_pass_rate", "mean_top_mae_px")))


@query(
    """
SELECT CAST(doc_id AS VARCHAR) AS rel_path, mode, round((doc_id % 30 - doc_id % 20) / 99.0, 9) AS top_slope, CAST(doc_id % 20 AS DOUBLE) AS top_intercept, CAST(60 + doc_id % 7 AS DOUBLE) AS bottom_intercept
FROM labels, (VALUES ('std'), ('fft')) m(mode) WHERE quality = 1"""
)
def truth_overrides(spark, sf):
    """Approved ground truth as overrides of two modes."""
    i = F.col("doc_id")
    line = lambda a, b: F.array(F.array(F.lit(0.0), a.cast("double")), F.array(F.lit(99.0), b.cast("double")))
    t = table(spark, sf, "labels").select(
        i.cast("string").alias("source"), F.lit("tune").alias("split"), F.when(F.col("quality") == 1, "approved").otherwise("pending").alias("status"), F.lit(100).alias("height"), F.lit(100).alias("width"),
        line(i % 20, i % 30).alias("top"), line(60 + i % 7, 60 + i % 7).alias("bottom"),
    )
    out = truth.overrides_from_truth(truth.checked(t), ["std", "fft"])
    return out.select("rel_path", "mode", F.round("top_slope", 9).alias("top_slope"), "top_intercept", "bottom_intercept")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_companion(spark, sf):
    return reference.missing_companions(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id")


@query(
    """
WITH r AS (SELECT a.event_id AS id, b.event_id AS template, b.value,
             row_number() OVER (PARTITION BY a.event_id ORDER BY b.value DESC, b.event_id) AS rank
  FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id <> b.event_id WHERE a.value < 5)
SELECT id AS event_id, template, rank FROM r WHERE rank <= 3"""
)
def template_match(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return reference.template_match(e, "event_id", ["user_id", "event_type"], "value", F.col("value") < 5)


@query(
    """
WITH r AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/')[1] AS host, lower(regexp_extract(url, '([^/]*)$', 1)) AS leaf FROM pages)
SELECT host AS key FROM r GROUP BY 1 HAVING count(*) > 1 UNION SELECT leaf FROM r GROUP BY 1 HAVING count(*) > 1"""
)
def duplicate_keys(spark, sf):
    rows = table(spark, sf, "pages").select("url")
    return reference.duplicate_keys(rows, F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/")[0], F.lower(F.regexp_extract("url", "([^/]*)$", 1)))


@query(
    """
SELECT d.source AS case_key, count(DISTINCT l.toxic) AS splits, count(*) AS n
FROM documents d JOIN labels l USING (doc_id) GROUP BY 1 HAVING count(DISTINCT l.toxic) > 1"""
)
def case_split_check(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.col("source").alias("case_key")).join(table(spark, sf, "labels"), "doc_id")
    return reference.case_splits(rows, "case_key", "toxic")


@query(
    """
SELECT r_name AS case_key, n, n >= 0 AS chosen FROM (SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1) s
WHERE r_name IN (SELECT r_name FROM (SELECT r_name, sum(count(*)) OVER (ORDER BY r_name) AS total FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1) WHERE total <= 10)"""
)
def group_total_subset(spark, sf):
    """Cases, in order, whose sizes sum to 10; regions are of one size, so that the first ones are the first set found."""
    rows = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    sizes = rows.groupBy(F.col("r_name").alias("case_key")).agg(F.count(F.lit(1)).alias("n"))
    chosen = reference.exact_total([(r.case_key, r.n) for r in sizes.collect()], 10) or []  # a row for each case: a hand-made manifest
    return sizes.where(F.col("case_key").isin(chosen)).withColumn("chosen", F.lit(True))


@query("SELECT user_id, event_type AS status, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def status_summary(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    """
SELECT conv_id, turn, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 10 AS BIGINT) AS batch,
       'tasks_' || lpad(CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 10 + 1 AS VARCHAR), 3, '0') || '.json' AS file FROM conversations"""
)
def batch_of_ten(spark, sf):
    from ..operators.exports import batches

    return batches(table(spark, sf, "conversations"), ["conv_id"], "turn", 10).select("conv_id", "turn", "batch", "file")


@query(
    """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice > 400000 THEN 'height_out_of_range' END, CASE WHEN o_orderstatus = 'P' THEN 'low_coverage' END,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'ambiguous' END], lambda x: x IS NOT NULL), ';') AS reasons,
  CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'P' OR o_orderpriority LIKE '1%' THEN 'NEEDS_REVIEW' WHEN o_orderpriority LIKE '2%' THEN 'RECOVERED' ELSE 'PASS' END AS status,
  CASE WHEN o_totalprice > 400000 THEN 'height_out_of_range' WHEN o_orderstatus = 'P' THEN 'low_coverage' WHEN o_orderpriority LIKE '1%' THEN 'ambiguous' END AS first_reason
FROM orders"""
)
def quality_gates(spark, sf):
    tests = {"height_out_of_range": F.col("o_totalprice") > 400000, "low_coverage": F.col("o_orderstatus") == "P", "ambiguous": F.col("o_orderpriority").startswith("1")}
    reasons = fits.gates(tests)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(F.array_distinct(reasons), ";").alias("reasons"), fits.status(reasons, F.col("o_orderpriority").startswith("2")).alias("status"), fits.first_reason(tests).alias("first_reason")
    )


@query(
    """
SELECT o_custkey AS custkey, o_orderkey AS orderkey, CAST(NULL AS VARCHAR) AS reason FROM orders
UNION ALL SELECT c_custkey, NULL, 'no_order' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def union_rejects(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey")).join(o.select("custkey").distinct(), "custkey", "left_anti")
    return o.unionByName(c.withColumn("reason", F.lit("no_order")), allowMissingColumns=True)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem ORDER BY 1 LIMIT 25)")
def limit_references(spark, sf):
    return catalog.limit_groups(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", 25).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """
SELECT custkey, 'both' AS side FROM (SELECT c_custkey AS custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT custkey, 'customer_only' FROM (SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders)"""
)
def set_ops(spark, sf):
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("custkey")), table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    return c.intersect(o).withColumn("side", F.lit("both")).union(c.subtract(o).withColumn("side", F.lit("customer_only")))


@query(
    """
WITH s AS (SELECT l_orderkey, l_returnflag, list_sort(list(DISTINCT l_suppkey)) AS xs FROM lineitem GROUP BY ALL)
SELECT a.l_orderkey, len(list_intersect(a.xs, b.xs)) AS common, len(list_distinct(list_concat(a.xs, b.xs))) AS either
FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = 'N' AND b.l_returnflag = 'R'"""
)
def support_overlap(spark, sf):
    """Supporting positions of both sides: shared and in all."""
    li = table(spark, sf, "lineitem").where("l_returnflag IN ('N', 'R')")
    return boundary.support_overlap(li, ["l_orderkey"], F.col("l_returnflag") == "N", "l_suppkey").select("l_orderkey", "common", "either")


@query(
    """
SELECT l_returnflag, round(avg(abs(l_quantity - l_tax * 100)), 6) AS mae, round(sqrt(avg(power(l_quantity - l_tax * 100, 2))), 6) AS rmse,
       round(max(abs(l_quantity - l_tax * 100)), 6) AS worst, round(quantile_cont(abs(l_quantity - l_tax * 100), 0.95), 6) AS p95
FROM lineitem GROUP BY 1"""
)
def error_metrics(spark, sf):
    out = fits.errors(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_quantity"), F.col("l_tax") * 100)
    return out.select("l_returnflag", *(F.round(c, 6).alias(c) for c in ("mae", "rmse", "worst", "p95")))


@query(
    """
WITH x AS (SELECT l_suppkey, l_quantity AS a0, l_quantity + 10 AS a1, l_quantity + l_discount * 40 AS b0, l_quantity + 12 + l_discount * 40 AS b1 FROM lineitem),
s AS (SELECT l_suppkey, sum(a1 - a0) AS a, sum(b1 - b0) AS b, sum(greatest(0, least(a1, b1) - greatest(a0, b0))) AS i FROM x GROUP BY 1)
SELECT l_suppkey, round(a - i, 4) AS under, round(b - i, 4) AS over, round((a - i) / greatest(a, 1), 6) AS under_fraction, round((b - i) / greatest(a, 1), 6) AS over_fraction, round(i / (a + b - i), 6) AS iou FROM s"""
)
def interval_iou(spark, sf):
    q, shift = F.col("l_quantity"), F.col("l_discount") * 40
    out = fits.interval_overlap(table(spark, sf, "lineitem"), ["l_suppkey"], q, q + 10, q + shift, q + 12 + shift)
    return out.select("l_suppkey", F.round("under", 4).alias("under"), F.round("over", 4).alias("over"), *(F.round(c, 6).alias(c) for c in ("under_fraction", "over_fraction", "iou")))


@query(
    """
SELECT user_id, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(max(value) - min(value), 6) AS variation, round(avg(CASE WHEN value < 5 THEN 1.0 ELSE 0.0 END), 6) AS zero_fraction
FROM events GROUP BY 1"""
)
def pair_height_stats(spark, sf):
    out = fits.height_stats(table(spark, sf, "events"), ["user_id"], F.col("value"), F.col("value") < 5)
    return out.select("user_id", *(F.round(c, 6).alias(c) for c in ("mean", "std", "variation", "zero_fraction")))


