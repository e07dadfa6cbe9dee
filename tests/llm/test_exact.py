"""Exact dedup: compaction over levels, hot groups, columns named like its own."""

import hashlib

from pyspark.sql import functions as F

from plumbline.llm import common, exact_dedup


def test_levels_compact_to_the_same_as_all_at_once(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 70).alias("text")).repartition(6)
    once = exact_dedup.compact(exact_dedup.level0(docs, rows=20))
    first, then = docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 > 0")
    twice = exact_dedup.compact(exact_dedup.compact(exact_dedup.level0(first, rows=11)), exact_dedup.level0(then, rows=50))
    rows = sorted(once.collect())
    assert rows == sorted(twice.collect()) and len(rows) == 70
    want = {hashlib.sha256(f"t{k}".encode()).digest(): [i for i in range(900) if i % 70 == k] for k in range(70)}
    assert all((r.n, r.nulls, r.lo, r.hi) == (len(want[bytes(r.digest)]), 0, min(want[bytes(r.digest)]), max(want[bytes(r.digest)])) for r in rows)


def test_runs_are_sorted(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text")).coalesce(2)
    runs = exact_dedup.level0(docs, rows=40).collect()
    by = {}
    for r in runs:
        by.setdefault(r.run, []).append(bytes(r.digest))
    assert len(by) > 4 and all(x == sorted(x) for x in by.values())


def test_a_third_of_all_rows_are_one_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN '' ELSE concat('t', id DIV 6) END").alias("text")).repartition(7)
    got = exact_dedup.dedup(docs, "largest", memtable_rows=100, memtable_bytes=3000).collect()
    assert len(got) == 3000 and sum(r.kept for r in got) == 2 + len({i // 6 for i in range(3000) if i % 3 == 2})
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3 == 0} == {(2997, 1000)}


def test_hot_join_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 4)
    rows = spark.range(400).select(F.expr("CASE WHEN id % 2 = 0 THEN 0 ELSE id % 41 END").alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    got = sorted(tuple(r) for r in common.hot_join(rows, groups, "k", "n").select("k", "id", "n").collect())
    assert got == sorted(tuple(r) for r in rows.join(groups, "k").select("k", "id", "n").collect())


def test_kept_rows_keep_the_values_of_any_column(spark):
    names = ["_key", "_id", "_sha", "row", "id", "unknown", "text_sha256", "digest", "sha", "kept", "keep_id", "n", "a.b"]
    docs = spark.range(60).select((F.col("id") % 50).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 25).alias("text"), *(F.concat(F.lit(f"{k}-"), F.col("id") % 50) for k in range(len(names)))).toDF("doc_id", "text", *names)
    kept = exact_dedup.kept_rows(docs, "largest")
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == 25 and all(r.doc_id >= 25 and all(r[2 + k] == f"{k}-{r.doc_id}" for k in range(len(names))) for r in rows)
