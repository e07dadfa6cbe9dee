"""The n-gram join where shingles, copies and components are hot, and on slices of very long texts."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import common, ngram_join

from .test_operators import linked, prose


@pytest.fixture
def tight(monkeypatch):
    """Everything is hot: shingles dealt to parts, few broadcast keys, small cells."""
    monkeypatch.setattr(ngram_join, "HOT_TIMES", 0)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 3)
    monkeypatch.setattr(common, "HOT", 20)


def test_hot_groups(spark, tight):
    rng = random.Random(4)
    a, b = prose("en", 60, rng).split(), prose("de", 45, rng).split()
    rows = []
    for i in range(240):
        words = (a if i % 3 else b + prose("en", 6, rng).split())[:]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, rows[1][1]) for i in range(90)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows)


def test_cells(spark):
    left = spark.range(500).select(F.expr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END").alias("k"), F.col("id").alias("x"))
    right = spark.range(300).select(F.expr("CASE WHEN id % 2 = 0 THEN 1 ELSE id % 40 END").alias("k"), F.col("id").alias("y"))
    got = sorted(tuple(r) for r in common.cell_join(left, right, "k", ("x", "y"), 16).select("k", "x", "y").collect())
    assert got == sorted(tuple(r) for r in left.join(right, "k").select("k", "x", "y").collect())


def test_texts_beyond_a_slice(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", 300)
    rng = random.Random(9)
    long = prose("en", 900, rng)
    rows = [(0, long), (1, long + " and more"), (2, "short"), (3, None), (4, "\n\t "), (5, prose("en", 40, rng)), (6, "Short")]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows)


def test_near_keeps_columns_named_like_its_own(spark):
    names = ["_id", "id", "row", "component_id", "n_shingles", "a.b"]
    text = prose("en", 50)
    docs = spark.createDataFrame([(i, text + " end" * i if i < 3 else f"other {i} " + prose("de", 20), *(f"{k}-{i}" for k in range(len(names)))) for i in range(6)], ["doc_id", "text", *(f"c{k}" for k in range(len(names)))]).toDF("doc_id", "text", *names)
    kept = corpus_pipeline.near(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in docs.where("doc_id IN (0, 3, 4, 5)").collect())


def test_intermediate_tables_go(spark):
    import os

    folder = os.path.join(common.shared_dir(spark).removeprefix("file://"), "plumbline")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ngram_join.join(spark.createDataFrame([(i, prose("en", 30)) for i in range(8)], "doc_id long, text string")).count()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left <= {"ngram-scan", "edges", "join-hot"}
