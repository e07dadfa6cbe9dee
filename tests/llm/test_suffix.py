"""Dealing of windows: many groups in two steps, hot anchors window by window, and the cost of a batch."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import suffix_dedup

from .test_operators import ROWS, SCHEMA, by_id, cut


@pytest.mark.parametrize("fan", [3, 8192])
@pytest.mark.parametrize("times", [0, 1e-4, 1e9])
def test_all_ways_of_dealing_agree(spark, monkeypatch, fan, times):
    monkeypatch.setattr(suffix_dedup, "FAN", fan)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "HOT_TIMES", times)
    monkeypatch.setattr(suffix_dedup, "BATCH_ROWS", 300)
    got = by_id(suffix_dedup.dedup(spark.createDataFrame(ROWS, SCHEMA).repartition(5)))
    assert {i: tuple(r[0][1:5]) for i, r in got.items()} == cut(ROWS, 50)


def hot_rows(n):
    rng = random.Random(2)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    rows = [(i, word(40) + "the same phrase of 30 bytes.. " + word(40)) for i in range(n)]
    long = word(60)
    return rows + [(n + i, word(9) + long + word(9)) for i in range(n)]


def test_a_hot_anchor_spreads(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACES", 64)
    rows = hot_rows(500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    total = sum(len(t) for _, t in rows)
    window = suffix_dedup.WINDOW

    def largest(hot):
        monkeypatch.setattr(suffix_dedup, "HOT_TIMES", 6 if hot else 1e9)
        deal = suffix_dedup.Deal(suffix_dedup.Shape(window), 200, suffix_dedup.hot_anchors(docs, total, window))
        blobs = docs.mapInArrow(suffix_dedup._deal(deal, 1), "group long, blob binary").collect()
        n = {}
        for r in blobs:
            n[r.group] = n.get(r.group, 0) + len(suffix_dedup._decode(bytes(r.blob))["left"])
        return max(n.values()) / sum(n.values())

    assert largest(True) < 0.03 < largest(False)
    monkeypatch.setattr(suffix_dedup, "HOT_TIMES", 6)
    got = by_id(suffix_dedup.dedup(docs))
    assert {i: tuple(r[0][1:5]) for i, r in got.items()} == cut(rows, 50)


def test_a_batch_costs_no_more_with_more_groups():
    rng = np.random.default_rng(0)
    text = pa.array(["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(100)])
    sizes = []
    for groups in (8192, 25_000_000):
        deal = suffix_dedup.Deal(suffix_dedup.Shape(50), groups, np.zeros(1 << 12, bool))
        fine = -(-groups // suffix_dedup.FAN)
        batch = pa.RecordBatch.from_arrays([pa.array(range(100)), text], names=["doc_id", "text"])
        out = list(suffix_dedup._deal(deal, fine)([batch]))
        sizes.append((sum(b.num_rows for b in out), sum(b.nbytes for b in out)))
    assert abs(sizes[1][0] - sizes[0][0]) < 0.1 * sizes[0][0] and sizes[1][1] < 1.1 * sizes[0][1]


def test_nulls_repeats_and_many_bytes(spark):
    rows = [(1, None), (None, "x" * 200), (2, "é" * 60), (3, "é" * 60), (3, "é" * 60), (4, ""), (5, "y" * 49), (6, "y" * 49)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").withColumn("group", F.lit(1)).withColumn("spans", F.lit("x"))).collect()
    removed = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in got)
    assert removed == [(0, 200, 0, 0), (1, 0, 0, 0), (2, 120, 0, 0), (3, 120, 120, 1), (3, 120, 120, 1), (4, 0, 0, 0), (5, 49, 0, 0), (6, 49, 0, 0)]
