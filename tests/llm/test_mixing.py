"""The mix at its edges: cuts of long orders, many sources, columns named like the plan's own, targets by exact fractions."""

from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing


def fractions(sizes, weights=(1, 2, 3), most=3):
    """Shares by water level: sources in order of how soon they fill up, each at its cap or at the common level."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, left = sum(sizes.values()), {}, dict(sizes)
    while left:
        level = Fraction(total - sum(out.values()), sum(weigh[s] for s in left))
        full = min(left, key=lambda s: Fraction(most * sizes[s], weigh[s]))
        if most * sizes[full] >= level * weigh[full]:
            return out | {s: level * weigh[s] for s in left}
        out[full] = Fraction(most * sizes[full])
        del left[full]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_targets_against_fractions(seed):
    rng = np.random.default_rng(seed)
    sizes = {None if i == 0 and seed % 2 else f"s{i}": int(n) for i, n in enumerate(rng.integers(0, 10 ** rng.integers(1, 6, 9)))}
    if not sum(sizes.values()):
        return
    want, got = fractions(sizes), mixing.targets(sizes)
    assert all(got[s] == pytest.approx(float(want[s]), rel=1e-9, abs=1e-6) for s in sizes)


def wanted(rows):
    taken, target, left = Counter(), {}, defaultdict(list)
    for r in rows:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        left[r.source_size].append(r)
    return [(target[k], taken[k], left[k]) for k in target]


@pytest.mark.parametrize("range_rows", [7, 50, 100_000])
def test_cut_of_a_long_order(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "LEAST_BLOCK_WORDS", 1 << 30)  # one block for each source
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rng = np.random.default_rng(3)
    size = np.minimum(rng.pareto(0.8, 900) * 9, 20000).astype(int) + 1
    rows = [(i, "w " * int(n), "abc"[i % 3]) for i, n in enumerate(size)]
    rows += [(5, "w " * 900, "c"), (8, "w", "c"), (None, "w w", "a"), (None, "w " * 70, "a")]  # one doc_id with unlike texts
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.report(docs).collect()
    assert len(got) == len(rows)
    for target, taken, of in wanted(got):
        f = int(target // of[0].source_size)
        spare = [r.size for r in of if r.copies == f and r.size]
        assert abs(taken - target) <= max(1, min(spare, default=0) / 2 + 0.5, 0 if spare else 1)
    mixed = Counter(r.n for r in mixing.mix(docs).select(F.length("text").alias("n")).collect())
    words = Counter()
    for r in got:
        words[r.size] += r.copies
    assert sum(words.values()) == sum(mixed.values())


def test_many_sources(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', CAST(id % 50 AS INT) + 1)").alias("text"), F.expr("concat('s', id DIV 2)").alias("source"))
    got = mixing.report(docs).collect()
    assert len(got) == 6000 and all(r.taken <= 3 * r.size for r in got)
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - total) < 0.3 * total  # a source of two documents can't be cut finely


def test_columns_named_like_the_plans(spark):
    names = ["key", "id", "size", "u", "v", "block", "n_blocks", "copies", "leaves", "leaf", "copy", "to", "parts", "extra", "row", "taken", "target", "source_size", "b_n", "u_more", "u_block", "_mix_copy", "_mix_size", "a.b"]
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', CAST(id AS INT))").alias("text"), F.lit("x").alias("source"), *(F.concat(F.lit(f"{n}-"), F.col("id")).alias(f"own{k}") for k, n in enumerate(names)))
    docs = docs.toDF("doc_id", "text", "source", *names)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        assert all(r[3 + k] == f"{n}-{r.doc_id}" for k, n in enumerate(names)) and r.text == "w " * r.doc_id
    assert mixing.report(docs).count() == 40


def test_leaves_deal_to_partitions_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 200)
    monkeypatch.setattr(mixing, "MOST_LEAVES", 3)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("w w w w w w w w w w").alias("text"), F.expr("concat('s', id % 2)").alias("source"))
    mixed = mixing.mix(docs)
    n = mixed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(n) > 3 and sum(r["count"] for r in n) == mixed.count()
