"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents fall by a seeded hash into the blocks of their source; the number of blocks in all is bounded, so the plan
stays small at any size. A source whose target is f times its size and a rest takes each block f times, and
for the rest whole blocks in a seeded order and a part of one more block. The exact quotas of (source, block,
copy) units are split recursively among output shards: at each node of the tree the left half's units by source are
a multivariate-hypergeometric draw. A leaf then draws that many disjoint units of each source from the
source's permuted list. A leaf larger than SHARD_WORDS deals its rows by hash to partitions of its own, so that partitions keep
their size as the corpus grows; rows are shuffled locally.

A part of a block is taken along the block's seeded order, documents that no longer fit being passed over to its end. So every
document left has more words than the rest that is missed; where taking the smallest one left misses by less, it is taken
too, and a source misses its target by at most half of its open block's smallest document left. Sums of ranges of the order
tell which range holds the place where the rest is reached; only such a range, of about RANGE_ROWS rows, meets in a task.

Defined cases: a null text has size 0; null sources form one source, the last; documents of size 0 are taken as often as
their block; rows that repeat a doc_id and size in a block are taken alike; a very long document is taken whole or not at all; a source of no words has
target 0; a null doc_id hashes as a value of its own; an empty table gives no rows; other columns of any name are kept by mix(),
their values too, since they travel in a struct beside the plan's columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, query_rows, small_side, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3
MOST_BLOCKS = 4096  # in all, besides one for each source
LEAST_BLOCK_WORDS = 16384
SHARD_WORDS = 1 << 22  # of an output partition, about
MOST_LEAVES = 4096  # of the tree; a leaf has as many partitions as its words need
RANGE_ROWS = 50_000
SEED = 20240607
LEAST_ID, MOST_ID = -(1 << 63), (1 << 63) - 1


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Sources by code point, null last, weigh `weights` repeating; a target stops at `most` times its source's size and the excess is reshared."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        shares = sum(weigh[s] for s in order if s not in full)
        share = {s: rest * weigh[s] / shares for s in order if s not in full}
        over = {s for s, x in share.items() if x > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else float(share[s]) for s in order}
        full |= over


def leaves(units: np.ndarray, shards: int, rng: np.random.Generator, of: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """units: how many of each source -> for each leaf of the splitting tree its sources and how many of each; sums are exact."""
    if of is None:
        of = np.arange(len(units))
    if shards == 1:
        yield of, units
        return
    left = shards // 2
    draw = rng.multivariate_hypergeometric(units, int(units.sum()) * left // shards, method="marginals")
    for part, n in ((draw, left), (units - draw, shards - left)):
        some = part > 0
        yield from leaves(part[some], n, rng, of[some])


def split(units: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """shards x sources, the leaves of the splitting tree."""
    out = np.zeros((shards, len(units)), np.int64)
    for row, (of, n) in zip(out, leaves(units, shards, rng), strict=True):
        row[of] = n
    return out


@dataclass
class Plan:
    sources: DataFrame  # key, n_blocks, source_size, target
    units: DataFrame  # key, block, copies, leaves, and for a partly taken block: parts, extra
    partitions: int
    local: int  # partitions of a leaf


_POINT = "struct<v:long,id:long>"
_PARTS = f"array<struct<cap:long,first:{_POINT},end:{_POINT}>>"
_PLACE = "struct(v, coalesce(id, {LEAST_ID}) AS id)".replace("{LEAST_ID}", f"({LEAST_ID + 1}L - 1L)")


def _keyed(docs: DataFrame, seed: int, *more: F.Column) -> DataFrame:
    """key (of the source), id, size, u (which block), v (order in a block)."""
    source, i = F.col("source").cast("string"), F.col("doc_id").cast("long")
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
    return docs.select(key.alias("key"), i.alias("id"), size.alias("size"), F.xxhash64(F.lit(seed), i).alias("u"), F.xxhash64(F.lit(seed + 1), i).alias("v"), *more)


def _source(key: str) -> str | None:
    return key[1:] if key[0] == "s" else None


def _succ(v: int, i: int) -> dict | None:
    """The point after (v, i) in the order; None after the last."""
    if i < MOST_ID:
        return {"v": v, "id": i + 1}
    return {"v": v + 1, "id": LEAST_ID} if v < MOST_ID else None


def _inside() -> F.Column:
    """Whether a row (v, id, size) lies in one of `parts`."""
    return F.expr(f"exists(parts, p -> size <= p.cap AND (p.first IS NULL OR {_PLACE} >= p.first) AND (p.end IS NULL OR {_PLACE} < p.end))")


def make_plan(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED, most_blocks: int = MOST_BLOCKS) -> Plan:
    """rows: key, id, size, u, v. The driver holds a row for each source and for each of at most `most_blocks` blocks besides."""
    spark = rows.sparkSession
    sizes = {r[0]: r[1] for r in rows.groupBy("key").agg(F.sum("size")).collect()}
    goal = targets({_source(k): n for k, n in sizes.items()}, weights, most) if sizes else {}
    order = sorted(sizes, key=lambda k: (k[0] == "n", k))
    goal = {k: goal[_source(k)] for k in order}
    block_words = max(LEAST_BLOCK_WORDS, math.ceil(sum(sizes.values()) / most_blocks))
    n_blocks = {k: max(1, math.ceil(sizes[k] / block_words)) for k in order}
    sources = small_side(spark, [(k, n_blocks[k], sizes[k], goal[k]) for k in order], "key string, n_blocks long, source_size long, target double")
    placed = rows.join(sources, "key").withColumn("block", F.expr("pmod(u, n_blocks)"))
    words: dict[str, dict[int, int]] = {k: {} for k in order}
    for k, b, x in placed.groupBy("key", "block").agg(F.sum("size")).collect():
        words[k][b] = x
    rng = np.random.default_rng(seed)
    copies: dict[tuple[str, int], int] = {}
    open_: dict[str, tuple[int, int]] = {}  # source: partly taken block, words wanted of it
    for k in order:
        blocks = np.array(sorted(words[k]), np.int64)
        rng.shuffle(blocks)
        f = int(goal[k] // sizes[k]) if sizes[k] else 0
        rest = round(goal[k] - f * sizes[k])
        for b in blocks.tolist():
            whole = rest > 0 and words[k][b] <= rest
            rest -= words[k][b] if whole else 0
            copies[k, b] = f + whole
        if rest > 0 and (left := [b for b in blocks.tolist() if copies[k, b] == f and words[k][b]]):
            open_[k] = (left[0], rest)
    parts, extra = _cut(placed, open_)
    listed: dict[str, list[tuple[int, int]]] = {k: [] for k in order}
    for (k, b), c in copies.items():
        listed[k] += [(b, i) for i in range(c + (open_.get(k, (None,))[0] == b))]
    for x in listed.values():
        rng.shuffle(x)
    counts = np.array([len(listed[k]) for k in order], np.int64)
    taken = sum(min(goal[k], most * sizes[k]) for k in order)
    n_leaves = max(1, min(MOST_LEAVES, math.ceil(taken / SHARD_WORDS), int(counts.sum())))
    leaf_of: dict[tuple[str, int, int], int] = {}
    at = np.zeros(len(order), np.int64)
    for leaf, (of, n) in enumerate(leaves(counts, n_leaves, rng) if order else ()):
        for i, m in zip(of.tolist(), n.tolist(), strict=True):
            for b, c in listed[order[i]][at[i] : at[i] + m]:
                leaf_of[order[i], b, c] = leaf
            at[i] += m
    out = []
    for (k, b), c in copies.items():
        partly = open_.get(k, (None,))[0] == b
        out.append((k, b, c, [leaf_of[k, b, i] for i in range(c + partly)], parts[k] if partly else None, extra.get(k) if partly else None))
    units = small_side(spark, out, f"key string, block long, copies int, leaves array<int>, parts {_PARTS}, extra {_POINT}")
    local = max(1, math.ceil(taken / (n_leaves * SHARD_WORDS)))
    return Plan(sources, units, n_leaves * local, local)


_ARROW_POINT = pa.struct([("v", pa.int64()), ("id", pa.int64())])
_ARROW_PART = pa.struct([("cap", pa.int64()), ("first", _ARROW_POINT), ("end", _ARROW_POINT)])


def _walk(key, table):
    """Takes documents of one range of a block's order wherever they fit: the parts in which one cap tells, and what is left of the rest."""
    name, rest, cap = (x.as_py() for x in key[:3])
    t = table.to_pandas().sort_values(["v", "id"], kind="stable")
    first = {"v": int(key[3].as_py()), "id": int(key[4].as_py())} if key[3].as_py() is not None else None
    parts = []
    for v, i, size, least in zip(*(t[c].tolist() for c in ("v", "id", "total", "least")), strict=True):
        if size <= rest:
            rest -= size
        elif least <= cap:
            parts.append({"cap": cap, "first": first, "end": {"v": v, "id": i}})
            cap, first = rest, _succ(v, i)
    last = _succ(int(t["v"].iloc[-1]), int(t["id"].iloc[-1]))
    parts.append({"cap": cap, "first": first, "end": last})
    return pa.table({"key": pa.array([name], pa.string()), "rest": pa.array([rest], pa.int64()), "parts": pa.array([parts], pa.list_(_ARROW_PART)), "at": pa.array([last], _ARROW_POINT)})


def _cut(placed: DataFrame, part: dict[str, tuple[int, int]]) -> tuple[dict[str, list], dict[str, tuple[int, int]]]:
    """For each source's partly taken block: the parts of its order, in each of which documents up to a size are taken, and one more document that brings it nearer.

    A round walks one range of each open source, and ends a source when nothing behind the range fits any more.
    """
    if not part:
        return {}, {}
    spark = placed.sparkSession
    wanted = small_side(spark, [(k, b) for k, (b, _) in part.items()], "key string, block long")
    rows = written(placed.join(wanted, ["key", "block"]).select("key", "v", F.expr(_PLACE).getField("id").alias("id"), "size"), "mix-open")
    ranges = {r[0]: max(1, math.ceil(r[1] / RANGE_ROWS)) for r in rows.groupBy("key").count().collect()}
    rest = {k: x for k, (_, x) in part.items()}
    at: dict[str, dict | None] = dict.fromkeys(part)
    parts: dict[str, list] = {k: [] for k in part}
    active = set(part)
    while active:
        now = small_side(spark, [(k, rest[k], at[k], ranges[k]) for k in sorted(active)], f"key string, cap long, at {_POINT}, n long")
        left = rows.join(now, "key").where(f"size > 0 AND size <= cap AND (at IS NULL OR {_PLACE} >= at)")
        left = left.withColumn("range", F.expr("least(n - 1, CAST(floor((v / 18446744073709551616D + 0.5D) * n) AS BIGINT))"))
        sums: dict[str, list[tuple[int, int]]] = {k: [] for k in active}
        for k, r, x in left.groupBy("key", "range").agg(F.sum("size")).collect():  # about the block's rows / RANGE_ROWS
            sums[k].append((r, x))
        walks = []
        for k in sorted(active):
            before = 0
            for r, x in sorted(sums[k]):
                if before + x > rest[k]:
                    walks.append((k, r, rest[k] - before))
                    break
                before += x
            else:  # all that fits is taken
                parts[k].append({"cap": rest[k], "first": at[k], "end": None})
                rest[k] -= before
        active = {k for k, _, _ in walks}
        if not walks:
            break
        crossing = small_side(spark, walks, "key string, range long, rest long")
        groups = left.join(crossing, ["key", "range"]).groupBy("key", "rest", "cap", F.col("at.v").alias("at_v"), F.col("at.id").alias("at_id"), "v", "id").agg(F.sum("size").alias("total"), F.min("size").alias("least"))
        for r in groups.groupBy("key", "rest", "cap", "at_v", "at_id").applyInArrow(_walk, f"key string, rest long, parts {_PARTS}, at {_POINT}").collect():  # a row for each source
            parts[r.key] += [p.asDict(True) for p in r.parts]
            rest[r.key], at[r.key] = r.rest, r.at.asDict() if r.at else None
            if r.at is None:
                active.discard(r.key)
    missed = {k: x for k, x in rest.items() if x > 0}
    if not missed:
        return parts, {}
    found = small_side(spark, [(k, parts[k]) for k in missed], f"key string, parts {_PARTS}")
    groups = rows.join(found, "key").withColumn("in", _inside()).groupBy("key", "v", "id").agg(F.sum("size").alias("total"), F.max("in").alias("in")).where("NOT in AND total > 0")
    least = groups.groupBy("key").agg(F.min(F.struct("total", "v", "id")).alias("x")).collect()
    return parts, {r.key: (r.x.v, r.x.id) for r in least if r.x.total < 2 * missed[r.key]}


def _planned(rows: DataFrame, plan: Plan) -> DataFrame:
    """rows with taken (how often) and leaves (the leaf of each time)."""
    rows = rows.join(plan.sources, "key").withColumn("block", F.expr("pmod(u, n_blocks)")).join(plan.units, ["key", "block"])
    more = F.coalesce(F.col("parts").isNotNull() & (_inside() | F.expr(f"extra <=> {_PLACE}")), F.lit(False))
    return rows.withColumn("taken", F.col("copies") + more.cast("int")).withColumn("leaves", F.slice("leaves", F.lit(1), F.col("taken")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixed documents: docs' columns, each row as often as the mix takes it, dealt to partitions and shuffled within each."""
    plan = make_plan(written(_keyed(docs, seed), "mix-sizes"), weights, most, seed)
    rows = _planned(_keyed(docs, seed, F.struct("*").alias("row")), plan)
    rows = rows.select("row", "id", F.posexplode("leaves").alias("copy", "leaf"))
    rows = rows.withColumn("to", (F.col("leaf") * plan.local + F.pmod(F.xxhash64(F.lit(seed + 3), "id", "copy"), F.lit(plan.local))).cast("int"))
    rows = rows.repartitionById(plan.partitions, "to").sortWithinPartitions("to", F.xxhash64(F.lit(seed + 2), "id", "copy"))
    return rows.select("row.*")


def report(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, leaves."""
    rows = written(_keyed(docs, seed), "mix-sizes")
    rows = _planned(rows, make_plan(rows, weights, most, seed))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("taken")).cast("long").alias("taken"), F.col("taken").alias("copies"), "leaves")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return report(query_rows(spark, sf_dir))


QUERIES: dict[str, Query] = {"op2_mixing": op2_mixing}
ORACLE: dict[str, str] = {}
