"""Exact dedup by a log-structured merge index.

Level 0: each task fills a memtable of digests, bounded in entries, and flushes it as a run sorted by digest, with the copies
of each digest and their least and greatest identifier. Compaction streams sorted runs (and earlier levels) through a merge: of
each digest one entry goes on, with the smallest and largest identifier and the number of copies; it decides which row
stays. A level can be kept and compacted with later runs.

Byte verification: a digest with several copies is a hit. Hits set bits of a filter of at most 8 MB, so that texts which
certainly stand alone never move. Each memtable sends a hit's whole text once, however many copies it holds; where a digest's
least and greatest text are the same bytes, the compacted entry stands. Where they differ, the digest's entries are merged
again by digest and whole text, so that two texts sharing a digest never merge.

Verdicts go back to the memtables' lists of identifiers by digest; digests holding more than a 1/HOT part of all rows, at
most HOT of them, are broadcast, so that a group of a third of all rows doesn't meet in a task.

Defined cases: a null text counts as empty; empty texts equal each other; very long texts are digested and compared whole; rows with the same doc_id and
text count once each towards group_size; a null doc_id is never kept before a number, and a group
of null doc_ids alone has a null keep_id; an empty table gives no rows; other columns of any name are ignored, and kept by kept_rows().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, build_filter, freeing, hot_join, in_filter, query_rows, written

MEMTABLE_ROWS = 100_000
MEMTABLE_BYTES = 48 << 20
_RUN = "digest binary, run string, n long, nulls long, lo long, hi long"
_LEVEL = "digest binary, n long, nulls long, lo long, hi long"
_ENTRY = "digest binary, sha binary, text string, ids array<long>, nulls long"


def _key(digest: pa.Array) -> np.ndarray:
    return np.array([int.from_bytes(x[:8].ljust(8, b"\0"), "little", signed=True) for x in digest.to_pylist()], np.int64)


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty), sha."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))


def level0(docs: DataFrame, digest_bytes: int = 32, rows: int = MEMTABLE_ROWS) -> DataFrame:
    """Runs, each sorted by digest: one entry per digest in a memtable."""

    def fill(batches):
        table: dict[bytes, list] = {}
        flushed = 0

        def flush():
            run = f"{TaskContext.get().partitionId()}-{flushed}"
            keys = sorted(table)
            cols = [table[k] for k in keys]
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([run] * len(keys), pa.string()), *(pa.array([c[i] for c in cols], pa.int64()) for i in range(4))], names=["digest", "run", "n", "nulls", "lo", "hi"]
            )
            table.clear()
            return out

        for b in batches:
            for i, d in zip(b.column("doc_id").to_pylist(), b.column("digest").to_pylist(), strict=True):
                if (x := table.get(d)) is None:
                    table[d] = [1, int(i is None), i, i]
                else:
                    x[0] += 1
                    if i is None:
                        x[1] += 1
                    else:
                        x[2], x[3] = i if x[2] is None else min(x[2], i), i if x[3] is None else max(x[3], i)
                if len(table) >= rows:
                    yield flush()
                    flushed += 1
        yield flush()

    return _digests(docs).select("doc_id", F.substring("sha", 1, digest_bytes).alias("digest")).mapInArrow(freeing(fill), _RUN)


def _merge(batches):
    """Entries in order of digest -> one entry per digest. Streams: what is held is a batch and the last entry."""
    names = ["digest", "n", "nulls", "lo", "hi"]
    held: pa.RecordBatch | None = None
    least, most = -(1 << 63), (1 << 63) - 1
    for b in batches:
        b = b.select(names)
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        if not b.num_rows:
            continue
        d = b.column("digest")
        new = np.ones(len(d), bool)
        if len(d) > 1:
            new[1:] = pc.not_equal(d.slice(1), d.slice(0, len(d) - 1)).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(new)
        n, nulls = (np.add.reduceat(b.column(c).to_numpy(zero_copy_only=False), at) for c in ("n", "nulls"))
        lo = np.minimum.reduceat(b.column("lo").fill_null(most).to_numpy(zero_copy_only=False), at)
        hi = np.maximum.reduceat(b.column("hi").fill_null(least).to_numpy(zero_copy_only=False), at)
        none = n == nulls
        out = pa.RecordBatch.from_arrays([d.take(pa.array(at)), pa.array(n), pa.array(nulls), pa.array(lo, mask=none), pa.array(hi, mask=none)], names=names)
        held = out.slice(out.num_rows - 1)
        yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def compact(*levels: DataFrame) -> DataFrame:
    """The merged level of runs and of earlier levels: one entry per digest, in order of digest within each partition."""
    rows = levels[0].select("digest", "n", "nulls", "lo", "hi")
    for x in levels[1:]:
        rows = rows.unionByName(x.select(*rows.columns))
    return rows.repartition("digest").sortWithinPartitions("digest").mapInArrow(_merge, _LEVEL)


def _entries(table: np.ndarray, bits: int, digest_bytes: int, memtable_rows: int, memtable_bytes: int):
    """Memtables of verification: what the filter lets through by digest and whole text, all else row by row without its text."""

    def run(batches):
        held: dict[tuple, list] = {}
        alone: list[tuple] = []
        size = 0

        def flush():
            rows = alone + [(sha[:digest_bytes], sha, t, ids, nulls) for (sha, t), (ids, nulls) in held.items()]
            kinds = (pa.binary(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["digest", "sha", "text", "ids", "nulls"])
            held.clear()
            alone.clear()
            return out

        for b in batches:
            shas = b.column("sha").to_pylist()
            maybe = in_filter(table, bits, _key(pc.binary_slice(b.column("sha"), 0, digest_bytes))) if shas else []
            for i, t, sha, m in zip(b.column("doc_id").to_pylist(), b.column("text"), shas, maybe, strict=True):
                if not m:
                    alone.append((sha[:digest_bytes], sha, None, [i] if i is not None else [], int(i is None)))
                else:
                    t = t.as_py()
                    x = held.get((sha, t))
                    if x is None:
                        x = held[sha, t] = [[], 0]
                        size += len(t) + 200
                    if i is None:
                        x[1] += 1
                    else:
                        x[0].append(i)
                    size += 8
                if size > memtable_bytes or len(alone) >= memtable_rows:
                    yield flush()
                    size = 0
        yield flush()

    return run


def dedup(docs: DataFrame, keep: str = "smallest", digest_bytes: int = 32, memtable_rows: int = MEMTABLE_ROWS, memtable_bytes: int = MEMTABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Of rows with the kept doc_id and text, all are marked kept."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    end = "lo" if keep == "smallest" else "hi"
    level = written(compact(written(level0(docs, digest_bytes, memtable_rows), "lsm-level0")), "lsm-level1")
    hits = level.where("n > 1")
    table, bits = build_filter(hits.select("digest"), hits.count(), _key)
    entries = written(_digests(docs).select("doc_id", "text", "sha").mapInArrow(freeing(_entries(table, bits, digest_bytes, memtable_rows, memtable_bytes)), _ENTRY), "lsm-entries")
    shared = entries.where("text IS NOT NULL")
    verified = written(shared.groupBy("digest").agg(F.expr("min(text) = max(text)").alias("same")).join(level, "digest").select("digest", "same", "n", F.col(end).alias("keep_id")), "lsm-verified")
    told = hot_join(shared.drop("text"), verified.where("same").select("digest", "n", "keep_id"), "digest", "n").select("sha", "ids", "nulls", "keep_id", F.col("n").alias("group_size"))
    # digests that several texts share
    split = written(shared.join(verified.where("NOT same").select("digest"), "digest").withColumn("n", F.expr("size(ids) + nulls")), "lsm-split")
    pick = F.min(F.expr("array_min(ids)")) if keep == "smallest" else F.max(F.expr("array_max(ids)"))
    groups = split.groupBy("digest", "text").agg(pick.alias("keep_id"), F.sum("n").cast("long").alias("group_size"))
    parted = split.join(groups, ["digest", "text"]).select("sha", "ids", "nulls", "keep_id", "group_size")
    alone = entries.where("text IS NULL").select("sha", "ids", "nulls", F.try_element_at("ids", F.lit(1)).alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    rows = alone.unionByName(told).unionByName(parted).withColumn("doc_id", F.explode(F.expr("concat(ids, array_repeat(CAST(NULL AS BIGINT), CAST(nulls AS INT)))")))
    return rows.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def kept_rows(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row of docs, with all its columns, for each distinct text (null and empty are one)."""
    known = lambda i: [F.coalesce(i, F.lit(0)).alias("id"), i.isNull().alias("unknown")]
    verdict = dedup(docs, keep).where("kept").select(*known(F.col("doc_id")), "text_sha256").distinct()
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("text_sha256")
    rows = docs.select(F.struct("*").alias("row"), *known(F.col("doc_id").cast("long")), sha)
    rows = rows.join(verdict, ["id", "unknown", "text_sha256"], "left_semi")
    return rows.dropDuplicates(["id", "unknown", "text_sha256"]).select("row.*")


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(query_rows(spark, sf_dir), keep="largest")


QUERIES: dict[str, Query] = {"op9_exact_dedup": op9_exact_dedup}
ORACLE = {
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
}
