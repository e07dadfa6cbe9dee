"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors of one label (and length) are unit vectors in the order of principal components over all rows. They are cut
to tiles of bounded size along the leading component; two tiles are compared unless the angle between their ranges of
that component already exceeds the threshold's. In a comparison, blocks accumulate the leading dimensions first;
the residual product is bounded by the product of the suffix norms, and pairs that can't reach the threshold stop there.
Remaining pairs get the cosine of the original vectors in double precision. Equal vectors are compared once. What
leaves a comparison is a count of links and at most one edge for each vector, never a list of pairs.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components, or whose label or vec_id is null,
has no link and is its own component (a null vec_id: a null component, not kept); vectors of different lengths don't
link; rows that repeat a vec_id and vector count as vectors of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, components, query_rows, union_find, written

THRESHOLD = 0.93
TILE = 4096
BINS = 4096
BLOCK = 1024
LEAD = 16  # dimensions added at a time


def _prepare(batches):
    """Valid rows get their length, digest and raw bytes as doubles; others nulls."""
    for b in batches:
        dims, digests, raws = [], [], []
        for i, v, label in zip(b.column("vec_id"), b.column("embedding"), b.column("label"), strict=True):
            x = None
            if i.is_valid and label.is_valid and v.is_valid and len(v.values) and not v.values.null_count:
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0  # -0.0 is 0.0
                if not np.isfinite(x).all() or not x.any():
                    x = None
            dims.append(None if x is None else len(x))
            raws.append(None if x is None else x.tobytes())
            digests.append(None if x is None else hashlib.blake2b(raws[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())], names=["vec_id", "label", "dim", "digest", "raw"])


def _units(raws: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(raws), np.float64).reshape(-1, dim)
    return x, _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _gram(batches):
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        dim = b.column("dim").to_numpy(zero_copy_only=False)
        raw = b.column("raw").to_pylist()
        for d in np.unique(dim).tolist():
            _, u = _units([raw[i] for i in np.flatnonzero(dim == d)], d)
            sums[d] = sums.get(d, 0) + u.T @ u
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["dim", "gram"])


def _add(key, table):
    out = sum(np.frombuffer(x) for x in table.column("gram").to_pylist())
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "gram": pa.array([out.tobytes()], pa.binary())})


def principal(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, the orthonormal basis by falling eigenvalue of the uncentred second moments of all rows."""
    part = rows.select("dim", "raw").mapInArrow(_gram, "dim int, gram binary").withColumn("salt", F.spark_partition_id() % 32)
    for keys in (["dim", "salt"], ["dim"]):
        part = part.groupBy(*keys).applyInArrow(_add, "dim int, gram binary")
        part = part.withColumn("salt", F.lit(0)) if "salt" in keys else part
    out = {}
    for r in part.collect():  # a matrix for each vector length
        _, v = np.linalg.eigh(np.frombuffer(r.gram).reshape(r.dim, r.dim))
        out[r.dim] = np.ascontiguousarray(v[:, ::-1])
    return out


def compare(a: np.ndarray, b: np.ndarray, xa: np.ndarray, xb: np.ndarray, threshold: float, same: bool):
    """Rotated unit vectors a, b and originals xa, xb -> index arrays (i, j) of linked pairs, block by block; same: only i < j."""
    dim = a.shape[1]
    ua, ub = _unit(xa), _unit(xb)
    low = threshold - 1e-9
    steps = list(range(min(LEAD, dim), dim, LEAD))
    tail = {k: (np.sqrt((a[:, k:] ** 2).sum(1)), np.sqrt((b[:, k:] ** 2).sum(1))) for k in steps}
    for i0 in range(0, len(a), BLOCK):
        for j0 in range(i0 if same else 0, len(b), BLOCK):
            p, q = slice(i0, i0 + BLOCK), slice(j0, j0 + BLOCK)
            k = min(LEAD, dim)
            dots = a[p, :k] @ b[q, :k].T
            near = dots + np.outer(tail[k][0][p], tail[k][1][q]) >= low if k < dim else dots >= low
            if same and i0 == j0:
                near &= np.triu(np.ones(near.shape, bool), 1)
            i, j = np.nonzero(near)
            dots = dots[i, j]
            i, j = i + i0, j + j0
            for k in steps:
                if not len(i):
                    break
                to = min(k + LEAD, dim)
                dots = dots + np.concatenate([np.einsum("ij,ij->i", a[i[s : s + 65536], k:to], b[j[s : s + 65536], k:to]) for s in range(0, len(i), 65536)])
                keep = dots + (tail[to][0][i] * tail[to][1][j] if to < dim else 0) >= low
                i, j, dots = i[keep], j[keep], dots[keep]
            if len(i):
                cosine = np.concatenate([np.einsum("ij,ij->i", ua[i[s : s + 65536]], ub[j[s : s + 65536]]) for s in range(0, len(i), 65536)])
                keep = cosine >= threshold
                yield i[keep], j[keep]


def _tiles(bases: dict[int, np.ndarray], threshold: float):
    def run(key, table):
        dim, same = key[1].as_py(), key[2].as_py() == key[3].as_py()
        side = table.column("side").to_numpy()
        ids, m, raw = table.column("id").to_numpy(), table.column("m").to_numpy(), table.column("raw").to_pylist()
        parts = []
        for s in (0,) if same else (0, 1):
            at = np.flatnonzero(side == s)
            x, u = _units([raw[i] for i in at], dim)
            parts.append((ids[at], m[at], x, u @ bases[dim]))
        (ia, ma, xa, a), (ib, mb, xb, b) = parts[0], parts[-1]
        na, nb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
        n = len(ia) + (0 if same else len(ib))
        shift = 0 if same else len(ia)
        root = np.arange(n)
        for i, j in compare(a, b, xa, xb, threshold, same):
            np.add.at(na, i, mb[j])
            np.add.at(na if same else nb, j, ma[i])
            here = union_find(np.concatenate([np.arange(n), i]), np.concatenate([root, j + shift]), n)
            root = here
        names = ia if same else np.concatenate([ia, ib])
        links = na if same else np.concatenate([na, nb])
        keep = links > 0
        return pa.table({"id": pa.array(names[keep], pa.int64()), "n": pa.array(links[keep], pa.int64()), "root": pa.array(names[root[keep]], pa.int64())})

    return run


def near_dedup(rows: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    prep = written(rows.mapInArrow(_prepare, "vec_id long, label string, dim int, digest binary, raw binary"), "vectors")
    valid = prep.where("raw IS NOT NULL")
    reps = written(valid.groupBy("label", "dim", "digest").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("raw").alias("raw")), "vector-classes")
    bases = principal(reps)

    def lead(batches):
        for b in batches:
            dim, raw = b.column("dim").to_numpy(zero_copy_only=False), b.column("raw").to_pylist()
            angle = np.zeros(len(dim))
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                angle[at] = np.arccos(np.clip(_units([raw[i] for i in at], d)[1] @ bases[d][:, 0], -1, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("label", "dim", "id", "m", "raw")), pa.array(angle)], names=["label", "dim", "id", "m", "raw", "angle"])

    placed = reps.select("label", "dim", "id", "m", "raw").mapInArrow(lead, "label string, dim int, id long, m long, raw binary, angle double")
    placed = written(placed.withColumn("bin", F.floor(F.col("angle") / math.pi * BINS).cast("int")), "vector-angles")
    key = ["label", "dim"]
    bins = placed.groupBy(*key, "bin").agg(F.count(F.lit(1)).alias("c"))
    bins = bins.selectExpr(*key, "bin", "c", "sum(c) OVER (PARTITION BY label, dim ORDER BY bin) - c AS before")  # at most BINS rows to a key
    bins = bins.selectExpr(*key, "bin", f"CAST(before DIV {tile} AS INT) AS t0", f"CAST((before + c - 1) DIV {tile} AS INT) AS t1")
    tiled = placed.join(bins, [*key, "bin"]).withColumn("tile", F.expr("t0 + CAST(pmod(xxhash64(id), t1 - t0 + 1) AS INT)")).select(*key, "tile", "id", "m", "raw", "angle")
    tiled = written(tiled, "vector-tiles")
    tiles = tiled.groupBy(*key, "tile").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    reach = math.acos(max(-1.0, threshold)) + 1e-7
    pairs = tiles.select(*key, *(F.col(c).alias(f"{c}_a") for c in ("tile", "lo", "hi"))).join(tiles.select(*key, *(F.col(c).alias(f"{c}_b") for c in ("tile", "lo", "hi"))), key)
    pairs = written(pairs.where(f"tile_a <= tile_b AND lo_b <= hi_a + {reach} AND lo_a <= hi_b + {reach}").select(*key, "tile_a", "tile_b"), "tile-pairs")
    vectors = tiled.drop("angle")
    left = pairs.join(vectors.withColumnRenamed("tile", "tile_a"), [*key, "tile_a"]).withColumn("side", F.lit(0))
    right = pairs.where("tile_a <> tile_b").join(vectors.withColumnRenamed("tile", "tile_b"), [*key, "tile_b"]).withColumn("side", F.lit(1))
    links = left.unionByName(right).groupBy(*key, "tile_a", "tile_b").applyInArrow(_tiles(bases, threshold), "id long, n long, root long")
    links = written(links, "vector-links")
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = reps.select(*key, "digest", "id", "m").join(links.groupBy("id").agg(F.sum("n").alias("n")), "id", "left").join(roots, "id", "left")
    found = found.select(*key, "digest", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    out = prep.select("vec_id", *key, "digest").join(found, [*key, "digest"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(query_rows(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {"op7_embedding_dedup": op7_embedding_dedup}
ORACLE: dict[str, str] = {}
