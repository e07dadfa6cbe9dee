"""Shared plumbing: the shared folder, written tables, fixed-size filters, connected components, byte-level word hashing."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor sees; a temporary one only in local mode, where it is unset."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _OWN:
        made = tempfile.mkdtemp(prefix="plumbline-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _OWN[sc.applicationId] = "file://" + made
    return _OWN[sc.applicationId]


ARROW_ROWS = 4000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df after one write to the shared folder: cuts lineage, and a lost executor costs no recomputation.

    While it runs, Arrow batches are small, so that whole texts and sets in them take little memory; the shuffle files of the
    write go when it ends. discard() deletes the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plumbline/{name}-{uuid.uuid4().hex}"
    rows = int(spark.conf.get(_ARROW))
    with _settings(spark, {_ARROW: str(min(ARROW_ROWS, rows) if rows > 0 else ARROW_ROWS), _CLEAN: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._plumbline_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing still to be computed reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._plumbline_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def freeing(run: Callable) -> Callable:
    """A batch function whose worker gives freed memory back when it ends; workers live on between stages, and JVM stages need the room."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # where the C library has it
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


BROADCAST_BYTES = 16 << 20


def small_side(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The driver's rows as a table for the smaller side of a join: broadcast up to BROADCAST_BYTES, by a count of its values' sizes; beyond, a plain join."""

    def size(x) -> int:
        if isinstance(x, str):
            return 32 + 4 * len(x)
        if isinstance(x, dict | list | tuple):
            return 32 + sum(map(size, x.values() if isinstance(x, dict) else x))
        return 16

    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if sum(map(size, rows)) <= BROADCAST_BYTES else made


def slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes each; a longer row stands alone."""
    at, n = 0, len(lengths)
    ends = np.cumsum(lengths, dtype=np.int64)
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, to
        at = to


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_share(*keys: str) -> F.Column:
    """A number in [0, 1) that depends on the keys' values alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)


def _below(by: str, shares: dict, *keys: str) -> F.Column:
    limit = F.lit(0.0)
    for value, share in shares.items():
        limit = F.when(F.col(by) == F.lit(value), F.lit(share)).otherwise(limit)
    return hash_share(*keys) < limit


def hash_sample(rows: DataFrame, key: str, by: str, per_class: int) -> DataFrame:
    """About per_class rows of each value of `by` (all where there are fewer): those whose hash of `key` lies below a share.

    The share follows from the counts, so that no class meets in one task; the number is per_class but for a few parts in a
    hundred, or a little more where classes are small. The number of classes is bounded by their nature.
    """
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()
    return rows.where(_below(by, {r[0]: min(1.0, per_class / r["n"]) for r in counts}, key))


def text_sample(rows: DataFrame, by: str, per_class: int, most_bytes: int) -> DataFrame:
    """Of rows (doc_id, text, `by`, others) about per_class of each value of `by` and about most_bytes of its text, all where there is less.

    Rows fall in by the hash of doc_id and whole text, whatever a text's length; repeated rows fall alike and are taken once.
    """
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    shares = {r[0]: min(1.0, per_class / r["n"], most_bytes / max(r["bytes"] or 0, 1)) for r in counts}
    return rows.where(_below(by, shares, "doc_id", "text")).dropDuplicates([by, "doc_id", "text"])


# ---- joins with hot keys ------------------------------------------------------------------------

HOT = 8192


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """rows joined to `groups`, which has one row for each key and in `size` how many rows the key has, at least.

    Keys with more than a 1/HOT part of all rows are at most HOT, and are broadcast; of the others none fills a task.
    Both sides are read more than once: they should be written tables.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) > total / HOT)
    if not hot.head(1):
        return rows.join(groups, key)
    mild = groups.where(F.col(size) <= total / HOT)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(mild, key))


def cell_join(left: DataFrame, right: DataFrame, key: str, by: tuple[str, str], cell: int = 512) -> DataFrame:
    """An equi-join of two written tables whose keys may be hot on either side.

    A hot key's rows (more than `cell` on a side) are dealt by hash of a column (`by`: left's, right's) to parts of about `cell`
    rows, and each pair of parts meets on its own. All other keys join as they are.
    """
    n, m = (t.groupBy(key).agg(F.count(F.lit(1)).alias(c)) for t, c in ((left, "_n"), (right, "_m")))
    hot = written(n.join(m, key).where(F.greatest("_n", "_m") > cell), "join-hot")
    n_hot = hot.count()
    if not n_hot:
        return left.join(right, key)
    side = F.broadcast(hot) if n_hot <= HOT else hot
    parts = lambda c: F.ceil(F.col(c) / cell).cast("int")
    part = lambda column, c: F.pmod(F.xxhash64(column), parts(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), parts(c) - 1))
    a = left.join(side, key).withColumn("_p", part(by[0], "_n")).withColumn("_q", every("_m")).drop("_n", "_m")
    b = right.join(side, key).withColumn("_q", part(by[1], "_m")).withColumn("_p", every("_n")).drop("_n", "_m")
    mild = left.join(side.select(key), key, "left_anti").join(right.join(side.select(key), key, "left_anti"), key)
    return mild.unionByName(a.join(b, [key, "_p", "_q"]).drop("_p", "_q"))


# ---- fixed-size filters -------------------------------------------------------------------------

FILTER_BITS_MOST = 1 << 26  # 8 MB: the proven bound of what is broadcast; beyond it more keys pass, none is lost


def _filter_slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64(bits - 1)
    return [(mix(keys ^ np.uint64(salt)) & mask) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)]


def build_filter(keys: DataFrame, n: int, number: Callable[[pa.Array], np.ndarray] | None = None) -> tuple[np.ndarray, int]:
    """A Bloom filter over the first column of keys (longs, or made longs by `number`), its bits set on executors and or-ed by slice; at most FILTER_BITS_MOST bits."""
    bits = 1 << int(np.clip(np.ceil(np.log2(max(n, 1) * 12)), 13, np.log2(FILTER_BITS_MOST)))
    piece = 1 << 16  # bits in a slice, the unit that is or-ed

    def partial(batches):
        table = np.zeros(bits // 8, np.uint8)
        for b in batches:
            k = (number(b.column(0)) if number else b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).view(np.uint64)
            for s in _filter_slots(k, bits):
                np.bitwise_or.at(table, (s >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (s & np.uint64(7)).astype(np.uint8)))
        step = piece // 8
        rows = [(i, table[i * step : (i + 1) * step]) for i in range(max(1, len(table) // step))]
        rows = [(i, x.tobytes()) for i, x in rows if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["i", "bits"])

    def union(key, table):
        out = None
        for x in table.column("bits").to_pylist():
            x = np.frombuffer(x, np.uint8)
            out = x.copy() if out is None else out | x
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})

    table = np.zeros(bits // 8, np.uint8)
    step = piece // 8
    for row in keys.mapInArrow(partial, "i int, bits binary").groupBy("i").applyInArrow(union, "i int, bits binary").collect():  # at most 8 MB
        x = np.frombuffer(row.bits, np.uint8)
        table[row.i * step : row.i * step + len(x)] = x
    return table, bits


def in_filter(table: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for s in _filter_slots(keys.view(np.uint64) if keys.dtype != np.uint64 else keys, bits):
        out &= (table[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


# ---- connected components -----------------------------------------------------------------------


def _stars(batches):
    """Contracts the edges that a task holds to stars around each local component's smallest vertex."""
    a, b = [], []

    def flush():
        x, y = np.concatenate(a), np.concatenate(b)
        names, inv = np.unique(np.concatenate([x, y]), return_inverse=True)
        root = union_find(inv[: len(x)], inv[len(x) :], len(names))
        keep = root != np.arange(len(names))
        return pa.RecordBatch.from_arrays([pa.array(names[keep], pa.int64()), pa.array(names[root[keep]], pa.int64())], names=["a", "b"])

    for t in batches:
        a.append(t.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        b.append(t.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
        if sum(map(len, a)) > 1_000_000:
            yield flush()
            a, b = [], []
    if a:
        yield flush()


def union_find(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For vertices 0..n-1 the smallest vertex of each one's component, by repeated hooking and pointer jumping."""
    root = np.arange(n)
    while len(x):
        rx, ry = root[x], root[y]
        open_ = rx != ry
        x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (id, root): each vertex that isn't its component's smallest, with that smallest vertex.

    Alternating large-star and small-star rounds until the edges are stars; a hub's edges are only
    aggregated and equi-joined, never gathered. Each round is written to the shared folder.
    """
    e = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_stars, "a long, b long").distinct(), "edges")
    while True:
        ends = e.select(F.col("a").alias("id"), F.lit(1).alias("child")).union(e.select("b", F.lit(0)))
        ends = ends.groupBy("id").agg(F.sum("child").alias("times"), F.min("child").alias("root"))
        if not ends.agg(F.max(F.expr("times > 1 OR (times > 0 AND root = 0)"))).first()[0]:  # each vertex hangs on one root, and no root hangs
            out = e.select(F.col("a").alias("id"), F.col("b").alias("root"))
            out._plumbline_path = e._plumbline_path
            return out
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = low.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        before, e = e, written(small, "edges")
        discard(before)


# ---- words and hashes ---------------------------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_HASH = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, lower: bool = True, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the start of each maximal run of bytes other than the breaks, by default space and 09-0D."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~breaks[raw]
    edge = np.diff(word.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    letters = raw[word]
    if lower:
        letters = LOWER[letters]
    within = np.arange(len(letters)) - np.repeat(first, sizes)
    p = powers(int(sizes.max()))
    return mix(np.add.reduceat(BYTE_HASH[letters] * p[within], first) + sizes.astype(np.uint64)), starts


def query_rows(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


Query = Callable[[SparkSession, str], DataFrame]
