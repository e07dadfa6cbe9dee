"""N-gram Jaccard self-join by rare-first prefix filtering, and the components of its links.

1. One pass makes each document's set of k-word shingles (64-bit hashes), its digest, and document frequencies of all
   shingles in a table of fixed size. The table only orders shingles, rarest first, so that its collisions cost
   time, never results. Equal sets are one class of copies, linked to the smallest doc_id.
2. A second pass posts each class's prefix of rarest shingles, once for each task that meets it. Postings meet by
   shingle; sorted, they are streamed, never gathered, and shingles of one class alone drop out. Shingles whose slot of the table
   is hot are dealt to several tasks by class, and stay whether alone or not. What dropped out of the
   prefix that ends first in the order, of two classes, bounds their overlap: the other posts all that it has up to there.
3. Each shingle's class with the highest bound is its hub, and is verified against the shingle's other classes; verified
   links form components. In a group of near copies the least edited one is the hub of all.
4. Only shingles whose postings still lie in different components give pairs: those outside the shingle's largest
   component against all others of it. Length, positional and suffix filters (counts in ranges of the hash space bound
   the overlap) come before one verification per pair on whole sets. What a component already joins needs no pair,
   so that thousands of near copies cost pairs in proportion to their number.

Links between different texts beyond those that join components aren't listed. Sets are compared as sets of 64-bit hashes of
shingles: components are those of the hashes, and differ from those of the words only where two shingles of one pair of texts share a
hash (for two texts of a million shingles each, odds of about one in ten million). Joins on keys that a third of all rows may hold (a digest, a
shingle, a component) broadcast the few hot keys' rows, or deal them to cells.

Defined cases: a null or blank text has an empty set and no link; a text of fewer than k words has one shingle, its
whole sequence; rows with one doc_id are one document with the links of all; a null doc_id has no link and a null
component; an empty table gives no rows; other columns are ignored, whatever their names. A very long text's set is held whole by one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, Query, build_filter, cell_join, components, discard, freeing, hot_join, in_filter, mix, query_rows, slices, utf8, word_hashes, written

WORDS = 5
PERCENT = 80
TABLE_BITS = 19  # of the frequency table: 4 MB, whatever the corpus
HOT_TIMES, HOT_LEAST = 8, 1024  # a slot is hot beyond so many times the mean and so many more; the hot ones are at most an eighth of the table
RANGES = 64
SLICE_BYTES = 1 << 19
SLICE_ROWS = 500


def shingle_sets(texts: pa.Array, k: int = WORDS):
    """For each text its sorted distinct shingles; a few texts at a time, so that memory follows the longest text."""
    for at in range(0, len(texts), SLICE_ROWS):
        yield from _sets(texts.slice(at, SLICE_ROWS), k)


def _sets(texts: pa.Array, k: int):
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    raw, offsets = utf8(texts)
    factors = np.array([BASE + 2 * 0x5851F42D4C957F2D * (j + 1) & (1 << 64) - 1 for j in range(k)], np.uint64)
    for lo, hi in slices(np.diff(offsets), SLICE_BYTES):
        part = raw[offsets[lo] : offsets[hi]]
        words, starts = word_hashes(part)
        cuts = np.searchsorted(starts, offsets[lo : hi + 1] - offsets[lo])
        n = len(words) - k + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for j in range(k if n > 0 else 0):
            rolled += words[j : j + n] * factors[j]
        rolled = mix(rolled)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                yield mix((words[a:b] * factors[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                yield rolled[:0]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


POSTED = ["h", "id", "n", "pos", "last", "part"]
_POSTED = "h long, id long, n int, pos int, last long, part int"


def _scan(k: int):
    shift = np.uint64(64 - TABLE_BITS)
    step = 1 << 14

    def run(batches):
        table = np.zeros(1 << TABLE_BITS, np.int64)
        names = ["doc_id", "n", "digest", "slot", "counts"]
        for b in batches:
            sizes, digests, slots = [], [], []
            for s in shingle_sets(b.column("text"), k):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                slots.append(s >> shift)
            if slots:
                table += np.bincount(np.concatenate(slots).astype(np.int64), minlength=len(table))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        parts = [(i, table[i * step : (i + 1) * step].astype("<u8")) for i in range(max(1, len(table) // step))]
        parts = [(i, x.tobytes()) for i, x in parts if x.any()]
        n = len(parts)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([i for i, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=names)

    return run


def _sum(key, table):
    out = np.zeros(1 << 14, np.uint64)
    for x in table.column("counts").to_pylist():
        out += np.frombuffer(x, "<u8")
    return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})


def _need(n, percent):
    """ceil(percent / 100 * n)"""
    return (n * percent + 99) // 100


def _overlap(n, m, percent):
    """The least intersection of sets of n and m that link: ceil(p / (100 + p) * (n + m))."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def _prefixes(freq: np.ndarray, k: int, percent: int):
    shift = np.uint64(64 - TABLE_BITS)
    hot = HOT_TIMES * int(freq.mean()) + HOT_LEAST

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            out = [[] for _ in POSTED]
            for i, s in zip(b.column("doc_id").to_pylist(), shingle_sets(b.column("text"), k), strict=True):
                n = len(s)
                if i is None or not n:
                    continue
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if d in seen:
                    continue
                seen.add(d)
                p = n - _need(n, percent) + 1
                f = freq[(s >> shift).astype(np.int64)]
                few = np.argpartition(f, p - 1)[:p] if p < n else np.arange(n)
                near = np.flatnonzero(f <= f[few].max())  # with all ties of the last, so that the order is total
                near = near[np.lexsort((s[near], f[near]))][:p]
                out[0].append(s[near].view(np.int64))
                out[1].append(np.full(p, i, np.int64))
                out[2].append(np.full(p, n, np.int32))
                out[3].append(np.arange(p, dtype=np.int32))
                out[4].append(np.full(p, f[near[-1]], np.int64))
                times = f[near].astype(np.int64)
                out[5].append(np.where(times > hot, 1 + i % (1 + times // hot), 0).astype(np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=POSTED)

    return run


def _shared(batches):
    """Rows sorted by h and part -> those whose h has several, and all of an h that is dealt to parts. Streams: a run is never held."""
    kept, done = None, False
    for b in batches:
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in POSTED]
        if not len(cols[0]):
            continue
        if kept is not None:
            cols = [np.concatenate([x, c]) for x, c in zip(kept, cols, strict=True)]
        h, part = cols[0], cols[5]
        starts = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])]))
        sizes = np.diff(np.append(starts, len(h)))
        emit = np.repeat((sizes > 1) | (part[starts] > 0), sizes)
        if kept is not None and done:
            emit[0] = False
        last = starts[-1]
        done = bool(sizes[-1] > 1 or part[last] > 0 or (last == 0 and kept is not None and done))
        kept = [c[last : last + 1] for c in cols]
        yield pa.RecordBatch.from_arrays([pa.array(c[emit]) for c in cols[:5]], names=POSTED[:5])


def _need_sql(n: str, percent: int) -> str:
    return f"CAST(({n} * {percent} + 99) DIV 100 AS INT)"


def _least_sql(n: str, m: str, percent: int) -> str:
    return f"CAST(({percent} * ({n} + {m}) + {99 + percent}) DIV {100 + percent} AS INT)"


def _bound(a: str, b: str) -> str:
    """An upper bound of two classes' overlap: the cap of the one whose prefix ends first; which, is left open where the frequencies tie."""
    return f"CASE WHEN last{a} < last{b} THEN cap{a} WHEN last{b} < last{a} THEN cap{b} ELSE greatest(cap{a}, cap{b}) END"


def _fits(a: str, b: str, percent: int) -> str:
    """The length filter, the bound of both classes, and the positional filter of two postings of one shingle; a, b: suffixes of n, pos, cap, last."""
    n, m, i, j = f"n{a}", f"n{b}", f"pos{a}", f"pos{b}"
    return (
        f"least({n}, {m}) * 100 >= greatest({n}, {m}) * {percent} AND "
        f"least({_bound(a, b)}, least({i}, {j}) + 1 + least({n} - {i} - 1, {m} - {j} - 1)) >= {_least_sql(n, m, percent)}"
    )


def _emit_sets(table: np.ndarray, bits: int, k: int):
    """(id, n, ranges, shingles) of the documents whose id passes the filter; others would be of no use."""

    def run(batches):
        for b in batches:
            ids = b.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            keep = in_filter(table, bits, ids) & ~b.column("doc_id").is_null().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, bool)
            at = np.flatnonzero(keep)
            for lo in range(0, len(at), 500):
                rows = at[lo : lo + 500]
                sets = list(shingle_sets(b.column("text").take(pa.array(rows)), k))
                ranges = [np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES), 65535).astype("<u2").tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array([len(s) for s in sets], pa.int32()), pa.array(ranges, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "n", "ranges", "shingles"])

    return run


def _suffix_filter(percent: int):
    def run(batches):
        for b in batches:
            a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), "<u2").reshape(-1, RANGES).astype(np.int64) for x in ("ranges_a", "ranges_b"))
            n, m = (b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("n_a", "n_b"))
            ok = np.abs(a - c).sum(1) <= n + m - 2 * _overlap(n, m, percent)  # differing counts bound the sets' difference from below
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return run


def _verify(percent: int):
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("shingles_a"), b.column("shingles_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                common = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verified(pairs: DataFrame, docs: DataFrame, name: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Sets are made again for their documents alone, and move only for pairs that pass the suffix filter."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    table, bits = build_filter(ids, 2 * pairs.count())
    sets = written(docs.mapInArrow(freeing(_emit_sets(table, bits, k)), "id long, n int, ranges binary, shingles binary"), f"{name}-sets")
    side = lambda s, cols: sets.select(F.col("id").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in cols))
    near = pairs.join(side("a", ["n", "ranges"]), "a").join(side("b", ["n", "ranges"]), "b").mapInArrow(_suffix_filter(percent), "a long, b long").distinct()
    near = written(near, f"{name}-near")
    links = written(near.join(side("a", ["shingles"]), "a").join(side("b", ["shingles"]), "b").mapInArrow(freeing(_verify(percent)), "a long, b long").distinct(), f"{name}-links")
    discard(sets, near)
    return links


def join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = _texts(docs)
    scanned = written(docs.mapInArrow(freeing(_scan(k)), "doc_id long, n long, digest binary, slot int, counts binary"), "ngram-scan")
    freq = np.zeros(1 << TABLE_BITS, np.uint64)
    for r in scanned.where("slot IS NOT NULL").select("slot", "counts").groupBy("slot").applyInArrow(_sum, "slot int, counts binary").collect():  # 4 MB
        freq[r.slot << 14 : (r.slot + 1) << 14] = np.frombuffer(r.counts, "<u8")
    nodes = scanned.where("slot IS NULL").select("doc_id", "n", "digest")
    linked = nodes.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "digest")
    classes = written(linked.groupBy("digest").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("copies")).where("b < most").drop("most"), "ngram-classes")
    copies = written(hot_join(linked, classes, "digest", "copies").where("doc_id > b").select(F.col("doc_id").alias("a"), "b").distinct(), "ngram-copies")

    posted = docs.mapInArrow(freeing(_prefixes(freq, k, percent)), _POSTED)
    shared = written(posted.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(freeing(_shared), _POSTED.rpartition(",")[0]), "ngram-postings")
    need = _need_sql("n", percent)
    caps = shared.groupBy("id", "n", "last").agg(F.count_distinct("pos").alias("c")).select("id", "n", "last", F.expr(f"CAST(n - ((n - {need} + 1) - c) AS INT)").alias("cap"))
    postings = written(shared.join(caps, ["id", "n", "last"]).select("h", "id", "n", "pos", "last", "cap"), "ngram-bounded")
    hubs = postings.groupBy("h").agg(F.max(F.expr("struct(cap, -id AS less, n, pos, last)")).alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    hubs = written(hubs.select("h", "c", F.expr("-hub.less").alias("hub"), *(F.col(f"hub.{c}").alias(f"{c}_hub") for c in ("n", "pos", "cap", "last"))), "ngram-hubs")
    starts = hot_join(postings, hubs, "h", "c").where("id <> hub").where(_fits("", "_hub", percent))
    pairs = written(starts.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "ngram-first")
    links = _verified(pairs, docs, "ngram-first", k, percent)
    discard(classes, shared, hubs)

    roots = components(copies.union(links))
    rows = written(postings.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "ngram-rooted")
    discard(postings, roots)
    by = rows.groupBy("h", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("h").agg(F.count(F.lit(1)).alias("roots"), F.expr("max_by(root, struct(c, root))").alias("major"), F.max("c").alias("c"), F.sum("c").alias("all"))
    by = written(by.where("roots > 1").drop("roots"), "ngram-mixed")
    open_ = written(hot_join(rows, by, "h", "all").drop("all"), "ngram-open")
    minor = open_.where("root <> major")
    columns = ("id", "n", "pos", "cap", "last", "root")
    side = lambda df, k, *more: df.select("h", *more, *(F.col(c).alias(f"{c}_{k}") for c in columns))
    # a class against a component: by its members where they are fewer than the postings they share, else by those
    sizes = rows.select("id", "root").distinct().groupBy(F.col("root").alias("major")).agg(F.count(F.lit(1)).alias("size"))
    meets = written(minor.groupBy("id", "n", "cap", "last", "major").agg(F.sum("c").alias("shared")), "ngram-meets")
    majors = written(meets.groupBy("major").agg(F.count(F.lit(1)).alias("times")).join(sizes, "major"), "ngram-majors")
    met = written(hot_join(meets, majors, "major", "times"), "ngram-met")
    near = written(met.where("size <= shared").select("major", *(F.col(c).alias(f"{c}_1") for c in ("id", "n", "cap", "last"))), "ngram-near")
    members = rows.select(F.col("root").alias("major"), *(F.col(c).alias(f"{c}_2") for c in ("id", "n", "cap", "last"))).distinct()
    members = written(members, "ngram-members")
    whole = cell_join(near, members, "major", ("id_1", "id_2"))
    whole = whole.where(f"least(n_1, n_2) * 100 >= greatest(n_1, n_2) * {percent} AND {_bound('_1', '_2')} >= {_least_sql('n_1', 'n_2', percent)}")
    few = minor.join(met.where("size > shared").select("id", "major"), ["id", "major"], "left_semi")
    posted = side(few, 1).join(side(open_.where("root = major"), 2), "h")
    posted = posted.union(side(minor, 1).join(side(minor, 2), "h").where("root_1 <> root_2 AND id_1 < id_2")).where(_fits("_1", "_2", percent))
    # of two classes, the one with the smaller set need only be met by its shorter, indexed prefix
    index = lambda i: f"(n_{i} - CAST((2 * {percent} * n_{i} + {99 + percent}) DIV {100 + percent} AS INT) + 1)"
    posted = posted.where(f"CASE WHEN struct(n_1, id_1) < struct(n_2, id_2) THEN pos_1 < {index(1)} ELSE pos_2 < {index(2)} END")
    more = posted.select("id_1", "id_2").union(whole.select("id_1", "id_2"))
    more = more.select(F.least("id_1", "id_2").alias("a"), F.greatest("id_1", "id_2").alias("b")).distinct()
    more = written(more.join(pairs, ["a", "b"], "left_anti"), "ngram-second")
    discard(rows, by, open_, meets, majors, met, near, members)
    links2 = _verified(more, docs, "ngram-second", k, percent)
    found = components(copies.union(links).union(links2)).withColumnRenamed("id", "doc_id")
    discard(pairs, more, copies, links, links2)
    return nodes.join(found, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return join(query_rows(spark, sf_dir))


QUERIES: dict[str, Query] = {"op4_ngram_join": op4_ngram_join}
ORACLE: dict[str, str] = {}
