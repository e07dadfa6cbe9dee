"""Toxicity by class-conditional Kneser-Ney models of expressions.

Words are lower-cased runs between white space and ASCII punctuation. For each class c (toxic, ordinary), counted on a
bounded sample of labelled rows, a word after another backs off to the word, to its first six and four bytes (so that
inflected and compounded forms of an expression share counts), and to counts that both classes share:

    P_c(w | v) = max(n_c(v w) - d, 0) / n_c(v) + b_c(v) P_c(w)
    P_c(w)     = max(t_c(w) - d, 0) / T_c + b_c P_c(w's six bytes) P(w | its six bytes), and so on down to P

with t_c(w) the number of distinct words before w in the class. P is shared by both: counts of all words and prefixes of
all documents in a table of fixed size, gathered from the whole corpus. Every expression of the sampled texts has its class
count; the discount and the shared counts smooth rare ones. A text's
evidence is the length-normalised difference of the log-likelihoods over all words of the text (those of a line's r-th
copy weigh 1/r), over its most toxic WINDOW of neighbours, and over those that speak strongly for the toxic class; a logistic curve, fitted on sampled rows that the
counts left out, turns it into a score.

The fit takes about SAMPLE_DOCS labelled texts of each class and about SAMPLE_BYTES of their bytes, by a hash share of rows: a
text's length neither lets it in nor keeps it out, and the sampled ones teach whole.

Defined cases: null, empty and wordless texts have no evidence and score the classes' known share; a null text teaches as
an empty one; very long texts are scored whole, in slices of texts; equal texts score alike; repeated rows each get their row and teach once; a null doc_id
counts as held out; labels that are null or other than 0 and 1 teach nothing; a doc_id with both labels teaches 1; without both
classes every score is the known share; an empty table gives no rows; columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_HASH, Query, hash_sample, mix, powers, query_rows, slices, text_sample, utf8, written
from .langid import held_out

SAMPLE_DOCS = 2000  # of each class, the bound of the fit
SAMPLE_BYTES = 5 << 20  # of each class's texts, about, in all
WINDOW = 8
STRONG = 3.5
PREFIXES = (6, 4)  # bytes
SHARED_BITS = 18
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20
_BREAK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def words_of(texts: pa.Array):
    """Yields (hashes of words and of their prefixes, their lines, starts of each text's words and their end) for slices of texts."""
    texts = pc.binary_join_element_wise(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    raw, offsets = utf8(texts)
    for lo, hi in slices(np.diff(offsets), SLICE_BYTES):
        part = raw[offsets[lo] : offsets[hi]]
        word = ~_BREAK[part]
        edge = np.diff(word.view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        cuts = np.searchsorted(starts, offsets[lo : hi + 1] - offsets[lo])
        if not len(starts):
            yield [np.zeros(0, np.uint64)] * (1 + len(PREFIXES)), np.zeros(0, np.int64), cuts
            continue
        sizes = ends - starts
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        value = BYTE_HASH[part[word]] * powers(int(sizes.max()))[within]
        levels = [mix(np.add.reduceat(value, first) + sizes.astype(np.uint64))]
        for k in PREFIXES:
            value = np.where(within < k, value, np.uint64(0))
            levels.append(mix(np.add.reduceat(value, first) + np.uint64(k << 32)))
        yield levels, np.searchsorted(np.flatnonzero(part == 10), starts), cuts


def pairs_of(words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word with the one before it, and the one before; a text's first word follows 0."""
    before = np.zeros(len(words), np.uint64)
    before[1:] = words[:-1]
    before[cuts[:-1][cuts[:-1] < len(words)]] = 0
    return mix(before * _PAIR + words), before


def line_weights(words: np.ndarray, lines: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Each word's weight: 1/r in the r-th copy of a line of its text."""
    if not len(words):
        return np.zeros(0)
    doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    starts = np.flatnonzero(np.concatenate([[True], (lines[1:] != lines[:-1]) | (doc[1:] != doc[:-1])]))
    sizes = np.diff(np.append(starts, len(words)))
    within = (np.arange(len(words)) - np.repeat(starts, sizes)).astype(np.uint64)
    key = mix(np.add.reduceat(mix(words + within * _PAIR), starts) + doc[starts].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    rank = np.empty(len(key))
    rank[order] = np.arange(len(key)) - np.repeat(new, np.diff(np.append(new, len(key))))
    return np.repeat(1 / (1 + rank), sizes)


def unlike(texts: list[str]) -> list[int]:
    """Which texts to keep so that none has most of its word pairs in those before it: copies would count one expression often."""
    seen, out, n = np.zeros(1 << 25, bool), [], 0
    for levels, _, cuts in words_of(pa.array(texts, pa.large_string())):
        pair = pairs_of(levels[0], cuts)[0] >> np.uint64(39)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mine = np.unique(pair[a:b])
            if len(mine) and seen[mine].mean() <= 0.5:
                out.append(n)
            seen[mine] = True
            n += 1
    return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SHARED_BITS)).astype(np.int64)


def count_shared(texts: pa.Array, table: np.ndarray) -> None:
    for levels, _, _ in words_of(texts):
        for x in levels:
            table += np.bincount(_slots(x), minlength=len(table))


def shared_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all words and prefixes of all documents, by the top bits of their hash."""
    step = 1 << 13

    def count(batches):
        table = np.zeros(1 << SHARED_BITS, np.int64)
        for b in batches:
            count_shared(b.column(0), table)
        rows = [(i, table[i * step : (i + 1) * step]) for i in range(len(table) // step)]
        rows = [(i, x.astype("<i8").tobytes()) for i, x in rows if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["slot", "counts"])

    def add(key, table):
        out = sum(np.frombuffer(x, "<i8") for x in table.column("counts").to_pylist())
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})

    out = np.zeros(1 << SHARED_BITS, np.int64)
    for r in docs.select(F.col("text").cast("string")).mapInArrow(count, "slot int, counts binary").groupBy("slot").applyInArrow(add, "slot int, counts binary").collect():  # 2 MB
        out[r.slot * step : (r.slot + 1) * step] = np.frombuffer(r.counts, "<i8")
    return out


def _sums(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, times = np.unique(keys, return_counts=True)
    return names, times.astype(float)


def _at(names: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(names):
        return np.zeros(len(keys))
    k = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return np.where(names[k] == keys, values[k], 0.0)


class Model:
    """Both classes' counts, and the curve from evidence to score."""

    def __init__(self, texts: list[str], labels: np.ndarray, shared: np.ndarray, share: float):
        self.share = share
        self.shared = shared.astype(float) + 1.0
        self.total = max(float(shared.sum()) / (1 + len(PREFIXES)), 1.0)  # each level counts every word once
        self.ready = bool(0 < labels.sum() < len(labels))
        if not self.ready:
            return
        once = unlike(texts)
        texts, labels = [texts[i] for i in once], labels[once]
        self.ready = bool(0 < labels.sum() < len(labels))
        if not self.ready:
            return
        folds = np.empty(len(texts), int)  # the curve sees each text under counts that left it out
        for c in (0, 1):
            folds[labels == c] = np.arange((labels == c).sum()) % 3
        x = np.zeros((len(texts), 3))
        for f in range(3):
            self._count([t for t, g in zip(texts, folds, strict=True) if g != f], labels[folds != f])
            x[folds == f] = self.evidence(pa.array([t for t, g in zip(texts, folds, strict=True) if g == f], pa.large_string()))
        weight = np.where(labels == 1, self.share / max(labels.mean(), 1e-9), (1 - self.share) / max(1 - labels.mean(), 1e-9))
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-9
        self.curve = logistic((x - self.centre) / self.scale, labels, weight)
        self._count(texts, labels)

    def _count(self, texts: list[str], labels: np.ndarray) -> None:
        parts, docs, n = [], [], 0
        for levels, lines, cuts in words_of(pa.array(texts, pa.large_string())):
            pair, before = pairs_of(levels[0], cuts)
            keep = line_weights(levels[0], lines, cuts) == 1  # a repeated line teaches once
            parts.append(([x[keep] for x in levels], pair[keep], before[keep]))
            docs.append(np.repeat(np.arange(n, n + len(cuts) - 1), np.diff(cuts))[keep])
            n += len(cuts) - 1
        doc = np.concatenate(docs)
        levels = [np.concatenate([p[0][k] for p in parts]) for k in range(1 + len(PREFIXES))]
        pair, before = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        self.by = []
        for c in (0, 1):
            own = labels[doc] == c
            bi, times = _sums(pair[own])
            _, at = np.unique(pair[own], return_index=True)  # each word before counts once
            ctx, ctx_n = _sums(before[own])
            ctx2, ctx_t = _sums(before[own][at])
            once, twice = (times == 1).sum(), (times == 2).sum()
            chain = [_sums(x[own][at]) for x in levels]
            self.by.append({"bi": bi, "n": times, "ctx": ctx, "ctx_n": ctx_n, "ctx_t": _at(ctx2, ctx_t, ctx), "d": float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95)), "chain": chain, "total": max(len(at), 1)})

    def _log_likelihood(self, c: int, levels: list[np.ndarray], pair: np.ndarray, before: np.ndarray, shared: list[np.ndarray]) -> np.ndarray:
        m = self.by[c]
        d, total = m["d"], m["total"]
        p = shared[-1] / self.total
        for k in range(len(levels) - 1, -1, -1):
            names, of = m["chain"][k]
            if k < len(levels) - 1:
                p = p * np.minimum(shared[k] / shared[k + 1], 1.0)
            held = (np.maximum(of - d, 0)).sum() / total
            p = np.maximum(_at(names, of, levels[k]) - d, 0) / total + (1 - held) * p
        n = _at(m["ctx"], m["ctx_n"], before)
        back = np.where(n > 0, d * _at(m["ctx"], m["ctx_t"], before) / np.maximum(n, 1), 1.0)
        return np.log(np.where(n > 0, np.maximum(_at(m["bi"], m["n"], pair) - d, 0) / np.maximum(n, 1), 0) + back * p)

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """For each text the mean log-likelihood ratio of its words, of its most toxic window, and the balance of strong words."""
        out = []
        for levels, lines, cuts in words_of(texts):
            weight = line_weights(levels[0], lines, cuts)
            pair, before = pairs_of(levels[0], cuts)
            pair, at, place = np.unique(pair, return_index=True, return_inverse=True)  # a word after another is looked up once
            levels, before = [x[at] for x in levels], before[at]
            shared = [self.shared[_slots(x)] for x in levels]
            ratio = self._log_likelihood(1, levels, pair, before, shared) - self._log_likelihood(0, levels, pair, before, shared)
            ratio = ratio[place]
            sums, mass, weighed, strong = (np.concatenate([[0.0], np.cumsum(x)]) for x in (ratio, weight, ratio * weight, np.where(ratio > STRONG, ratio, 0.0) * weight))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    out.append((0.0, 0.0, 0.0))
                    continue
                k = min(WINDOW, b - a)
                top = (sums[a + k : b + 1] - sums[a : b - k + 1]).max() / WINDOW
                n = mass[b] - mass[a]
                out.append(((weighed[b] - weighed[a]) / n, top, np.log1p(100 * (strong[b] - strong[a]) / (n + 20))))
        return np.array(out, float).reshape(-1, 3)

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.ready:
            return np.full(len(texts), self.share)
        x = self.evidence(texts)
        s = 1 / (1 + np.exp(-np.clip(np.concatenate([np.ones((len(x), 1)), (x - self.centre) / self.scale], 1) @ self.curve, -40, 40)))
        return np.where(x.any(axis=1), s, self.share)  # without evidence, what is known of all


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression with an intercept, by Newton's method."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * len(x) * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * len(x) * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, column: str, learns, per_class: int, most_bytes: int = SAMPLE_BYTES, columns: tuple[str, ...] = ()) -> tuple[list, float]:
    """About per_class whole texts of each class of the labelled rows that `learns` admits, about most_bytes of them, and the share of class 1 among all of them."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL").where(learns)
    share = rows.agg(F.avg("label")).first()[0]
    ids = hash_sample(rows, "doc_id", "label", per_class).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *columns)
    chosen = written(texts.join(F.broadcast(ids), "doc_id"), "labelled")  # ids: about per_class of each class
    found = text_sample(chosen, "label", per_class, most_bytes).collect()  # bounded by per_class and most_bytes
    return sorted(found, key=lambda r: (r.doc_id, r.text)), float(share if share is not None else 0.0)


def fit(docs: DataFrame, labels: DataFrame, learns, per_class: int = SAMPLE_DOCS) -> Model:
    rows, share = sample(docs, labels, "toxic", learns, per_class)
    return Model([r.text for r in rows], np.array([r.label for r in rows], int), shared_counts(docs), share)


def predict(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted."""

    def run(batches):
        for b in batches:
            s = model.score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = query_rows(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, query_rows(spark, sf_dir, "labels"), ~held_out(4, 2))
    return predict(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Query] = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}
