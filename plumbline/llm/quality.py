"""Quality classification by a factorisation machine.

Features: a text's distinct words, hashed to WORD_BITS bits; statistics of its structure (shares of character classes, line and
word lengths, repetition), cut to bins at the sample's quantiles; and the metadata column n_chars, alone and against the
text's own length. Each feature has a weight and a vector of RANK numbers; all pairs interact through the vectors'
products, which sum in linear time as half of the square of the sum minus the sum of squares. Fitted by AdaGrad
on a sample of labelled rows (about SAMPLE_DOCS of each class and SAMPLE_BYTES of their texts, by a hash share of rows,
whatever a text's length), weighted to the classes' shares among all of them.

Defined cases: a null text counts as empty, in learning too; an empty one has statistics alone; very long texts count whole, a slice
of texts at a time; a null or negative n_chars is a value of its own; equal rows score alike; repeated rows each get
their row and teach once; a null doc_id counts as held out; labels that are null or other than 0 and 1 teach nothing; without both classes every
score is the known share (0 without labels); an empty table gives no rows; labels, lang, source and doc_id are never
features; columns other than doc_id, text and n_chars are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, mix, query_rows, slices, utf8, word_hashes
from .langid import held_out
from .toxicity import sample

SAMPLE_DOCS = 3000  # of each class, the bound of the fit
SAMPLE_BYTES = 12 << 20  # of each class's texts, about, in all
WORD_BITS = 15
BINS = 12
RANK = 8
EPOCHS = 12
THRESHOLD = 0.5
SLICE_BYTES = 2 << 20
_KIND = np.array([0 if c >= 128 else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 5 if c == 10 else 6 if c in (9, 11, 12, 13, 32) else 4 for c in range(256)], np.uint8)
_LINE = np.arange(256) == 10
N_STATS = 15


def _distinct(hashes: np.ndarray, cuts: np.ndarray):
    """For each text: distinct hashes, the greatest count of one; and (text, hash) of all distinct ones, ordered by text."""
    n = len(cuts) - 1
    doc = np.repeat(np.arange(n), np.diff(cuts))
    _, at, times = np.unique(mix(hashes + doc.astype(np.uint64)), return_index=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    at, times = at[order], times[order]
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc[at], times)
    return np.bincount(doc[at], minlength=n), most, doc[at], hashes[at]


def features(texts: pa.Array, n_chars: pa.Array):
    """Yields (statistics, text of each distinct word, its bucket) for slices of texts."""
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))  # no line runs on into the next text
    raw, offsets = utf8(texts)
    said = n_chars.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)
    for lo, hi in slices(np.diff(offsets), SLICE_BYTES):
        part, ends = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        size = np.diff(ends) - 1.0
        kinds = _KIND[part]
        count = [np.add.reduceat((kinds == k).astype(np.int64), ends[:-1]) for k in range(6)]
        words, starts = word_hashes(part)
        cuts = np.searchsorted(starts, ends)
        n_words = np.diff(cuts)
        distinct, top, doc, word = _distinct(words, cuts)
        lines, starts = word_hashes(part, breaks=_LINE)
        line_cuts = np.searchsorted(starts, ends)
        n_lines = np.diff(line_cuts)
        d_lines, top_line, _, _ = _distinct(lines, line_cuts)
        count[5] -= 1  # the one that ends the text here
        some, w, n = np.maximum(size, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
        chars = size - np.add.reduceat(((part & 0xC0) == 0x80).astype(np.int64), ends[:-1])  # code points
        meta = said[lo:hi]
        stats = [
            np.log1p(size), count[2] / np.maximum(count[1] + count[2], 1), count[3] / some, count[4] / some, count[0] / some, count[5] / some, np.log1p(n_words), size / w,
            distinct / w, top / w, d_lines / n, top_line / n, n_words / n, np.log1p(np.maximum(meta, -0.5)), np.where(meta < 0, 9.0, np.abs(np.log1p(np.maximum(meta, 0)) - np.log1p(chars))),
        ]
        yield np.stack(stats, 1), doc, (word >> np.uint64(64 - WORD_BITS)).astype(np.int64)


class Model:
    def __init__(self, rows: list[tuple[str, int | None]], labels: np.ndarray, share: float | None):
        self.share = 0.5 if share is None else share
        self.ready = bool(0 < labels.sum() < len(labels))
        if not self.ready:
            return
        parts = list(features(pa.array([t for t, _ in rows], pa.large_string()), pa.array([n for _, n in rows], pa.float64())))
        stats = np.concatenate([p[0] for p in parts])
        self.edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
        docs = [self._encode(*p) for p in parts]
        index = [x for part in docs for x in zip(*part, strict=True)]
        rng = np.random.default_rng(7)
        dim = (1 << WORD_BITS) + N_STATS * BINS
        self.bias, self.w, self.v = 0.0, np.zeros(dim), rng.normal(0, 0.05, (dim, RANK))
        g_b, g_w, g_v = 1e-8, np.full(dim, 1e-8), np.full((dim, RANK), 1e-8)
        weight = np.where(labels == 1, self.share / labels.mean(), (1 - self.share) / (1 - labels.mean()))
        rate, decay = 0.1, 1e-4
        for _ in range(EPOCHS):
            order = rng.permutation(len(index))
            for at in range(0, len(order), 64):
                batch = order[at : at + 64]
                f = np.concatenate([index[i][0] for i in batch])
                x = np.concatenate([index[i][1] for i in batch])
                first = np.concatenate([[0], np.cumsum([len(index[i][0]) for i in batch])[:-1]])
                z, s = self._sum(f, x, first)
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * weight[batch] / len(batch)
                per = np.repeat(g, np.diff(np.append(first, len(f))))
                rows_ = np.repeat(np.arange(len(batch)), np.diff(np.append(first, len(f))))
                names, inv = np.unique(f, return_inverse=True)
                dw = np.bincount(inv, per * x, minlength=len(names)) + decay * self.w[names]
                each = (per * x)[:, None] * (s[rows_] - self.v[f] * x[:, None])
                dv = np.stack([np.bincount(inv, each[:, r], minlength=len(names)) for r in range(RANK)], 1) + decay * self.v[names]
                g_b += g.sum() ** 2
                g_w[names] += dw**2
                g_v[names] += dv**2
                self.bias -= rate * g.sum() / np.sqrt(g_b)
                self.w[names] -= rate * dw / np.sqrt(g_w[names])
                self.v[names] -= rate * dv / np.sqrt(g_v[names])

    def _encode(self, stats: np.ndarray, doc: np.ndarray, bucket: np.ndarray):
        """Lists of feature indices and of their values, one for each text."""
        n = len(stats)
        bins = np.stack([np.searchsorted(e, stats[:, k], "left") for k, e in enumerate(self.edges)], 1) + np.arange(N_STATS) * BINS + (1 << WORD_BITS)
        cuts = np.searchsorted(doc, np.arange(n + 1))
        index = [np.concatenate([bins[i], bucket[cuts[i] : cuts[i + 1]]]) for i in range(n)]
        return index, [np.concatenate([np.full(N_STATS, 0.3), np.full(len(f) - N_STATS, 1 / np.sqrt(max(len(f) - N_STATS, 1)))]) for f in index]

    def _sum(self, f: np.ndarray, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The machine's output for each text, and its summed vectors."""
        vx = self.v[f] * x[:, None]
        s = np.add.reduceat(vx, first)
        return self.bias + np.add.reduceat(self.w[f] * x, first) + 0.5 * (s**2 - np.add.reduceat(vx**2, first)).sum(1), s

    def score(self, texts: pa.Array, n_chars: pa.Array) -> np.ndarray:
        if not self.ready:
            return np.full(len(texts), self.share)
        out = []
        for part in features(texts, n_chars):
            index, values = self._encode(*part)
            first = np.concatenate([[0], np.cumsum([len(f) for f in index])[:-1]])
            out.append(self._sum(np.concatenate(index), np.concatenate(values), first)[0])
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out) if out else np.zeros(0), -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, learns, per_class: int = SAMPLE_DOCS) -> Model:
    rows, share = sample(docs, labels, "quality", learns, per_class, SAMPLE_BYTES, ("n_chars",))
    return Model([(r.text, r.n_chars) for r in rows], np.array([r.label for r in rows], int), share)


def predict(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted."""

    def run(batches):
        for b in batches:
            s = model.score(b.column("text"), b.column("n_chars"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long").alias("n_chars")).mapInArrow(run, "doc_id long, score double, predicted int")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = query_rows(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chars")
    model = fit(docs, query_rows(spark, sf_dir, "labels"), ~held_out(3, 1))
    return predict(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Query] = {"op3_quality": op3_quality}
ORACLE: dict[str, str] = {}
