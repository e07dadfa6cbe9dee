"""Language ID by compression: the smallest zstandard encoding under per-language raw-content dictionaries.

Training takes, for each learned language, about SAMPLE_DOCS labelled texts and SAMPLE_BYTES of them (rows whose hash of
doc_id and text lies below a share). A dictionary has at most DICT_BYTES: its texts share them evenly, and what short texts leave goes
to longer ones; a text longer than its share gives pieces of PIECE_CHARS at even distances over its whole length. Prediction encodes every
whole text, block by block, under each dictionary; the language with the smallest total wins. The margin
is how much smaller it is than the second, as a part of the second; a text is rejected when it has no letter,
or when its margin is below MIN_MARGIN. Every dictionary keeps its own size. One shorter than others is credited with what
theirs save on foreign text beyond its size, but with no more than it saves on the text itself.

Defined cases: a null text, an empty one and one without a letter give `und`, score 0, rejected; a tie goes to
the language with most labelled texts, then the first by code point, and is rejected; with no learned language all is `und`; rows with the
same doc_id each get their row, and teach once where the text repeats too; a null doc_id counts as held out from learning and gets a row with a null
doc_id; very long texts are encoded whole, block by block; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, freeing, query_rows, text_sample

SAMPLE_DOCS = 96  # labelled texts of each language, the bound of the fit
SAMPLE_BYTES = 1 << 20  # of each language, about, in all
DICT_BYTES = 64 << 10
PIECE_CHARS = 256
BLOCK_CHARS = 4096
MIN_MARGIN = 0.002
PROBES = 8  # languages whose text measures what a larger dictionary saves by its size alone
#: Matches of four bytes already count, so that short function words tell languages apart; one probe a position keeps it fast.
PARAMETERS = {"window_log": 17, "hash_log": 15, "chain_log": 14, "search_log": 1, "min_match": 4, "target_length": 8, "strategy": zstandard.STRATEGY_FAST, "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_OUT = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def normalised(text: str | None) -> str:
    """Lower case; everything but letters becomes single spaces."""
    return _NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def spread(text: str, most_bytes: int) -> bytes:
    """The whole text where it fits, else pieces at even distances from its start to its end."""
    raw = text.encode()
    if len(raw) <= most_bytes:
        return raw
    room = most_bytes * len(text) // len(raw)  # in characters
    n = max(1, room // (PIECE_CHARS + 1))
    size = min(PIECE_CHARS, room)
    starts = (np.arange(n) * (len(text) - size)) // max(n - 1, 1)
    return " ".join(text[i : i + size] for i in starts.tolist()).encode()[:most_bytes]


def dictionary(texts: list[str], dict_bytes: int = DICT_BYTES) -> bytes:
    """Distinct normalised texts, each with an even share of the bytes; shares that short texts leave go to longer ones."""
    texts = [t for t in dict.fromkeys(texts) if t]
    parts: dict[int, bytes] = {}
    room = dict_bytes
    for k, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        parts[i] = spread(texts[i], max(room // (len(texts) - k) - 1, 0))
        room -= len(parts[i]) + 1
    return b" ".join(parts[i] for i in range(len(texts)) if parts[i])


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """labelled: doc_id, text, lang -> language to dictionary. What reaches the driver is bounded for each language."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    picked = text_sample(rows, "lang", sample_docs, sample_bytes).collect()
    size = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    out: dict[str, bytes] = {}
    for lang in sorted({r.lang for r in picked}, key=lambda x: (-size[x], x)):
        mine = sorted((r for r in picked if r.lang == lang), key=lambda r: (r.doc_id, r.text))
        if body := dictionary([normalised(r.text) for r in mine], dict_bytes):
            out[lang] = body
    return out


def _compressor(body: bytes):
    params = zstandard.ZstdCompressionParameters(**PARAMETERS)
    if not body:
        return zstandard.ZstdCompressor(compression_params=params).compress
    d = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress


def credits(model: dict[str, bytes]) -> np.ndarray:
    """For each language the part of a foreign text that larger dictionaries save beyond its dictionary's size; 0 for the largest."""
    probes = {x: model[x][:BLOCK_CHARS] for x in sorted(model, key=lambda x: -len(model[x]))[:PROBES]}
    plain, full = _compressor(b""), {x: _compressor(model[x]) for x in probes}
    out = np.zeros(len(model))
    for i, body in enumerate(model.values()):
        saved = []
        for x, f in full.items():
            if len(model[x]) > len(body):
                cut = _compressor(model[x][: len(body)])
                saved += [(len(cut(t)) - len(f(t))) / len(plain(t)) for y, t in probes.items() if y != x]
        out[i] = max(float(np.mean(saved)), 0.0) if saved else 0.0
    return out


class Classifier:
    def __init__(self, model: dict[str, bytes]):
        self.langs = list(model)
        self.by = [_compressor(x) for x in model.values()]
        self.credits = credits(model)
        self.plain = _compressor(b"")

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of a whole text."""
        t = normalised(text)
        if not self.by or not any(c.isalpha() for c in t):
            return "und", 0.0, 0.0
        t = f" {t} "
        blocks = [t[i : i + BLOCK_CHARS].encode() for i in range(0, len(t), BLOCK_CHARS)]
        sizes = np.array([sum(len(f(b)) for b in blocks) - 6 * len(blocks) for f in self.by], float)  # without the frames' headers
        if self.credits.any():  # a larger dictionary alone mustn't win
            plain = sum(len(self.plain(b)) for b in blocks) - 6 * len(blocks)
            sizes -= np.clip(plain - sizes, 0, self.credits * plain)
        best = int(np.argmin(sizes))
        rest = np.delete(sizes, best)
        margin = float((rest.min() - sizes[best]) / max(rest.min(), 1)) if len(rest) else 1.0
        odds = np.exp(-np.minimum((sizes - sizes[best]) / max(sizes[best], 1) * 40, 50))
        return self.langs[best], float(1 / odds.sum()), margin


def predict(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, margin, rejected."""

    def run(batches):
        f = Classifier(model)
        for b in batches:
            rows = [f(t.as_py()) for t in b.column("text")]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64()), pa.array([r[0] == "und" or r[2] < min_margin for r in rows], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(freeing(run), _OUT)


def accepted(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of docs, with all their columns, whose text isn't rejected."""

    def run(batches):
        f = Classifier(model)
        for b in batches:
            verdicts = (f(t.as_py()) for t in b.column("text"))
            yield b.filter(pa.array([v[0] != "und" and v[2] >= min_margin for v in verdicts], pa.bool_()))

    return docs.mapInArrow(freeing(run), docs.schema)


def held_out(mod: int, remainder: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == remainder, F.lit(True))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """The model of the documents that aren't held out."""
    return train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(~held_out(3, 1)))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = query_rows(spark, sf_dir)
    return predict(docs, learn(docs)).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")


QUERIES: dict[str, Query] = {"op5_language_id": op5_language_id}
ORACLE: dict[str, str] = {}
