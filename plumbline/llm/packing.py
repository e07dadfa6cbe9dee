"""Best-fit packing of tokenised documents by exact-complement hashing.

1. Every whole text becomes token ids (an end id follows each document); longer documents are cut to pieces of the
   capacity. A task numbers its pieces of each length; the pieces are written once to the shared folder.
2. The plan needs only the number of pieces of each length, at most `capacity` numbers however large the corpus is.
   From the longest length on, its gap is looked up among the available single lengths, pairs and triples that
   sum to it exactly; a found combination is consumed as often as its lengths are available. Where none exists, the
   longest piece that fits is added (best fit) and the smaller gap is looked up again. Each round
   exhausts a length, so a plan has a few thousand patterns for any input.
3. A piece's rank among its length (its task's offset and its number there) selects its pattern, sequence and place.

Defined cases: null and empty texts give one piece with the end id alone; repeated rows each get their pieces; a null
doc_id is kept as null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Query, freeing, query_rows, written

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 200_000
CHUNK_CHARS = 1 << 20
#: Fixed values of the vocabulary's own pre-tokenisation.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_HIGH = bytes(range(0xCC, 0x100))  # lead bytes of code points from 768 on
ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")  # str.split() cuts there, the tokenizer doesn't


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of a text as little-endian bytes, equal to the tokenizer's, through a bounded cache of words.

    No token spans white space, so a text's ids are its words' ids in order. Words of the first 768 code points
    go straight to the model; others, and special tokens, through the whole tokenizer.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.find = regex.compile(SPLIT).findall
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.most = cache_words
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.letter = [chr(b) if b in plain else chr(next(other)) for b in range(256)]  # the byte-level alphabet
        self.odd = odd = "".join(c for c in map(chr, range(33, 768)) if any(self._fast(w.lower()) != self._whole(w) for w in (f"a{c}b", f"{c}{c}1", f"x.{c}")) and not c.isspace())
        self.slow = regex.compile(rf"[^\x00-˿]|<\|{''.join('|' + regex.escape(c) for c in odd)}").search

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.full.encode(text, add_special_tokens=False).ids)

    def _fast(self, word: str) -> bytes:
        """word: in lower case."""
        if word.isalpha():
            found = (word,)
        elif word[:-1].isalpha():
            found = (word[:-1], word[-1])
        else:
            found = self.find(word)
        out = []
        for p in found:
            if (ids := self.parts.get(p)) is None:
                letters = p if p.isascii() else "".join([self.letter[b] for b in p.encode()])
                ids = self.parts[p] = self._pack([t.id for t in self.model.tokenize(letters)])
            out.append(ids)
        return b"".join(out)

    def _words(self, text: str, plain: bool) -> bytes:
        words = text.lower().split() if plain else text.split()
        cache = self.cache
        found = list(map(cache.get, words))
        if None in found:
            if len(cache) > self.most:
                cache.clear()
            if len(self.parts) > 2 * self.most:
                self.parts.clear()
            for k, ids in enumerate(found):
                if ids is None:
                    w = words[k]
                    if (ids := cache.get(w)) is None:
                        ids = cache[w] = self._whole(w) if not plain and self.slow(w) else self._fast(w.lower())
                    found[k] = ids
        return b"".join(found)

    def _plain(self, text: str) -> bool:
        """Whether self.slow finds nothing in the text: no lead byte of a code point from 768 on, no special token, no odd character."""
        if not text.isascii():
            raw = text.encode()
            if len(raw.translate(None, _HIGH)) < len(raw):
                return False
        return "<|" not in text and not any(c in text for c in self.odd)

    def __call__(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACES):
            return self._whole(text)
        plain = self._plain(text)
        if len(text) <= CHUNK_CHARS:
            return self._words(text, plain)
        out, at = [], 0
        while at < len(text):
            to = at + CHUNK_CHARS
            while to < len(text) and not text[to].isspace():
                to += 1
            out.append(self._words(text[at:to], plain))
            at = to
        return b"".join(out)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of its length."""
    path = tokenizer or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "part": pa.int32(), "nth": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})

    def run(batches):
        encode, part, seen = WordEncoder(path), TaskContext.get().partitionId(), Counter()
        for b in batches:
            rows = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = encode(t.as_py() or "") + end
                for k in range(0, len(ids), 4 * capacity):
                    x = ids[k : k + 4 * capacity]
                    n = len(x) // 4
                    rows.append((i, k // (4 * capacity), k // 4, n, zlib.crc32(x), part, seen[n], x)[: len(kinds)])
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(freeing(run), schema)


def _exact(gap: int, left: np.ndarray) -> tuple[int, ...] | None:
    """A single, pair or triple of available lengths that sums to gap; the longest first part."""

    def pair(g: int) -> tuple[int, int] | None:
        if g < 2:
            return None
        a = np.arange(g - 1, (g - 1) // 2, -1)
        a = a[a >= g - a]
        ok = (left[a] > 0) & (left[g - a] > 0) & ((a != g - a) | (left[a] > 1))
        k = int(np.argmax(ok)) if len(ok) else 0
        return (int(a[k]), int(g - a[k])) if len(ok) and ok[k] else None

    if left[gap] > 0:
        return (gap,)
    if p := pair(gap):
        return p
    for a in np.flatnonzero(left[: max(gap - 1, 0)])[::-1]:
        if a < (gap + 2) // 3:
            break
        left[a] -= 1
        p = pair(gap - int(a))
        left[a] += 1
        if p:
            return (int(a), *p)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how many sequences have them."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    out = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        used = [top]
        left[top] -= 1
        gap = capacity - top
        while gap:
            fill = _exact(gap, left)
            if not fill:
                fits = np.flatnonzero(left[: gap + 1])
                if not len(fits):
                    break
                fill = (int(fits[-1]),)
            for x in fill:
                left[x] -= 1
                used.append(x)
                gap -= x
        need = Counter(used)
        more = min(int(left[x]) // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= more * k
        out.append((tuple(used), 1 + more))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids as little-endian bytes, if asked for)."""
    rows = written(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    by = written(rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r.length: r.n for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    segments: dict[int, list[tuple[int, int, int]]] = {n: [] for n in counts}
    at, sequence = Counter(), 0
    for used, times in plan(counts, capacity):
        offset = 0
        for x in used:
            segments[x].append((at[x], sequence, offset))
            at[x] += times
            offset += x
        sequence += times
    lookup = {n: tuple(np.array(c, np.int64) for c in zip(*s, strict=True)) for n, s in segments.items()}
    w = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by.select("part", "length", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = rows.join(bases, ["part", "length"]).select(*keep, (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows_ in np.split(order, cuts) if len(order) else ():
                first, base, offset = lookup[int(length[rows_[0]])]
                k = np.searchsorted(first, rank[rows_], "right") - 1
                seq[rows_], off[rows_] = base[k] + rank[rows_] - first[k], offset[k]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids + "sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """packed with ids -> sequence_id, ids (little-endian bytes of the whole sequence), length; a group is bounded by the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"), F.sum("length").alias("length"))
    return parts.select("sequence_id", F.expr("aggregate(x, CAST('' AS BINARY), (a, y) -> concat(a, y.ids))").alias("ids"), "length")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(query_rows(spark, sf_dir))


QUERIES: dict[str, Query] = {"op10_packing": op10_packing}
ORACLE: dict[str, str] = {}
