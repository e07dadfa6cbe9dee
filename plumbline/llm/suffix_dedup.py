"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Every position's suffix counts only through its first `window` bytes. Windows are dealt out by an anchor, the 16 bytes in
them with the least hash: equal windows have the same anchor at the same place, so they meet in one group, and
neighbouring windows with one anchor travel as a single fragment of bytes. There the windows are ordered by
most-significant-digit passes of eight bytes, the anchor's digits first; a pass refines the groups of the one before, drops
windows that are alone, and the passes end at the window's depth: the groups that are left are exactly the repeated
windows, compared byte by byte. In each group all but those of the smallest doc_id are covered.

Copies are cut down before they move: of equal fragments in a batch (and again among batches) only the smallest doc_id's goes
on, the others are covered at once, so that a group of copies costs a fragment for each batch, not for each row. An anchor
that stands at very many places, by counts of all 16-byte strings of all documents, would fill a task with fragments that differ
around it: its windows are dealt one by one by all their bytes instead. The number of groups grows with the corpus; beyond FAN of
them, fragments are dealt to FAN coarse groups first, and those to fine ones, so that a batch never goes to more than about FAN
places. Long texts are cut to overlapping pieces. Documents whose text nothing removes never move; a filter of at most 8 MB tells.

Defined cases: a null text counts as empty; texts shorter than the window lose nothing; windows that repeat within a document,
or in rows of the same doc_id, remove nothing there; a null doc_id neither removes nor loses bytes; removed bytes
that touch form one span; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, build_filter, freeing, in_filter, mix, query_rows, utf8, written

WINDOW = 50
ANCHOR = 16
SLICE_BYTES = 1 << 20  # hashed at a time; positions in a slice fit 24 bits
BATCH_BYTES = 6 << 20
BATCH_ROWS = 500_000  # fragments
GROUP_BYTES = 4 << 20  # of text, for each group that a task sorts at once
FAN = 8192  # groups that a batch is dealt to
PLACES = 4096  # positions to a slot of the anchors' table, while it has fewer than 2^MOST_BITS slots (16 MB)
MOST_BITS = 21
HOT_TIMES = 6  # a slot is hot beyond so many times the mean
LEVEL = 5
_LOW = np.uint64((1 << 24) - 1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shape:
    """Columns of a fragment laid out around its anchor."""

    def __init__(self, window: int):
        if window < ANCHOR + 8:
            raise ValueError(f"window: at least {ANCHOR + 8} bytes")
        self.window = window
        self.places = window - ANCHOR + 1  # of an anchor in a window
        self.side = window - ANCHOR  # bytes before and after an anchor at most
        self.width = -(-(window + self.side) // 8) * 8


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def _hashes(raw: np.ndarray) -> np.ndarray:
    """The hash of the ANCHOR bytes from each place on."""
    n = len(raw)
    v = raw.astype(np.uint64)
    for shift in (1, 2, 4):
        v = (v[:-shift] << np.uint64(8 * shift)) | v[shift:]
    return mix(v[: n - ANCHOR + 1] * _C1 + v[8 : 8 + n - ANCHOR + 1] * _C2)


def hot_anchors(docs: DataFrame, total: int, window: int) -> np.ndarray:
    """For each slot of the anchors' hashes, whether strings of 16 bytes with such a hash stand at more than HOT_TIMES as many places as the mean."""
    bits = int(np.clip(np.ceil(np.log2(max(total, 1) / PLACES)), 12, MOST_BITS))
    shift, step = np.uint64(64 - bits), 1 << 12

    def count(batches):
        table = np.zeros(1 << bits, np.int64)
        for b in batches:
            raw, _ = utf8(b.column("text"))
            for at in range(0, max(len(raw) - ANCHOR + 1, 0), SLICE_BYTES):
                h = _hashes(raw[at : at + SLICE_BYTES + ANCHOR - 1])
                table += np.bincount((h >> shift).astype(np.int64), minlength=len(table))
        rows = [(i, table[i * step : (i + 1) * step]) for i in range(len(table) // step)]
        rows = [(i, x.astype("<i8").tobytes()) for i, x in rows if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["slot", "counts"])

    def add(key, table):
        out = sum(np.frombuffer(x, "<i8") for x in table.column("counts").to_pylist())
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})

    counts = np.zeros(1 << bits, np.int64)
    for r in docs.select("text").mapInArrow(count, "slot int, counts binary").groupBy("slot").applyInArrow(add, "slot int, counts binary").collect():  # at most 16 MB
        counts[r.slot * step : (r.slot + 1) * step] = np.frombuffer(r.counts, "<i8")
    return counts > HOT_TIMES * max(counts.mean(), PLACES / 2)


@dataclass
class Deal:
    """Where fragments go: a fine group by the anchor, or by all bytes of a window whose anchor is hot."""

    shape: Shape
    groups: int
    hot: np.ndarray

    def is_hot(self, h: np.ndarray) -> np.ndarray:
        return self.hot[(h >> np.uint64(64 - (len(self.hot).bit_length() - 1))).astype(np.int64)]

    def group(self, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
        key = h.copy()
        at = np.flatnonzero(self.is_hot(h))
        for word in range(rows.shape[1] // 8):
            key[at] = mix(key[at] * _C1 + rows[at].view(np.uint64)[:, word])
        return (mix(key) % np.uint64(self.groups)).astype(np.int64)

    def of(self, doc: np.ndarray) -> np.ndarray:
        """The group that gathers a document's covered ranges."""
        return (mix(doc.astype(np.uint64)) % np.uint64(self.groups)).astype(np.int64)


def _fragments(raw: np.ndarray, starts: np.ndarray, docs: np.ndarray, bases: np.ndarray, deal: Deal):
    """Fragments of the pieces that start at `starts` in raw: rows of bytes from the first window on, and their columns."""
    s, n = deal.shape, len(raw)
    h = _hashes(raw)
    best = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), s.places)
    valid = np.ones(len(best), bool)
    for a, b in zip(starts.tolist(), np.append(starts[1:], n).tolist(), strict=True):
        valid[max(a, b - s.window + 1) : b] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return None
    anchor = (best[at] & _LOW).astype(np.int64)
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(anchor) != 0)])
    new |= deal.is_hot(h[anchor])  # a window of a hot anchor goes alone
    first = np.flatnonzero(new)
    begin, end = at[first], at[np.append(first[1:], len(at)) - 1] + s.window
    anchor = anchor[first]
    padded = np.concatenate([raw, np.zeros(s.width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, s.width)[begin]
    size = end - begin
    rows[np.arange(s.width) >= size[:, None]] = 0
    piece = np.searchsorted(starts, begin, "right") - 1
    return {"rows": rows, "left": (anchor - begin).astype(np.uint8), "size": size.astype(np.uint8), "doc": docs[piece], "start": bases[piece] + begin - starts[piece], "group": deal.group(h[anchor], rows)}


def _equal_runs(rows: np.ndarray, left: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal fragments side by side, and the class of each place; compared byte by byte."""
    words = rows.view(np.uint64)
    h = left.astype(np.uint64) << np.uint64(8) | size
    for k in range(words.shape[1]):
        h = mix(h * _C1 + words[:, k])
    order = np.argsort(h, kind="stable")
    w, a, b, h = words[order], left[order], size[order], h[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    same = np.flatnonzero(~new)
    new[same] = (w[same] != w[same - 1]).any(axis=1)
    return order, np.cumsum(new) - 1


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document, those that overlap or touch as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    # a running maximum of ends within each document: lift documents apart
    rank = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(doc))))
    lift = rank * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(end, at)


_NUMBERS = ("doc", "doc_n", "times", "start", "c_doc", "c_start", "c_end")


def _steps(x: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Differences to the value before, values themselves where a new run begins."""
    out = x.astype(np.int64)
    out[1:] -= np.where(new[1:], 0, x[:-1])
    return out


def _encode(parts: dict[str, np.ndarray]) -> bytes:
    """Fragments come in order of document and place: documents as runs, places as steps, numbers by byte planes, all compressed."""
    doc, times = parts["doc"], parts["times"]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    of = np.repeat(doc, times)
    new = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    numbers = {**parts, "doc": doc[first], "doc_n": np.diff(np.append(first, len(doc))), "start": _steps(parts["start"], new)}
    planes = [np.ascontiguousarray(numbers[k].astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for k in _NUMBERS]
    head = np.array([len(parts["left"]), len(parts["bytes"]), *(len(numbers[k]) for k in _NUMBERS)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(head + parts["left"].tobytes() + parts["size"].tobytes() + b"".join(planes) + parts["bytes"].tobytes())


def _decode(blob: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, n_bytes, *counts = np.frombuffer(raw, "<u4", 2 + len(_NUMBERS)).tolist()
    at = 4 * (2 + len(_NUMBERS))
    out = {"left": np.frombuffer(raw, np.uint8, n, at), "size": np.frombuffer(raw, np.uint8, n, at + n)}
    at += 2 * n
    for k, c in zip(_NUMBERS, counts, strict=True):
        out[k] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * c, at).reshape(8, -1).T).view("<i8").ravel() if c else np.zeros(0, np.int64)
        at += 8 * c
    out["bytes"] = np.frombuffer(raw, np.uint8, n_bytes, at)
    out["doc"] = np.repeat(out["doc"], out.pop("doc_n"))
    of = np.repeat(out["doc"], out["times"])
    if len(of):  # sums of steps, less what came before each document
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sums = np.cumsum(out["start"])
        before = np.where(first > 0, sums[first - 1], 0)
        out["start"] = sums - np.repeat(before, np.diff(np.append(first, len(of))))
    return out


def _flush(found: list[dict], ranges: list[tuple], deal: Deal, fine: int):
    """One blob for each group (of `fine` groups that go together): unlike fragments, whose places of the smallest doc_id go along, and what is covered already."""
    f = {k: np.concatenate([x[k] for x in found]) for k in found[0]}
    order, cls = _equal_runs(f["rows"], f["left"], f["size"])
    first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])) if len(cls) else np.zeros(0, np.int64)
    doc = f["doc"][order]
    least = np.minimum.reduceat(doc, first) if len(first) else doc
    stays = doc == least[cls]
    gone = order[~stays]
    done = [*ranges, (f["doc"][gone], f["start"][gone], f["start"][gone] + f["size"][gone])]
    covered = _merge(*(np.concatenate(x) for x in zip(*done, strict=True)))
    times = np.bincount(cls[stays], minlength=len(first))
    unique, start = order[first], f["start"][order][stays]
    where = np.concatenate([[0], np.cumsum(times)])
    group = f["group"][unique] // fine
    by = np.lexsort((f["start"][unique], least, group))
    c_group = deal.of(covered[0]) // fine
    c_by = np.argsort(c_group, kind="stable")
    ids = np.union1d(group, c_group)  # groups that are present, however many there are in all
    cuts, ends = (np.searchsorted(group[by], ids, x) for x in ("left", "right"))
    c_cuts, c_ends = (np.searchsorted(c_group[c_by], ids, x) for x in ("left", "right"))
    blobs = []
    for a, z, c_a, c_z in zip(cuts.tolist(), ends.tolist(), c_cuts.tolist(), c_ends.tolist(), strict=True):
        u, c = by[a:z], c_by[c_a:c_z]
        rows, size, t = f["rows"][unique[u]], f["size"][unique[u]], times[u]
        places = np.repeat(where[u], t) + np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
        blobs.append(
            _encode({"bytes": rows[np.arange(deal.shape.width) < size[:, None]], "left": f["left"][unique[u]], "size": size, "doc": least[u], "times": t, "start": start[places], "c_doc": covered[0][c], "c_start": covered[1][c], "c_end": covered[2][c]})
        )
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["group", "blob"])


def _deal(deal: Deal, fine: int):
    window = deal.shape.window

    def run(batches):
        found: list[dict] = []
        held = 0
        pieces: list[tuple[int, int, np.ndarray]] = []
        waiting = 0

        def cut():
            nonlocal waiting
            raw = np.concatenate([p for _, _, p in pieces])
            starts = np.concatenate([[0], np.cumsum([len(p) for _, _, p in pieces])[:-1]])
            out = _fragments(raw, starts, np.array([d for d, _, _ in pieces]), np.array([b for _, b, _ in pieces]), deal) if len(raw) >= window else None
            pieces.clear()
            waiting = 0
            if out:
                found.append(out)

        for b in batches:
            raw, offsets = utf8(b.column("text"))
            for i, a, z in zip(b.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if i is None or z - a < window:
                    continue
                for base in range(0, z - a - window + 1, SLICE_BYTES - window):
                    piece = raw[a + base : min(z, a + base + SLICE_BYTES - 1)]
                    if waiting + len(piece) > SLICE_BYTES and pieces:
                        cut()
                    pieces.append((i, base, piece))
                    waiting += len(piece)
                    held += len(piece)
                    if held >= BATCH_BYTES or sum(len(x["left"]) for x in found) >= BATCH_ROWS:
                        cut()
                        if found:
                            yield _flush(found, [], deal, fine)
                        found, held = [], 0
            if pieces:
                cut()  # pieces view this batch
        if found:
            yield _flush(found, [], deal, fine)

    return run


def _laid(f: dict[str, np.ndarray], width: int, at: np.ndarray) -> np.ndarray:
    """A decoded blob's fragments as rows of bytes, each from its column `at` on."""
    columns = np.arange(width)
    mat = np.zeros((len(f["left"]), width), np.uint8)
    mat[(columns >= at[:, None]) & (columns < (at + f["size"])[:, None])] = f["bytes"]
    return mat


def _deal_again(deal: Deal):
    """Blobs of coarse groups -> blobs of fine groups, what came from several batches as one."""
    s = deal.shape

    def run(batches):
        found: list[dict] = []
        ranges: list[tuple] = []
        held = 0
        for b in batches:
            for blob in b.column("blob"):
                f = _decode(blob.as_buffer().to_pybytes())
                rows = _laid(f, s.width, np.zeros(len(f["left"]), np.int64))
                at = f["left"][:, None] + np.arange(ANCHOR)
                anchor = np.take_along_axis(rows, at.astype(np.int64), 1).view(">u8").astype(np.uint64)
                group = deal.group(mix(anchor[:, 0] * _C1 + anchor[:, 1] * _C2), rows)
                of = np.repeat(np.arange(len(rows)), f["times"])  # a row for each place
                found.append({"rows": rows[of], "left": f["left"][of], "size": f["size"][of], "doc": f["doc"][of], "start": f["start"], "group": group[of]})
                ranges.append((f["c_doc"], f["c_start"], f["c_end"]))
                held += len(of) + len(f["c_doc"])
                if held >= BATCH_ROWS:
                    yield _flush(found, ranges, deal, 1)
                    found, ranges, held = [], [], 0
        if found:
            yield _flush(found, ranges, deal, 1)

    return run


def _refine(rows: np.ndarray, group: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass: orders each group by the digit, splits it, and drops what is alone."""
    order = np.lexsort((digit, group))
    g, d = group[order], digit[order]
    cls = np.cumsum(np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])) - 1 if len(g) else g
    keep = np.bincount(cls)[cls] > 1 if len(g) else np.zeros(0, bool)
    return rows[order][keep], cls[keep]


def repeated_windows(mat: np.ndarray, left: np.ndarray, size: np.ndarray, doc: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, window's start in it) of the windows that also start in a smaller doc_id. mat: bytes around the anchors."""

    def digit(rows: np.ndarray, column: int) -> np.ndarray:
        return np.ascontiguousarray(mat[rows, column : column + 8]).view(">u8").ravel().astype(np.uint64)

    rows, group = np.arange(len(mat)), np.zeros(len(mat), np.int64)
    for c in range(s.side, s.side + ANCHOR, 8):
        rows, group = _refine(rows, group, digit(rows, c))
    out = []
    steps = [*range(0, s.window - 7, 8), *([s.window - 8] if s.window % 8 else [])]
    for o in range(s.places):  # the anchor's place in the window
        begin = left[rows].astype(np.int64) - o
        here = (begin >= 0) & (begin + s.window <= size[rows])
        r, g = rows[here], group[here]
        for k in steps:
            c = s.side - o + k
            if len(r) and not (c >= s.side and c + 8 <= s.side + ANCHOR):
                r, g = _refine(r, g, digit(r, c))
        if len(r):
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            least = np.minimum.reduceat(doc[r], first)
            cls = np.cumsum(np.concatenate([[True], g[1:] != g[:-1]])) - 1
            later = doc[r] > least[cls]
            out.append((r[later], left[r[later]].astype(np.int64) - o))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([r for r, _ in out]), np.concatenate([b for _, b in out])


def _sort(window: int):
    s = Shape(window)

    def run(key, table):
        parts = [_decode(x.as_buffer().to_pybytes()) for x in table.column("blob").combine_chunks()] if table.num_rows else []
        f = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        n = len(f["left"])
        done = [(f["c_doc"], f["c_start"], f["c_end"])]
        if n:
            size, left, doc, times = f["size"].astype(np.int64), f["left"], f["doc"], f["times"].astype(np.int64)
            mat = _laid(f, s.width, s.side - left.astype(np.int64))
            order, cls = _equal_runs(mat, left, f["size"])
            first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
            least = np.minimum.reduceat(doc[order], first)
            whole = np.zeros(n, bool)
            whole[order] = doc[order] > least[cls]
            stay = order[~whole[order]]
            stay_cls = cls[~whole[order]]
            rep = stay[np.searchsorted(stay_cls, np.arange(len(first)))]  # one of the smallest doc_id for each class
            alias = np.empty(n, np.int64)  # each fragment's class
            alias[order] = cls
            r, begin = repeated_windows(mat[rep], left[rep], size[rep], doc[rep], s)
            if len(r):  # runs of covered windows in each class, then for all its fragments that aren't covered as a whole
                o = np.lexsort((begin, r))
                r, begin = r[o], begin[o]
                cut = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (begin[1:] > begin[:-1] + window)]))
                r0, b0, b1 = r[cut], begin[cut], begin[np.append(cut[1:], len(r)) - 1] + window
            else:
                r0 = b0 = b1 = np.zeros(0, np.int64)
            of = np.repeat(np.arange(n), times)  # the fragment of each place
            place = f["start"]
            w = whole[of]
            done.append((doc[of[w]], place[w], place[w] + size[of[w]]))
            lo, hi = np.searchsorted(r0, alias[of], "left"), np.searchsorted(r0, alias[of], "right")
            count = np.where(w, 0, hi - lo)
            pick = np.repeat(lo, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            to = np.repeat(np.arange(len(of)), count)
            done.append((doc[of[to]], place[to] + b0[pick], place[to] + b1[pick]))
        d, a, b = _merge(*(np.concatenate(x) for x in zip(*done, strict=True)))
        return pa.table({"id": pa.array(d, pa.int64()), "s": pa.array(a, pa.int64()), "e": pa.array(b, pa.int64())})

    return run


def covered(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, s, e): byte ranges of documents to be removed; they may overlap."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    deal = Deal(Shape(window), max(8, math.ceil(total / GROUP_BYTES)), hot_anchors(docs, total, window))
    fine = math.ceil(deal.groups / FAN)
    dealt = docs.mapInArrow(freeing(_deal(deal, fine)), "group long, blob binary")
    if fine > 1:
        dealt = dealt.repartition("group").sortWithinPartitions("group").mapInArrow(_deal_again(deal), "group long, blob binary")
    if (tasks := deal.groups // 16) > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(tasks, "group")  # a task's share stays the same as the corpus grows
    return written(dealt.groupBy("group").applyInArrow(_sort(window), "id long, s long, e long"), "covered")


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_MORE = ", spans array<struct<s:long,e:long>>, kept binary"


def _finish(with_text: bool):
    span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches):
        for b in batches:
            rows = []
            spans = b.column("spans") if "spans" in b.schema.names else None
            for k, (i, t) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)):
                raw = (t or "").encode()
                kept, found = raw, []
                if spans is not None and spans[k].is_valid:
                    x = spans[k].values
                    a, z = (x.field(c).to_numpy() for c in ("s", "e"))
                    _, a, z = _merge(np.zeros(len(a), np.int64), a, z)
                    found = list(zip(a.tolist(), z.tolist(), strict=True))
                    edges = [0, *(y for x in found for y in x), len(raw)]
                    kept = b"".join(raw[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2))
                rows.append((i, len(raw), len(raw) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), [{"s": x, "e": y} for x, y in found], kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *([span, pa.binary()] if with_text else [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: len(kinds)])

    return run


def dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text: spans (bytes) and the kept bytes too."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = covered(docs, window)
    ids = ranges.select("id").distinct()
    table, bits = build_filter(ids, ids.count())

    def pick(want: bool):
        def run(batches):
            for b in batches:
                ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                hit = in_filter(table, bits, ids) if len(ids) else np.zeros(0, bool)
                yield b.filter(pa.array(hit == want))

        return run

    def untouched(batches):
        yield from _finish(with_text)(pick(False)(batches))

    schema = _OUT + (_MORE if with_text else "")
    spans = ranges.groupBy("id").agg(F.collect_list(F.struct("s", "e")).alias("spans"))  # bounded by a document's length
    changed = docs.mapInArrow(pick(True), "doc_id long, text string").join(spans, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "spans")
    return docs.mapInArrow(untouched, schema).union(changed.mapInArrow(_finish(with_text), schema))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(query_rows(spark, sf_dir))


QUERIES: dict[str, Query] = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE: dict[str, str] = {}
