"""Each registered query over whole tables against a plain, slow version of its contract."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import langid, quality, registry, toxicity

from .test_mixing import fractions
from .test_operators import ROWS, cut, linked, prose

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Tables with nulls, repeats, long texts, and columns of clashing names."""
    to = str(tmp_path_factory.mktemp("sf"))
    clash = ["label", "key", "id", "row", "digest", "score", "held_out", "size", "n", "h"]
    rows = [list(r) for r in dict((r[0], r) for r in ROWS).values()]
    rows += [[1000 + i, prose("de" if i % 2 else "en", 60), "de" if i % 2 else "en", f"s{i % 3}", 9] for i in range(120)]
    for r in rows[-60:]:
        r[1] += " vile idiot" if r[0] % 5 == 0 else " nice day"
    rows += [[2000, "q " * 60000 + "vile idiot", "en", "s9", 7]]  # a labelled text of over 100 kB
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select("*", *(F.lit(f"own {c}").alias(c) for c in clash)).repartition(3).write.parquet(f"{to}/documents.parquet")
    labels = [(r[0], int(r[0] % 2), int(r[0] % 5 == 0)) for r in rows if r[0] >= 1000] + [(64, 1, 0), (66, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{to}/labels.parquet")
    rng = np.random.default_rng(6)
    vectors = [rng.normal(size=8) for _ in range(60)]
    vectors += [v + 0.1 * rng.normal(size=8) for v in vectors[:30]] + [vectors[0], np.zeros(8)]
    table = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)] + [(500, None, 1), (501, [1.0, float("nan")] * 4, 0), (502, [1.0] * 8, None), (503, [1.0, None] * 4, 0)]
    spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").write.parquet(f"{to}/embeddings.parquet")
    return to, [tuple(r) for r in rows], labels, table


def remainder(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_op1(spark, sf):
    to, rows, *_ = sf
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op1_suffix_dedup"](spark, to).collect()}
    assert got == cut(rows, 50)


def test_op2(spark, sf):
    to, rows, *_ = sf
    size = {r[0]: len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r[1] or "")]) for r in rows}
    by = Counter()
    for r in rows:
        by[r[3]] += size[r[0]]
    goal = fractions(dict(by))
    source = {r[0]: r[3] for r in rows}
    got = QUERIES["op2_mixing"](spark, to).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], by[s]) and r.target == pytest.approx(float(goal[s])) and r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in by:
        left = [r.size for r in got if source[r.doc_id] == s and r.size and r.taken < 3 * r.size]
        assert abs(taken[s] - float(goal[s])) <= max(left, default=0)


def test_op3_is_the_pairwise_machine(spark, sf):
    to, rows, labels, _ = sf
    got = {r.doc_id: r for r in QUERIES["op3_quality"](spark, to).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (remainder(r.doc_id, 3) == 1) for r in got.values())
    of = {r[0]: r for r in rows}
    learn = sorted((i, of[i][1] or "", of[i][4], y) for i, y, _ in labels if y is not None and remainder(i, 3) != 1 and i in of)
    assert any(len(t) > 100_000 for _, t, _, _ in learn) or remainder(2000, 3) == 1
    m = quality.Model([(t, n) for _, t, n, _ in learn], np.array([y for *_, y in learn]), float(np.mean([y for *_, y in learn])))
    for i in (1003, 64, 65, 2000):
        t, n = of[i][1], of[i][4]
        (stats, doc, bucket), = quality.features(pa.array([t], pa.large_string()), pa.array([n], pa.float64()))
        (f,), (x,) = m._encode(stats, doc, bucket)
        z = m.bias + sum(m.w[a] * p for a, p in zip(f, x))
        v = m.v[f] * np.asarray(x)[:, None]
        gram = v @ v.T
        z += (gram.sum() - np.trace(gram)) / 2  # all pairs, one by one
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6, abs=1e-9)


def test_op4(spark, sf):
    to, rows, *_ = sf
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_ngram_join"](spark, to).collect()}
    assert got == linked(rows)


def test_op5_is_plain_compression(spark, sf):
    import zstandard

    to, rows, *_ = sf
    got = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, to).collect()}
    assert len(got) == len(rows) and all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in got.values())
    learn = defaultdict(list)
    for i, t, lang, *_ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        if remainder(i, 3) != 1 and lang is not None and t is not None:
            learn[lang].append(langid.normalised(t))
    model = langid.learn(spark.read.parquet(f"{to}/documents.parquet"))
    credit = dict(zip(model, langid.credits(model), strict=True))
    params = zstandard.ZstdCompressionParameters(**langid.PARAMETERS)
    for i, t, *_ in rows:
        low = langid.normalised(t)
        if not low:
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        blocks = [f" {low} "[k : k + langid.BLOCK_CHARS].encode() for k in range(0, len(low) + 2, langid.BLOCK_CHARS)]
        plain = sum(len(zstandard.ZstdCompressor(compression_params=params).compress(b)) - 6 for b in blocks)
        size = {}
        for lang, body in model.items():
            d = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            n = sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(b)) - 6 for b in blocks)
            size[lang] = n - min(max(plain - n, 0), credit[lang] * plain)
        assert got[i].lang_pred == min(model, key=lambda x: size[x])
    # every sampled text reaches its dictionary: whole, or in pieces of its whole length
    for lang, texts in learn.items():
        for t in dict.fromkeys(texts):
            assert not t or t[:40].encode() in model[lang] and t[-30:].encode() in model[lang]


def test_op7(spark, sf):
    to, _, _, table = sf
    good = {i: (np.array(v, float), y) for i, v, y in table if v is not None and y is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    near = defaultdict(set)
    for i, (v, y) in good.items():
        for j, (w, z) in good.items():
            if i != j and y == z and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.93:
                near[i].add(j)
    got = {r.vec_id: r for r in QUERIES["op7_embedding_dedup"](spark, to).collect()}
    assert set(got) == {r[0] for r in table} and sum(map(len, near.values())) > 20
    for i, r in got.items():
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        assert (r.n_links, r.component_id, r.kept) == (len(near[i]), min(seen), i == min(seen))


def slow_ratio(model, text):
    """Per word of a text without repeated lines: the log-likelihood ratio, every count looked up one by one."""
    (levels, _, cuts), = toxicity.words_of(pa.array([text], pa.large_string()))
    out, before = [], np.uint64(0)
    for k in range(int(cuts[-1])):
        pair = toxicity.mix(np.array([before], np.uint64) * toxicity._PAIR + levels[0][k : k + 1])[0]
        logs = []
        for c in (1, 0):
            m = model.by[c]
            slot = [int(x[k] >> np.uint64(64 - toxicity.SHARED_BITS)) for x in levels]
            p = model.shared[slot[-1]] / model.total
            for j in range(len(levels) - 1, -1, -1):
                names, of = m["chain"][j]
                if j < len(levels) - 1:
                    p *= min(model.shared[slot[j]] / model.shared[slot[j + 1]], 1.0)
                count = dict(zip(names.tolist(), of.tolist(), strict=True)).get(int(levels[j][k]), 0.0)
                kept = sum(max(x - m["d"], 0) for x in of.tolist())
                p = max(count - m["d"], 0) / m["total"] + (1 - kept / m["total"]) * p
            ctx = {a: (n, t) for a, n, t in zip(m["ctx"].tolist(), m["ctx_n"].tolist(), m["ctx_t"].tolist(), strict=True)}
            n, types = ctx.get(int(before), (0.0, 0.0))
            two = dict(zip(m["bi"].tolist(), m["n"].tolist(), strict=True)).get(int(pair), 0.0)
            logs.append(math.log((max(two - m["d"], 0) / n + m["d"] * types / n * p) if n else p))
        out.append(logs[0] - logs[1])
        before = levels[0][k]
    return np.array(out)


def test_op8_is_kneser_ney(spark, sf):
    to, rows, labels, _ = sf
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, to).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (remainder(r.doc_id, 4) == 2) for r in got.values())
    of = {r[0]: r for r in rows}
    learn = sorted((i, of[i][1] or "", y) for i, _, y in labels if y is not None and remainder(i, 4) != 2 and i in of)
    shared = np.zeros(1 << toxicity.SHARED_BITS, np.int64)
    toxicity.count_shared(pa.array([r[1] or "" for r in rows], pa.large_string()), shared)
    m = toxicity.Model([t for _, t, _ in learn], np.array([y for *_, y in learn]), shared, float(np.mean([y for *_, y in learn])))
    for i in (1007, 1055, 1119, 3):
        ratio = slow_ratio(m, of[i][1])
        k = min(toxicity.WINDOW, len(ratio))
        top = max(ratio[j : j + k].sum() for j in range(len(ratio) - k + 1)) / toxicity.WINDOW
        strong = math.log1p(100 * ratio[ratio > toxicity.STRONG].sum() / (len(ratio) + 20))
        x = (np.array([ratio.mean(), top, strong]) - m.centre) / m.scale
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-(m.curve[0] + x @ m.curve[1:]))), rel=1e-6, abs=1e-9)
    empty = [r for r in rows if not (r[1] or "").strip()]
    assert empty and all(got[r[0]].score == pytest.approx(m.share) for r in empty)


def test_op9(spark, sf):
    to, rows, *_ = sf
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    got = QUERIES["op9_exact_dedup"](spark, to).collect()
    want = {i: (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want and len(got) == len(rows)


def test_op10(spark, sf):
    from tokenizers import Tokenizer

    from plumbline.llm import packing

    to, rows, *_ = sf
    tok = Tokenizer.from_file(packing.default_tokenizer())
    got = QUERIES["op10_packing"](spark, to).collect()
    by = defaultdict(dict)
    room = defaultdict(list)
    for r in got:
        by[r.doc_id][r.piece] = r
        room[r.sequence_id].append((r.offset, r.length))
    for i, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        parts = [ids[k : k + 4096] for k in range(0, len(ids), 4096)]
        assert len(by[i]) == len(parts)
        for k, x in enumerate(parts):
            r = by[i][k]
            assert (r.start, r.length, r.ids_crc32) == (4096 * k, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
    for x in room.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(room) <= -(-sum(r.length for r in got) // 4096) + 1


def test_op6(spark, sf):
    to, rows, *_ = sf
    from plumbline.llm import licenses

    f = licenses.Scanner()
    got = {r.doc_id: r for r in QUERIES["op6_license_scan"](spark, to).collect()}
    for i, t, *_ in rows:
        found, matches = f.scan(t)
        assert (got[i].n_matches, got[i].licenses, got[i].sentence_ids) == (len(matches), ",".join(sorted({m[0] for m in matches})), ",".join(k for *_, k in found))
