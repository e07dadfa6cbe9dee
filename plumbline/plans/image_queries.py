"""Image kernels and path search over the supplied tables; vectors serve as eight by eight images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import codec, lattice, masks
from ..operators import candidates
from ..sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _pixels(v) -> np.ndarray:
    return np.clip(np.floor((np.asarray(v, np.float64) + 1.0) * 127.5), 0, 255).astype(np.uint8).reshape(8, -1)


def _placed(image: np.ndarray) -> int:
    return int((image.ravel().astype(np.int64) * np.arange(1, image.size + 1)).sum())


@query("SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x, i: i * greatest(0, least(255, floor((CAST(x AS DOUBLE) + 1) * 127.5))))) AS BIGINT) AS placed_sum FROM embeddings")
def image_roundtrip(spark, sf):
    """Encoded as PNG and decoded again; pixels weigh their places, so that swapped ones tell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"vec_id": b.vec_id, "placed_sum": [_placed(codec.decode(codec.encode_png(_pixels(v)))) for v in b.embedding]})

    return table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, placed_sum long")


@query("SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x, i: CASE WHEN x >= 0 THEN i ELSE 0 END)) AS BIGINT) AS placed_sum FROM embeddings")
def rle_bytes(spark, sf):
    """Masks through the run-length format and back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [np.where(np.asarray(v).reshape(8, -1) >= 0, 255, 0).astype(np.uint8) for v in b.embedding]
            yield pd.DataFrame({"vec_id": b.vec_id, "placed_sum": [_placed(masks.rle_decode(masks.rle_encode(m), m.shape) > 0) for m in found]})

    return table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, placed_sum long")


@query(
    """
WITH RECURSIVE r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events),
c AS (SELECT user_id, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS n, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS s,
        event_id % 40 AS y0, event_id % 40 + 20 + event_id % 7 AS y1, value / 100.0 AS score FROM r WHERE k <= 3),
w AS (SELECT user_id, n, s, y0, y1, CAST(NULL AS DOUBLE) AS a0, CAST(NULL AS DOUBLE) AS a1, CAST(-score AS DOUBLE) AS cost FROM c WHERE n = 1
  UNION ALL
  SELECT c.user_id, c.n, c.s, c.y0, c.y1, (c.y0 - w.y0) / (10.0 * (c.s - w.s)), (c.y1 - w.y1) / (10.0 * (c.s - w.s)),
    w.cost - c.score + (abs(c.y0 - w.y0) + abs(c.y1 - w.y1) + 0.5 * abs((c.y1 - w.y1) - (c.y0 - w.y0))) / (100.0 * greatest(1, c.s - w.s))
      + coalesce(12.0 * 10 / 100 * (abs((c.y0 - w.y0) / (10.0 * (c.s - w.s)) - w.a0) + abs((c.y1 - w.y1) / (10.0 * (c.s - w.s)) - w.a1)), 0)
  FROM w JOIN c ON c.user_id = w.user_id AND c.n = w.n + 1)
SELECT user_id, CAST(max(n) AS BIGINT) AS strips, round(min_by(cost, struct_pack(a := -n, b := cost)), 6) AS cost FROM w GROUP BY 1"""
)
def viterbi_path(spark, sf):
    """The engine's own path over strips (event types, those that a user has) with at most three pairs of rows each: its cost, curvature included."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    c = candidates.top(e, ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")], 3)
    pair = F.struct("event_type", (F.col("event_id") % 40).cast("double").alias("y0"), (F.col("event_id") % 40 + 20 + F.col("event_id") % 7).cast("double").alias("y1"), (F.col("value") / 100).alias("score"))
    groups = c.groupBy("user_id").agg(F.collect_list(pair).alias("pairs"))  # at most three of a strip

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strips, cost = [], []
            for found in b.column("pairs").to_pylist():
                held = [(k, [p for p in found if p["event_type"] == t]) for k, t in enumerate(_STRIPS)]
                held = [(k, p) for k, p in held if p]
                rows = [np.array([[q["y0"], q["y1"]] for q in p]) for _, p in held]
                net = lattice.boundaries(np.array([10.0 * k for k, _ in held]), rows, [np.array([q["score"] for q in p]) for _, p in held], 100, 10.0, 1.0, 12.0)
                strips.append(len(held))
                cost.append(round(net.cost(net.through(len(held) // 2)), 6))
            yield pa.RecordBatch.from_arrays([b.column("user_id"), pa.array(strips, pa.int64()), pa.array(cost, pa.float64())], names=["user_id", "strips", "cost"])

    return groups.mapInArrow(run, "user_id long, strips long, cost double")


_STRIPS = ("click", "error", "purchase", "signup", "view")


@query()
def defect_labels(spark, sf):
    """Masks and polygons of vector images: how many polygons and how much of the image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, v in zip(b.vec_id, b.embedding, strict=True):
                m = masks.defect_mask(np.kron(_pixels(v), np.ones((4, 4), np.uint8)), 9, 0.0, None, 4.0)
                rows.append((i, len(masks.polygons(m, 0.0)), float((m > 0).mean())))
            yield pd.DataFrame(rows, columns=["vec_id", "n_polygons", "fraction"])

    return table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, n_polygons int, fraction double")
