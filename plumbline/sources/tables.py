"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SMALL_ROWS = 200_000


def kept(df: DataFrame) -> DataFrame:
    """df computed once: checkpointed where a shared folder is set, else persisted, so that lineage brings lost parts back."""
    sc = df.sparkSession.sparkContext
    folder = sc.getCheckpointDir() or df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """The narrow side of a join with wide rows: broadcast where a count shows that it is small, else left to a plain join. df should be kept()."""
    return F.broadcast(df) if df.count() <= most else df
