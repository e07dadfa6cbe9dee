"""An addition beside the batch plans: images that arrive in a folder are labelled as a stream, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import regions
from ..sources.images import escape_glob


def label_arrivals(spark: SparkSession, root: str, checkpoint: str, sink, **label_options):
    """Starts a query over new files of root; sink(labels, epoch) gets each batch's rel_path, mask, labels, error."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(escape_glob(root))

    def batch(rows: DataFrame, epoch: int) -> None:
        sink(regions.label(rows.withColumnRenamed("path", "rel_path"), **label_options), epoch)

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
