"""Image files as a relation, and the sinks of the pipeline."""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..operators import catalog


def escape_glob(path: str) -> str:
    """A path whose brackets, braces, stars and question marks are literal."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


_DECODED = r"\.(jpe?g|tiff?|gif)$"


def _decoded(spark: SparkSession, root: str) -> DataFrame:
    """JPEG, TIFF and GIF files by Spark's image source, 8 bits a sample: path, content as plain pixels (empty where the file is broken)."""
    names = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[tT][iI][fF],[tT][iI][fF][fF],[gG][iI][fF]}"
    rows = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", names).option("dropInvalid", "false").load(escape_glob(root))
    number = lambda c: F.unhex(F.lpad(F.hex(F.col(f"image.{c}")), 8, "0"))
    pixels = F.concat(F.lit(bytearray(codec.PIXELS)), number("height"), number("width"), number("nChannels"), F.col("image.data"))
    content = F.when(F.col("image.height") > 0, pixels).otherwise(F.lit(bytearray(b"")))
    return rows.select(F.col("image.origin").alias("path"), F.lit(None).cast("timestamp").alias("modificationTime"), F.octet_length(F.col("image.data")).cast("long").alias("length"), content.alias("content"))


def scan(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """rel_path, length, modification_time, content and identity; content is read only where a plan uses it.

    JPEG, TIFF and GIF come decoded to 8-bit pixels (their length is that of the pixels, their time null); WebP can't be read.
    Files of no bytes, which the file source passes over, come from its listing with empty content. Names and folders that
    start with _ or . below the root are left out by the file source.
    """
    files = everything = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(escape_glob(root))
    files = files.where(~F.lower("path").rlike(_DECODED)).unionByName(_decoded(spark, root))
    one = lambda p: F.regexp_replace(p, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  the listing writes file:///, the rows file:/
    listed = spark.createDataFrame([(unquote(f),) for f in everything.inputFiles()], "path string").withColumn("path", one("path"))
    blank = listed.join(files.select(one("path").alias("path")), "path", "left_anti")
    blank = blank.select("path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), F.lit(bytearray(b"")).alias("content"))
    base = root.rstrip("/").split("://")[-1].replace("file:", "")
    rel = F.regexp_replace(F.col("path"), f"^.*?{re.escape(base)}/", "")
    rows = files.unionByName(blank).select("path", "length", F.col("modificationTime").alias("modification_time"), "content").withColumn("rel_path", rel)
    rows = catalog.with_identity(rows)
    return rows.where(F.col("ext").isin(extensions)) if extensions else rows


def check_paths(source: str, output: str) -> tuple[str, str]:
    """Both paths resolved: the source is a folder, and the output is neither it nor inside it."""
    a, b = (os.path.realpath(p.removeprefix("file://")) for p in (source, output))
    if not os.path.isdir(a):
        raise NotADirectoryError(f"no source folder: {a}")
    if os.path.commonpath([a, b]) == a:
        raise ValueError("the output must lie outside the source folder")
    return a, b


def write_report(rows: DataFrame, path: str) -> None:
    """CSV with a header; booleans as 1 and 0, nested values as JSON, blanks for what wasn't measured; never over an existing one."""
    columns = [F.col(f.name).cast("int").alias(f.name) if f.dataType.simpleString() == "boolean" else F.to_json(f.name).alias(f.name) if f.dataType.simpleString().startswith(("array", "struct", "map")) else F.col(f.name) for f in rows.schema]
    rows.select(*columns).write.mode("errorifexists").option("header", "true").option("emptyValue", "").csv(path)


def write_files(rows: DataFrame, root: str, path: str, content: str) -> DataFrame:
    """Writes each row's bytes to root/path, parents included; root is a folder that all executors share. The written paths come back."""
    def run(batches):
        for b in batches:
            for p, data in zip(b[path], b[content], strict=True):
                to = os.path.join(root, p)
                os.makedirs(os.path.dirname(to), exist_ok=True)
                with open(to + ".part", "wb") as f:  # a retried task replaces the file whole
                    f.write(data if isinstance(data, bytes | bytearray) else str(data).encode())
                os.replace(to + ".part", to)
            yield b[[path]]

    return rows.where(F.col(content).isNotNull()).select(path, content).mapInPandas(run, f"{path} string")


def package(rows: DataFrame, to: str, class_names: list[str]) -> int:
    """A ZIP of images and labels in train/, with data.yaml: rel_path, content, labels. Names must be unique without case, each with labels.

    One archive is one file of one writer; its rows are streamed in order of path.
    """
    import zipfile

    if not class_names or not to.endswith(".zip"):
        raise ValueError("class names and a .zip path are needed")
    name = F.element_at(F.split("rel_path", "/"), -1)
    lost = rows.where(F.col("labels").isNull()).select("rel_path").limit(10).collect()
    twice = rows.groupBy(F.lower(F.regexp_replace(name, r"\.[^.]*$", "")).alias("stem")).count().where("count > 1").select("stem").orderBy("stem").limit(10).collect()
    if lost or twice:
        raise ValueError(f"missing labels: {[r[0] for r in lost]}; duplicate names: {[r[0] for r in twice]}")
    n = 0
    with zipfile.ZipFile(to, "x", zipfile.ZIP_DEFLATED) as z:
        for r in rows.select("rel_path", "content", "labels").orderBy("rel_path").toLocalIterator():
            leaf = r.rel_path.rsplit("/", 1)[-1]
            z.writestr(f"train/images/{leaf}", bytes(r.content))
            z.writestr(f"train/labels/{leaf.rsplit('.', 1)[0]}.txt", "\n".join(r.labels) + ("\n" if r.labels else ""))
            n += 1
        for d in ("valid/images/", "valid/labels/"):
            z.writestr(d, "")
        z.writestr("data.yaml", f"train: train/images\nval: valid/images\nnc: {len(class_names)}\nnames: {class_names}\n")
    return n
