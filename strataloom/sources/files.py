"""File sources and sinks: line-delimited JSON, Markdown, assets."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of line-delimited JSON; blank lines are skipped, a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All shards of a phase folder with ``shard_key``, the name of the file."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.jsonl").json(folder)
    return rows.withColumn("shard_key", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1))


def write_table(df: DataFrame, path: str, form: str = "parquet", partition_by: list[str] | None = None) -> int:
    """Write through the commit protocol and give the number of rows, counted on the way."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(form)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return seen.get["rows"]


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows) by an error column."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def write_json(path: str, value: object, spark: SparkSession | None = None) -> None:
    """Publish a small JSON document: a temporary file beside it, flushed, then renamed.

    With a session the path may be on any file system that the cluster knows.
    """
    if spark is not None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        target, partial = hadoop.Path(path), hadoop.Path(f"{path}.partial-{uuid.uuid4().hex}")
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        stream = fs.create(partial, True)
        try:
            stream.write(json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2).encode())
        finally:
            stream.close()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(partial, target):
            raise OSError(f"could not publish {path}")
        return
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder, prefix=".partial-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            json.dump(value, out, ensure_ascii=False, sort_keys=True, indent=2)
            out.flush()
            os.fsync(out.fileno())
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def read_recursive(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files below a folder."""
    return spark.read.option("recursiveFileLookup", True).parquet(root)


def asset_digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, digest`` of binary assets such as tokenizer files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("digest"))


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """``name, text`` of all Markdown files of a folder."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder)
    return rows.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def links(pages: DataFrame) -> DataFrame:
    """``name, target`` of the relative Markdown links of pages."""
    found = F.regexp_extract_all("text", F.lit(r"\]\(([^)#\s]+)(?:#[^)\s]*)?\)"), 1)
    return pages.select("name", F.explode(found).alias("target")).where(~F.col("target").rlike("^[a-z]+:"))


def front_matter(pages: DataFrame) -> DataFrame:
    """``name, key, value`` of the lines between the leading ``---`` lines of pages."""
    head = F.regexp_extract("text", r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    lines = pages.select("name", F.explode(F.split(head, "\n")).alias("line")).where(F.col("line").rlike(r"^[\w-]+\s*:"))
    return lines.select("name", F.trim(F.split_part("line", F.lit(":"), F.lit(1))).alias("key"), F.trim(F.regexp_replace("line", r"^[^:]*:", "")).alias("value"))


def date_headings(pages: DataFrame) -> DataFrame:
    """``name, day`` of the headings of pages that begin with a date."""
    days = F.regexp_extract_all("text", F.lit(r"(?m)^#+\s*\[?(\d{4}-\d{2}-\d{2})"), 1)
    return pages.select("name", F.explode(days).alias("day"))


def unresolved(pages: DataFrame) -> DataFrame:
    """Links whose target is no page."""
    names = pages.select(F.col("name").alias("_name"))
    found = links(pages)
    return found.join(names, F.element_at(F.split("target", "/"), -1) == F.col("_name"), "left_anti")


def unlinked(pages: DataFrame, index: str) -> DataFrame:
    """Pages that the index page does not link to."""
    linked = links(pages.where(F.col("name") == index)).select(F.element_at(F.split("target", "/"), -1).alias("name"))
    return pages.select("name").where(F.col("name") != index).join(linked, "name", "left_anti")
