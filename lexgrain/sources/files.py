"""Files: recursive scan, zip members, raw file records, JSON lines."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT = "id string, source string, source_id string, context string, text string, url string"


def scan(spark: SparkSession, directory: str) -> DataFrame:
    """path, modificationTime, length, content of all .xml and .zip files below a directory."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{xml,zip}").load(directory)
    return found.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))


def expand_zips(files: DataFrame) -> DataFrame:
    """path (zip!member), derived_from, content of the .xml members of zip files; unreadable files have none."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in z.namelist():  # one member at a time
                            if name.lower().endswith(".xml"):
                                yield pd.DataFrame({"path": [f"{path}!{name}"], "derived_from": [path], "content": [z.read(name)]})
                except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
                    continue

    return files.where(F.lower("path").endswith(".zip")).select("path", "content").mapInPandas(work, "path string, derived_from string, content binary")


def with_members(files: DataFrame) -> DataFrame:
    """path, derived_from, modificationTime, content: files and the members of zips; a zip is a container."""
    own = files.select("path", F.lit(None).cast("string").alias("derived_from"), "modificationTime", "content")
    inner = expand_zips(files).select("path", "derived_from", F.lit(None).cast("timestamp").alias("modificationTime"), "content")
    return own.unionByName(inner)


def raw_records(files: DataFrame) -> DataFrame:
    """path, derived_from, sha256, size_bytes, mtime, is_from_zip, status of files."""
    status = F.when(F.lower("path").endswith(".zip"), "container").otherwise("new")
    return files.select(
        "path", "derived_from", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size_bytes"), F.col("modificationTime").alias("mtime"),
        F.col("derived_from").isNotNull().alias("is_from_zip"), status.alias("status"),
    )


def run_stats(records: DataFrame, path: str = "path", from_zip: str = "is_from_zip") -> DataFrame:
    """files, xml, zip; members of zips are no files of their own."""
    own = ~F.coalesce(F.col(from_zip), F.lit(False))
    return records.select(
        F.count_if(own).alias("files"), F.count_if(own & F.lower(path).endswith(".xml")).alias("xml"), F.count_if(own & F.lower(path).endswith(".zip")).alias("zip")
    )


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Export records; blank and invalid lines are rows with `bad` true."""
    return parse_jsonl(spark.read.text(path))


def parse_jsonl(lines: DataFrame, value: str = "value") -> DataFrame:
    rest = [c for c in lines.columns if c != value]
    item = F.from_json(F.trim(value), EXPORT + ", _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    bad = (F.trim(value) == "") | F.col("_i._bad").isNotNull() | F.col("_i").isNull()
    return lines.withColumn("_i", item).select(*rest, "_i.id", "_i.source", "_i.source_id", "_i.context", "_i.text", "_i.url", F.coalesce(bad, F.lit(True)).alias("bad"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish(rows: DataFrame, path: str) -> int:
    """Write a table, read it again and check its number of rows."""
    from lexgrain.plans.scale import cut_lineage

    held = cut_lineage(rows)
    held.write.mode("overwrite").parquet(path)
    n = rows.sparkSession.read.parquet(path).count()
    if n != held.count():
        raise RuntimeError(f"{path}: {n} rows published of {held.count()}")
    return n
