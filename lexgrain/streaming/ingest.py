"""Structured Streaming runners over the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexgrain.operators.upserts import earliest
from lexgrain.sources import acts_xml, files


def watch_acts(spark: SparkSession, directory: str, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Parse new .xml and .zip files of a directory into out/raw, out/docs and out/nodes.

    Every micro-batch overwrites the folders of its own batch id, so a replayed batch leaves its rows once; content
    that an earlier batch delivered is left out by its hash.
    """
    stream = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{xml,zip}").load(directory)
    )

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = files.with_members(batch).withColumn("sha256", F.sha2("content", 256)).where(~F.lower("path").endswith(".zip"))
        fresh = earliest(rows, ["sha256"], "path")
        try:
            held = session.read.parquet(f"{out}/raw").where(F.col("batch") != number).select("sha256")
            fresh = fresh.join(held, "sha256", "left_anti")
        except Exception as e:  # nothing is there before the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        found = acts_xml.parsed(fresh).persist()
        found.select("path", F.explode("nodes").alias("n")).select("path", "n.*").write.mode("overwrite").parquet(f"{out}/nodes/batch={number}")
        found.select("path", "doc.*", "parse_error").write.mode("overwrite").parquet(f"{out}/docs/batch={number}")
        fresh.select("sha256", "path", "derived_from").write.mode("overwrite").parquet(f"{out}/raw/batch={number}")
        found.unpersist()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and key of a stream, with a watermark for late rows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", key, "n")
