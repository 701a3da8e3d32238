"""History of changing attributes by gaps and islands.

Deliveries become one row per period in which the attributes did not change.  Before any window runs, the
deliveries are reduced to one per (entity, start date) with map-side combine, so a window never holds more
rows of an entity than there are calendar dates, however many deliveries a hot entity has.

Defined results: rows without entity or start date do not count; null attributes equal each other; of
deliveries with the same entity and start the one loaded last counts, then the one of highest id (nulls
lowest); exact repeats count once; an empty table gives an empty history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR = "9999-12-31"


def open_end(end: Column) -> Column:
    """Null for an end that is far away or missing."""
    return F.when(end != F.lit(FAR).cast("date"), end)


def latest_per_start(deliveries: DataFrame) -> DataFrame:
    """doc_id, valid_from, and valid_to, state, tag of the delivery that counts for that start."""
    rank = F.struct(
        F.col("loaded_at").isNotNull().alias("a"), F.col("loaded_at").alias("b"), F.col("version_id").isNotNull().alias("c"), F.col("version_id").alias("d"),
        F.col("valid_to").isNotNull().alias("e"), F.col("valid_to").alias("f"), F.col("checksum_text").isNotNull().alias("g"), F.col("checksum_text").alias("h"),
    )
    last = deliveries.where(F.col("doc_id").isNotNull() & F.col("valid_from").isNotNull()).groupBy("doc_id", "valid_from").agg(F.max(rank).alias("r"))
    return last.select("doc_id", "valid_from", F.col("r.f").alias("valid_to"), F.col("r.h").alias("state"))


def periods(deliveries: DataFrame) -> DataFrame:
    """doc_id, state, valid_from, valid_to (dates, null: open), is_current: one row per unchanged period.

    Needs doc_id, version_id, valid_from, valid_to, checksum_text, loaded_at.  lag() of the attribute hash
    marks changes, a running sum numbers the islands, the minimum start and the next island's start give
    the period; the last period ends as its last delivery says.
    """
    rows = latest_per_start(deliveries)
    by_start = Window.partitionBy("doc_id").orderBy("valid_from")
    mark = F.sha2(F.coalesce(F.concat(F.lit("v"), "state"), F.lit("")), 256)
    before = F.lag("_hash").over(by_start)
    marked = rows.withColumn("_hash", mark).withColumn("_change", F.when(before.isNull() | (before != F.col("_hash")), 1).otherwise(0))
    numbered = marked.withColumn("_island", F.sum("_change").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy("doc_id", "_island").agg(F.min("valid_from").alias("valid_from"), F.max_by("valid_to", "valid_from").alias("_said"), F.first("state").alias("state"))
    following = F.lead("valid_from").over(Window.partitionBy("doc_id").orderBy("_island"))
    return (
        islands.withColumn("_next", following)
        .withColumn("valid_to", F.when(F.col("_next").isNotNull(), F.date_sub("_next", 1)).otherwise(open_end(F.col("_said"))))
        .select("doc_id", "state", "valid_from", "valid_to", F.col("_next").isNull().alias("is_current"))
    )


def day(date: Column) -> Column:
    """yyyy-MM-dd, '' for null."""
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))
