"""Merging of overlapping, nested and adjoining date intervals, and the gaps between them.

Intervals of an entity with one start are first reduced to the longest with map-side combine, so that a
window holds at most one row per calendar date of an entity, however hot it is.

Defined results: null start or end is unbounded, as is the end 9999-12-31; intervals that end before they
start, and rows without entity, do not count; an entity with one period has no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST, LAST = "0001-01-01", "9999-12-31"


def merged(rows: DataFrame, key: str = "doc_id", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """key, start_date, end_date of the continuous periods; null is unbounded.

    Each start is compared with the running maximum of the ends before it; a later start than the day after
    that maximum opens an island, and islands are numbered cumulatively and aggregated.
    """
    lo, hi = F.lit(FIRST).cast("date"), F.lit(LAST).cast("date")
    closed = rows.select(F.col(key).alias("k"), F.coalesce(F.col(start), lo).alias("s"), F.coalesce(F.col(end), hi).alias("e"))
    longest = closed.where(F.col("k").isNotNull() & (F.col("s") <= F.col("e"))).groupBy("k", "s").agg(F.max("e").alias("e"))
    by_start = Window.partitionBy("k").orderBy("s")
    reach = F.max("e").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = longest.withColumn("_reach", reach).withColumn("_new", F.when(F.col("_reach").isNull() | (F.datediff("s", "_reach") > 1), 1).otherwise(0))
    numbered = opened.withColumn("_island", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("k", "_island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return spans.select(F.col("k").alias(key), F.when(F.col("s") != lo, F.col("s")).alias("start_date"), F.when(F.col("e") != hi, F.col("e")).alias("end_date"))


def periods_and_gaps(rows: DataFrame, key: str = "doc_id", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """key, span_kind ('period' or 'gap'), start_date, end_date; null is unbounded (periods only)."""
    spans = merged(rows, key, start, end)
    order = Window.partitionBy(key).orderBy(F.col("start_date").asc_nulls_first())
    following = spans.withColumn("_next", F.lead("start_date").over(order))
    period = F.struct(F.lit("period").alias("span_kind"), F.col("start_date").alias("start_date"), F.col("end_date").alias("end_date"))
    gap = F.struct(F.lit("gap").alias("span_kind"), F.date_add("end_date", 1).alias("start_date"), F.date_sub("_next", 1).alias("end_date"))
    both = F.when(F.col("_next").isNotNull(), F.array(period, gap)).otherwise(F.array(period))
    return following.select(key, F.explode(both).alias("x")).select(key, "x.*")
