"""Versions of one provision whose validity overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST, LAST = "0001-01-01", "9999-12-31"


def overlaps(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    """Closed intervals with null as unbounded."""
    lo, hi = F.lit(FIRST).cast("date"), F.lit(LAST).cast("date")
    return (F.coalesce(a_from, lo) <= F.coalesce(b_to, hi)) & (F.coalesce(b_from, lo) <= F.coalesce(a_to, hi))


def severity(a_current: Column, b_current: Column, a_to: Column, b_to: Column) -> Column:
    no = F.lit(False)
    both = F.coalesce(a_current, no) & F.coalesce(b_current, no)
    return F.when(both | (a_to.isNull() & b_to.isNull()), "critical").otherwise("warning")


def is_current(valid_to: Column) -> Column:
    return valid_to.isNull()


def conflict_pairs(nodes: DataFrame) -> DataFrame:
    """All pairs of different nodes of one (doc_id, canonical_path) whose validity overlaps, the lower node_id first.

    An equi-join on act and path with the overlap as residual; output is quadratic only in the number of overlapping
    versions of one provision, which is what is asked for.
    """
    picked = nodes.select("node_id", "doc_id", "version_id", "canonical_path", "valid_from", "valid_to", "is_current_law")
    a, b = picked.alias("a"), picked.alias("b")
    c = lambda n: F.col(n)
    same = (c("a.doc_id") == c("b.doc_id")) & (c("a.canonical_path") == c("b.canonical_path")) & (c("a.node_id") < c("b.node_id"))
    pairs = a.join(b, same & overlaps(c("a.valid_from"), c("a.valid_to"), c("b.valid_from"), c("b.valid_to")))
    sides = [F.col(f"{s}.{n}").alias(f"{n}_{s}") for n in ("node_id", "version_id", "valid_from", "valid_to") for s in "ab"]
    return pairs.select("a.doc_id", "a.canonical_path", *sides, severity(c("a.is_current_law"), c("b.is_current_law"), c("a.valid_to"), c("b.valid_to")).alias("severity"))


def new_events(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Conflict events that are not held yet, status pending."""
    return pairs.withColumn("status", F.lit("pending")).join(held.select("node_id_a", "node_id_b").distinct(), ["node_id_a", "node_id_b"], "left_anti")


def ordered_pair(df: DataFrame, a: str, b: str, *rest: str) -> DataFrame:
    """Swap the columns x_a and x_b of a pair where the first id is the greater one."""
    swap = F.col(a) > F.col(b)
    names = [(a, b), *[(f"{x}_a", f"{x}_b") for x in rest]]
    return df.withColumns({k: v for x, y in names for k, v in ((x, F.when(swap, F.col(y)).otherwise(F.col(x))), (y, F.when(swap, F.col(x)).otherwise(F.col(y))))})
