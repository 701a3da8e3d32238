"""Deduplication and upserts as set operations; all by key with map-side combine, none by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that is greatest in `order` (nulls first); ties by all columns."""
    return _best(rows, keys, F.max, list(order))


def earliest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that is least in `order`; ties by all columns."""
    return _best(rows, keys, F.min, list(order))


def _best(rows: DataFrame, keys: list[str], pick, order: list[str]) -> DataFrame:  # noqa: ANN001
    rest = [c for c in dict.fromkeys([*order, *rows.columns]) if c not in keys]
    return rows.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_r")).select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`") for c in rows.columns])


def insert_absent(held: DataFrame, fresh: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Held rows and the first fresh row of each key that is not held."""
    return held.unionByName(earliest(fresh, keys, *order).join(held.select(*keys).distinct(), keys, "left_anti").select(*held.columns))


def upsert(held: DataFrame, fresh: DataFrame, keys: list[str], keep: list[str], *order: str) -> DataFrame:
    """Held rows overwritten by the latest fresh row of the key; columns of `keep` stay as held where they are."""
    new = latest(fresh, keys, *order)
    mark = F.lit(True)
    joined = held.withColumn("_held", mark).alias("h").join(new.withColumn("_new", mark).alias("n"), keys, "full_outer")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        old, fresh_ = F.col(f"h.`{c}`"), F.col(f"n.`{c}`")
        taken = F.col("_new").isNotNull() if c not in keep else F.col("_held").isNull()
        return F.when(taken, fresh_).otherwise(old).alias(c)

    return joined.select(*[value(c) for c in held.columns])


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows with consecutive ids in a global order, without collecting rows into one task.

    Rows are range-partitioned and counted per partition; the counts (one row per partition) give the offsets.
    """
    from lexgrain.plans.scale import cut_lineage

    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    counts = sorted((r["_p"], r["n"]) for r in placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    base, offsets = 0, []
    for p, n in counts:
        offsets.append((p, base))
        base += n
    starts = F.create_map(*[F.lit(x) for pair in offsets for x in pair]) if offsets else F.create_map()
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_p", "_i")
    return placed.withColumn(name, (F.element_at(starts, F.col("_p")) + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")).drop("_p", "_i")


def version_checksum(nodes: DataFrame, keys: list[str], ordinal: list[str], text: str) -> DataFrame:
    """sha256 of the texts of each group joined by LF in order.

    A version's digest needs its texts in one place; a version is one act's text, so the group is bounded by an act.
    """
    parts = F.array_sort(F.collect_list(F.struct(*ordinal, F.coalesce(text, F.lit("")).alias("_t"))))
    return nodes.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(parts, lambda p: p["_t"]), "\n"), 256).alias("checksum_text"))
