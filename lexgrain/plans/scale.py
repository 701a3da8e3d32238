"""Helpers that keep plans sound on a large cluster: lineage cuts, bounded control data, hot keys.

Nothing here drops rows.  Hot keys are spread over salts, control data is taken to the driver
only under an explicit bound, and a caller gets None beyond it so that it can take another way.
"""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: A key with at least this share of the rows is hot; at most 1 / HOT_SHARE keys can be.
HOT_SHARE = 0.02
#: Below so many rows a key is never worth salting: one task sorts them at once.
HOT_LEAST = 200_000
#: Splits of fewer bytes are taken for parts of a row group.
SPLIT_BYTES = 2**20
#: Parts into which a hot key is split.
SALTS = 32


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the given directory."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that their Python finds it wherever it was started.

    The archive is made on the driver, from where Spark serves it to every executor, late ones included.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lexgrain_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="lexgrain-package-")
    archive = Path(folder, f"lexgrain-{Path(folder).name[-8:]}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    sc.addPyFile(str(archive))
    sc._lexgrain_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset a folder of this machine serves only while everything runs in this one process (tests); on a
    cluster its executors could not read each other's files there, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_lexgrain_shared", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = spark._lexgrain_shared = tempfile.mkdtemp(prefix="lexgrain-")
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder, so that a lost executor loses nothing."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows over all cores, for work that costs far more than moving them.

    An input with fewer splits than there are cores, or so small that its splits are parts of a few row groups and mostly
    empty, would leave cores idle, so it is shuffled by a hash of keys that are distinct or nearly so; any other one is
    left where it lies.  The rows are the same either way; no job runs to find out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    bytes_ = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if bytes_ >= cores * SPLIT_BYTES and df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores * 2, F.xxhash64(*keys))


def take_bounded(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows if there are at most `limit`, else None.  For control tables, never for data."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def hot_values(df: DataFrame, key: str, share: float = HOT_SHARE, least: int = HOT_LEAST) -> list:
    """Values of `key` that hold at least `share` of the rows (and `least` rows): at most 1 / share of them.

    Counts over all rows with map-side combine; null is never hot since it joins nothing.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    if not top or top[0]["_n"] < least:
        return []
    total = df.count()
    return [r[key] for r in top if r["_n"] >= max(least, share * total)]


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column, share: float = HOT_SHARE, least: int = HOT_LEAST, salts: int = SALTS
) -> DataFrame:
    """left ⟕ right on `key`, as a sort-merge join, with hot keys of the left side spread over `salts` parts.

    Right rows of hot keys are repeated once per salt; left rows without key match nothing and are not shuffled; `spread_by` is any expression of the left row that
    tells rows of one key apart.  The right side must not have columns of the left one but the key.
    """
    known = left.where(F.col(key).isNotNull())
    hot = hot_values(known, key, share, least)
    if hot:
        is_hot = F.col(key).isin(hot)
        salted = known.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0)).cast("long"))
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
        repeated = right.withColumn("_salt", F.explode(copies))
        joined = salted.join(repeated.hint("merge"), [key, "_salt"], "left").drop("_salt")
    else:
        joined = known.join(right.hint("merge"), key, "left")
    return joined.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)
