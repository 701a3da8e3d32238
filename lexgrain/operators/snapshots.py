"""What changed between consecutive full snapshots, by Merkle trees over hash ranges of the keys.

Every snapshot's keys fall into ranges of a hash.  Roots of neighbouring snapshots are compared first; only
for pairs whose roots differ are the digests of the ranges built (their number follows the size of the pair,
so that a range holds about LEAF_ROWS rows), and rows are compared only in ranges whose digests differ.
Digests are sums and exclusive ors of row hashes, so both sides of a range cancel out when they are equal.

A hot entity is harmless: rows are grouped by (snapshot, key) and ranges by (pair, range); only the list of an
entity's snapshots, one small row each, goes through a window.

Defined results: rows without snapshot or key do not count; of repeated deliveries of one (snapshot, key) the
one loaded last counts (nulls first, ties by digest); texts are compared without white space, composed
letters equal decomposed ones, null equals blank; a first snapshot and an empty table yield nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Rows a leaf of a tree holds on average, and bits of the key hash by which a node splits.
LEAF_ROWS, STEP_BITS = 8, 4
#: Deepest level: 16 ** 6 leaves.
MAX_LEVEL = 6


@F.pandas_udf(LongType())
def text_digest(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """64-bit digest of a text without white space in composed form; null and blank give 0."""

    def one(s: str | None) -> int:
        if s is None or not (s := "".join(s.split())):
            return 0
        if not s.isascii() and not unicodedata.is_normalized("NFC", s):
            s = unicodedata.normalize("NFC", s)
        return xxhash.xxh3_64_intdigest(s) - 2**63 or 1

    for batch in texts:
        yield pd.Series([one(s) for s in batch], dtype="int64")


#: Columns that stand for the entity: 128 bits of hashes of its id.  Ids are long strings that no result shows.
ENTITY = ["entity_a", "entity_b"]


def keyed_digests(rows: DataFrame) -> DataFrame:
    """ENTITY, version_id, canonical_path, digest: the row that counts for every (snapshot, key).

    Texts become digests and ids hashes before the shuffle, so it moves 8 bytes a text and 16 an id.
    """
    listed = rows.where(F.col("version_id").isNotNull() & F.col("canonical_path").isNotNull()).select("doc_id", "version_id", "canonical_path", "loaded_at", "text_content")
    named = listed.withColumns(dict(zip(ENTITY, (F.xxhash64("doc_id"), F.xxhash64(F.lit("second"), "doc_id")), strict=True)))
    picked = named.select(*ENTITY, "version_id", "canonical_path", "loaded_at", text_digest("text_content").alias("digest"))
    last = picked.groupBy(*ENTITY, "version_id", "canonical_path")
    return last.agg(F.max(F.struct("loaded_at", "digest"))["digest"].alias("digest"))


def _leaf(depth: Column) -> Column:
    """Number of the hash range of a key: the top depth * STEP_BITS bits of 24 bits of its hash."""
    bits = F.pmod(F.xxhash64("canonical_path"), F.lit(2 ** (STEP_BITS * MAX_LEVEL)))
    return F.floor(bits / F.pow(F.lit(2), F.lit(MAX_LEVEL) * STEP_BITS - depth * STEP_BITS)).cast("int")


def _digest(row_hash: Column, weight: Column | int = 1) -> list[Column]:
    """Digest of a set of rows: exclusive or, and a sum that tells what the exclusive or does not; both add up over subsets."""
    return [F.bit_xor(row_hash).alias("x"), F.sum(F.shiftrightunsigned(row_hash, 34) * weight).alias("s"), F.sum(F.lit(1) * weight).alias("n")]


def _pairs(keyed: DataFrame) -> DataFrame:
    """ENTITY, version_id, pair, side, depth: the two sides of every pair of neighbours whose root digests differ.

    pair is the newer snapshot; side is 1 for it and -1 for the older one.
    """
    roots = keyed.groupBy(*ENTITY, "version_id").agg(*_digest(F.xxhash64("canonical_path", "digest")))
    order = Window.partitionBy(*ENTITY).orderBy("version_id")
    digest = F.struct("x", "s", "n")
    depth = F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.ceil(F.log2(F.greatest(F.col("n"), F.col("older_n")) / LEAF_ROWS) / STEP_BITS)))
    beside = roots.select("*", F.lag("version_id").over(order).alias("older"), F.lag(digest).over(order).alias("older_digest"), F.lag("n").over(order).alias("older_n"))
    differ = beside.where(F.col("older").isNotNull() & (digest != F.col("older_digest"))).withColumn("depth", depth.cast("int"))
    side = lambda version, sign: F.struct(F.col(version).alias("version_id"), F.col("version_id").alias("pair"), F.lit(sign).alias("side"), F.col("depth").alias("depth"))
    return differ.select(*ENTITY, F.explode(F.array(side("version_id", 1), side("older", -1))).alias("p")).select(*ENTITY, "p.*")


def changes(rows: DataFrame) -> DataFrame:
    """version_id, canonical_path, change_kind (added, removed, changed) between neighbouring snapshots of a doc_id."""
    keyed = keyed_digests(rows)
    sides = keyed.join(_pairs(keyed), [*ENTITY, "version_id"]).select(*ENTITY, "pair", "side", "canonical_path", "digest", _leaf(F.col("depth")).alias("leaf"))
    leaves = sides.groupBy(*ENTITY, "pair", "leaf").agg(*_digest(F.xxhash64("canonical_path", "digest"), F.col("side")))
    differ = leaves.where((F.col("x") != 0) | (F.col("s") != 0) | (F.col("n") != 0)).select(*ENTITY, "pair", "leaf")
    inside = sides.join(differ, [*ENTITY, "pair", "leaf"], "left_semi")
    both = inside.groupBy(*ENTITY, "pair", "leaf", "canonical_path").agg(
        F.max(F.when(F.col("side") == 1, F.col("digest"))).alias("new"), F.max(F.when(F.col("side") == -1, F.col("digest"))).alias("old")
    )
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.select(F.col("pair").alias("version_id"), "canonical_path", kind.alias("change_kind")).where(F.col("change_kind").isNotNull())
