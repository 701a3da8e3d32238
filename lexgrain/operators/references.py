"""Orphan references: keys that name nothing, something deleted, or something that came later.

References and parent keys are co-partitioned and sorted by key and merged (sort-merge join); the parents'
first appearance and deletion decide the cause.  Parents are reduced to one row a key with map-side combine
before the merge, and hot keys of the references are spread over salts.

Defined results: a null or unknown source id is missing (compared as it stands); a null or blank destination is
no case; a reference without created_at is never late; repeated rows count once; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.plans.scale import salted_left_join

#: What may follow an act's name in a destination.
TAIL = r"#|~|@|/ita|/!main"


def plain(name: Column) -> Column:
    """Lower-case name without white space (of any kind) at its ends."""
    return F.lower(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""))


def _candidates(destination: Column) -> Column:
    """The plain destination and its parts before each tail mark."""
    whole = plain(destination)
    pieces = F.split(whole, rf"(?={TAIL})")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda n: F.array_join(F.slice(pieces, F.lit(1), n), ""))
    return F.array_distinct(F.filter(prefixes, lambda p: p != ""))


def orphan_sources(references: DataFrame, nodes: DataFrame) -> DataFrame:
    """ref_id, ref_field, cause, created_at of references whose source_node_id names no node, or none yet."""
    refs = references.select("ref_id", F.col("source_node_id").alias("key"), "created_at")
    parents = nodes.where(F.col("node_id").isNotNull()).groupBy(F.col("node_id").alias("key")).agg(F.lit(True).alias("there"), F.min("loaded_at").alias("first_loaded"))
    merged = salted_left_join(refs, parents, "key", F.col("ref_id"))
    cause = F.when(F.col("there").isNull(), "missing").when(F.col("first_loaded") > F.col("created_at"), "late")
    return merged.select("ref_id", F.lit("source_node_id").alias("ref_field"), cause.alias("cause"), "created_at").where("cause is not null")


def act_keys(acts: DataFrame) -> DataFrame:
    """key, gone, born: the names of every act by its latest row; a name shared by acts counts as its best one."""
    state = F.struct("updated_at", "created_at", "deleted_at", "urn", "akn_uri")
    latest = acts.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(state).alias("a")).select("a.*")
    names = latest.select(F.explode(F.array("urn", "akn_uri")).alias("name"), "created_at", "deleted_at").select(plain(F.col("name")).alias("key"), "created_at", "deleted_at")
    best = names.where(F.col("key") != "").groupBy("key")
    return best.agg(F.min(F.col("deleted_at").isNotNull()).alias("gone"), F.min("created_at").alias("born"))


def orphan_destinations(references: DataFrame, acts: DataFrame) -> DataFrame:
    """ref_id, ref_field, cause, created_at of references whose destination_urn names no living act, or none yet.

    A destination is looked up as a whole and cut before each mark of TAIL; the longest name found counts.
    """
    refs = references.where(plain(F.col("destination_urn")) != "").select("ref_id", "destination_urn", "created_at")
    looked = refs.select("*", F.explode(_candidates(F.col("destination_urn"))).alias("key"))
    merged = salted_left_join(looked, act_keys(acts), "key", F.col("ref_id"))
    found = F.when(F.col("gone").isNotNull(), F.struct(F.length("key").alias("n"), F.col("gone").alias("gone"), F.col("born").alias("born")))
    best = merged.groupBy("ref_id", "destination_urn", "created_at").agg(F.max(found).alias("act"))
    cause = F.when(F.col("act").isNull(), "missing").when(F.col("act.gone"), "deleted").when(F.col("act.born") > F.col("created_at"), "late")
    return best.select("ref_id", F.lit("destination_urn").alias("ref_field"), cause.alias("cause"), "created_at").where("cause is not null")


def orphans(references: DataFrame, nodes: DataFrame, acts: DataFrame) -> DataFrame:
    """ref_id, ref_field, cause, created_at of all orphan references."""
    return orphan_sources(references, nodes).unionByName(orphan_destinations(references, acts)).distinct()


def orphan_report(references: DataFrame, nodes: DataFrame, acts: DataFrame) -> DataFrame:
    """Orphans per referenced table and month: table_name, month (yyyy-MM, '' if unknown), cause, n_refs."""
    table = F.when(F.col("ref_field") == "source_node_id", "nodes").otherwise("acts")
    month = F.coalesce(F.date_format("created_at", "yyyy-MM"), F.lit(""))
    found = orphans(references, nodes, acts)
    return found.groupBy(table.alias("table_name"), month.alias("month"), "cause").agg(F.count_distinct("ref_id").alias("n_refs"))
