"""Queries of the document store: health, acts, versions, trees, nodes, search, quality, export."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.functions import text
from lexgrain.operators.upserts import latest

HOUR = 3600


def last_finished(runs: DataFrame) -> DataFrame:
    """The finished run that ended last (unknown ends first)."""
    done = runs.where(F.col("status") == "finished")
    return done.orderBy(F.col("finished_at").desc_nulls_first(), F.col("run_id").desc()).limit(1)


def error_rate(files: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """error_rate of the files found in the hours before `as_of`; 0 if there are none."""
    recent = files.where(F.col("discovered_at") >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {hours} HOURS"))
    return recent.agg(F.coalesce(F.try_divide(F.count_if(F.col("status") == "error"), F.count(F.lit(1))), F.lit(0.0)).alias("error_rate"))


def health(runs: DataFrame, files: DataFrame, as_of: str) -> DataFrame:
    """One row: status, last_run, pending, error_rate."""
    recent = F.col("discovered_at") >= F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS")
    counts = files.agg(F.count_if(F.col("status") == "new").alias("pending"), F.coalesce(F.try_divide(F.count_if((F.col("status") == "error") & recent), F.count_if(recent)), F.lit(0.0)).alias("error_rate"))
    done = runs.where(F.col("status") == "finished").agg(F.max_by("run_id", F.struct(F.col("finished_at").isNull(), "finished_at", "run_id")).alias("last_run"))
    both = counts.select(F.lit(1).alias("k"), "*").join(done.select(F.lit(1).alias("k"), "*"), "k")
    return both.select(F.lit("ok").alias("status"), "last_run", "pending", "error_rate")


def acts_query(acts: DataFrame, doc_type: str | None = None, year: int | None = None, number: int | None = None) -> DataFrame:
    """Acts with the given values; an empty value is no condition."""
    out = acts
    for column, value in (("doc_type", doc_type), ("act_year", year), ("act_number", number)):
        if value:
            out = out.where(F.col(column) == value)
    return out.select("canonical_doc", "doc_type", "act_number", "act_year", "title", "publication_date")


def with_versions(acts: DataFrame, versions: DataFrame) -> DataFrame:
    """Acts with the array of their versions, ordered by version_id."""
    listed = versions.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("version_id", "version_tag", "valid_from", "valid_to"))).alias("versions"))
    return acts.join(listed, "doc_id", "left")


def tree(acts: DataFrame, versions: DataFrame, nodes: DataFrame, canonical_doc: str, version_tag: str | None = None) -> DataFrame:
    """Nodes of one version of an act in the order of their sort key; the latest version_id without a tag."""
    act = acts.where(F.col("canonical_doc") == canonical_doc).select("doc_id").distinct()
    mine = versions.join(act, "doc_id", "left_semi")
    if version_tag:
        mine = mine.where(F.col("version_tag") == version_tag)
    one = mine.agg(F.max("version_id").alias("version_id"))
    return nodes.join(one, "version_id", "left_semi").withColumn("sort_key", F.translate("canonical_path", "/", "_")).orderBy("sort_key", "node_id")


def node_with_references(nodes: DataFrame, references: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Nodes with the arrays of their extracted and, if given, resolved references (sets of small structs of one node)."""
    listed = references.groupBy(F.col("source_node_id").alias("node_id")).agg(F.array_sort(F.collect_set(F.struct("ref_id", "destination_urn", "relation_type"))).alias("refs"))
    found = nodes.join(listed, "node_id", "left")
    if resolved is None:
        return found
    edges = resolved.groupBy(F.col("source_node_id").alias("node_id")).agg(F.array_sort(F.collect_set(F.struct("target_canonical_node", "relation_type", "target_node_id", "confidence"))).alias("resolved"))
    return found.join(edges, "node_id", "left")


def search_like(rows: DataFrame, text_col: str, q: str) -> DataFrame:
    """Rows whose text holds q, case-insensitively; % and _ are wildcards."""
    return rows.where(F.col(text_col).ilike(f"%{q}%"))


def tokens(c: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\W+"), lambda t: t != ""))


def build_index(rows: DataFrame, key: str, text_col: str) -> DataFrame:
    """Token table of a full-text index: token, key, in order of the tokens.

    Written as it is, every file and row group holds a range of tokens, so a search reads few of them.  The ranges are
    cut by token and key, so a word that all texts have is spread over many.
    """
    listed = rows.select(F.explode(tokens(F.col(text_col))).alias("token"), key).distinct()
    return listed.repartitionByRange("token", key).sortWithinPartitions("token", key)


def search_index(index: DataFrame, key: str, q: str) -> DataFrame:
    """Keys whose text has all words of q; no word, no key.  The words are sought by the scan."""
    wanted = sorted(set(re.findall(r"\w+", q.lower())))
    if not wanted:
        return index.select(key).limit(0)
    hits = index.where(F.col("token").isin(wanted)).groupBy(key).agg(F.count_distinct("token").alias("n"))
    return hits.where(F.col("n") == len(wanted)).select(key)


def quality(nodes: DataFrame, text_col: str = "text_content", limit: int | None = None) -> DataFrame:
    """node_type, n_nodes, n_empty; `limit` takes a prefix as the stats command does, off by default."""
    rows = nodes if limit is None else nodes.limit(limit)
    return rows.groupBy("node_type").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(text.is_empty(F.col(text_col))).alias("n_empty"))


def export_rows(nodes: DataFrame, acts: DataFrame) -> DataFrame:
    """id, source, source_id, context, text, url of nodes joined to their act (by its latest row)."""
    named = acts.where("doc_id is not null").select("doc_id", "title", "canonical_doc", "updated_at")
    act = latest(named, ["doc_id"], "updated_at").select("doc_id", "title", "canonical_doc", F.lit(True).alias("known"))
    joined = nodes.select("doc_id", "node_id", "canonical_path", "text_content").join(act, "doc_id", "left")
    name = text.source_name(F.col("title"), F.col("canonical_doc"), F.coalesce("known", F.lit(False)))
    return joined.select(
        F.col("node_id").alias("id"), name.alias("source"), F.coalesce("canonical_doc", F.lit("")).alias("source_id"), text.export_context(text.hierarchy(F.col("canonical_path"))).alias("context"),
        text.clean(F.col("text_content")).alias("text"), F.lit("").alias("url"),
    )


def preview(nodes: DataFrame, acts: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """A random sample of `count` nodes with more than 50 characters."""
    return export_rows(nodes.where(F.length("text_content") > 50), acts).select("id", "source", "context", F.left("text", F.lit(200)).alias("text")).orderBy(F.rand(seed)).limit(count)


def backfilled(nodes: DataFrame, column: str = "hierarchy_string") -> DataFrame:
    """Nodes whose missing hierarchy string is made from the path."""
    return nodes.withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), text.hierarchy(F.col("canonical_path"))))
