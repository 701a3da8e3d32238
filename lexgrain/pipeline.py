"""The document pipeline over tables in a shared folder: ingest, parse, extract, resolve, conflicts, deltas, export.

Every write makes a new generation of a table; a reader takes the last one that is complete, so a job that dies
leaves the tables as they were.  Every step can be repeated and then adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexgrain import schemas
from lexgrain.functions import ids, text
from lexgrain.operators import citations, conflicts, deltas, lookups, upserts
from lexgrain.operators.incremental import Store
from lexgrain.sources import acts_xml, files

#: Tables that are no part of the relational schema.
OTHERS = {"raw_content": "sha256 string, content binary", "fts": "token string, node_id string"}
#: Generations that are kept; older ones are deleted after a write.
KEPT = 2


class Tables:
    """Parquet tables below a folder, each in generations: whole ones (g...) and rows added to the last one (a...)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self._store = spark, Store(spark, root)

    def _generations(self, name: str) -> list[str]:
        """Complete generations in order."""
        return sorted((g for g in self._store.names(name) if self._store.exists(f"{name}/{g}/_SUCCESS")), key=lambda g: int(g[1:]))

    def read(self, name: str) -> DataFrame:
        """The last whole generation and what was added to it."""
        found = self._generations(name)
        wholes = [k for k, g in enumerate(found) if g.startswith("g")]
        if not found:
            return self.spark.createDataFrame([], schemas.schema(name)) if name in schemas.TABLES else self.spark.createDataFrame([], OTHERS[name])
        return self.spark.read.parquet(*[f"{self._store.root}/{name}/{g}" for g in found[wholes[-1] if wholes else 0 :]])

    def _written(self, name: str, rows: DataFrame, kind: str) -> DataFrame:
        if name in schemas.TABLES:
            fields = [f.strip().split(" ") for f in schemas.schema(name).split(",")]
            rows = rows.select(*[F.col(n).cast(t).alias(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in fields])
        number = max((int(n[1:]) for n in self._store.names(name)), default=-1) + 1
        path = f"{self._store.root}/{name}/{kind}{number:08d}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def write(self, name: str, rows: DataFrame) -> int:
        """A new whole generation; returns its number of rows."""
        made = self._written(name, rows, "g").count()
        found = self._generations(name)
        wholes = [k for k, g in enumerate(found) if g.startswith("g")]
        for old in found[: wholes[-KEPT]] if len(wholes) > KEPT else []:
            self._store.delete(f"{name}/{old}")
        return made

    def append(self, name: str, rows: DataFrame) -> int:
        """Add rows without writing the others again; returns how many."""
        return self._written(name, rows, "a").count()

    def reset(self) -> None:
        """Empty all tables but the record of runs."""
        for name in reversed(schemas.tables()):
            if name != "ingestion_runs" and self._store.names(name):
                self.write(name, self.spark.createDataFrame([], schemas.schema(name)))


def _next(rows: DataFrame, column: str) -> int:
    return (rows.agg(F.max(column)).first()[0] or 0) + 1


def ingest(t: Tables, directory: str) -> DataFrame:
    """Record files and zip members whose content is new; returns the run's row."""
    held, runs = t.read("raw_files"), t.read("ingestion_runs")
    number = _next(runs, "run_id")
    started = t.spark.sql("select current_timestamp() t").first()["t"]
    found = files.with_members(files.scan(t.spark, directory)).withColumn("sha256", F.sha2("content", 256))
    records = files.raw_records(found).withColumn("discovered_at", F.lit(started))
    fresh = upserts.earliest(records, ["sha256"], "path").join(held.select("sha256"), "sha256", "left_anti")
    first = _next(held, "raw_id")
    named = upserts.numbered(fresh, "raw_id", "path").withColumn("raw_id", F.col("raw_id") + first - 1)
    content = found.select("sha256", "content").join(t.read("raw_content").select("sha256"), "sha256", "left_anti")
    t.append("raw_content", upserts.earliest(content, ["sha256"], "content"))
    t.append("raw_files", named.withColumn("error_text", F.lit(None).cast("string")).select(*held.columns))
    stats = files.run_stats(records).select(F.lit(number).cast("long").alias("run_id"), F.lit(started).alias("started_at"), F.current_timestamp().alias("finished_at"), F.lit("finished").alias("status"), F.lit(directory).alias("input_dir"), "files", "xml", "zip")
    t.append("ingestion_runs", stats.select(*runs.columns))
    return t.read("ingestion_runs").where(F.col("run_id") == number)


def parse(t: Tables, retry_errors: bool = False) -> dict[str, int]:
    """Parse new files into documents, document_versions and nodes (upserts by key)."""
    raw = t.read("raw_files")
    wanted = raw.where(F.col("status").isin(["new", "error"] if retry_errors else ["new"]) & ~F.lower("path").endswith(".zip"))
    listed = acts_xml.parsed(wanted.join(t.read("raw_content"), "sha256").select("raw_id", "content"), "raw_id").persist()
    good = listed.where("parse_error is null")
    now = F.current_timestamp()
    acts = good.select("raw_id", "doc.*").withColumn("doc_id", ids.text_sha(F.col("canonical_doc")))
    docs = acts.select("doc_id", "canonical_doc", "doc_type", F.col("number").alias("act_number"), F.col("year").alias("act_year"), "title", "urn", "authority", F.try_to_date("publication_date").alias("publication_date"), F.col("raw_id").alias("last_seen_raw_id"), now.alias("created_at"), now.alias("updated_at"))
    held_docs = t.read("documents")
    date = lambda c: F.try_to_date(F.nullif(F.trim(c), F.lit("")))
    flat = good.select("raw_id", F.explode("nodes").alias("n"))
    checksum = upserts.version_checksum(flat.select("raw_id", F.col("n.ordinal").alias("ordinal"), F.col("n.text_raw").alias("t")), ["raw_id"], ["ordinal"], "t")
    version = acts.select("raw_id", "doc_id", F.coalesce("version_tag", F.lit("v0")).alias("version_tag"), date("valid_from").alias("valid_from"), date("valid_to").alias("valid_to"), "source_url").join(checksum, "raw_id", "left")
    held_versions = t.read("document_versions")
    key = ["doc_id", "version_tag"]
    last = upserts.latest(version, key, "raw_id")
    unknown = last.join(held_versions.select(*key), key, "left_anti").select(*key, "raw_id")
    first = _next(held_versions, "version_id")
    known = upserts.numbered(unknown, "version_id", "raw_id").select(*key, (F.col("version_id") + first - 1).alias("version_id")).unionByName(held_versions.select(*key, "version_id"))
    fresh = last.join(known, key).withColumnRenamed("raw_id", "source_raw_id")
    nodes = (
        flat.join(fresh.select(F.col("source_raw_id").alias("raw_id"), "doc_id", "version_id", "valid_from", "valid_to", "source_url"), "raw_id").select("raw_id", "doc_id", "version_id", "valid_from", "valid_to", "source_url", "n.*")
        .withColumn("node_id", ids.node_id(F.col("doc_id"), F.col("version_id"), F.col("canonical_path"))).withColumn("is_current_law", conflicts.is_current(F.col("valid_to")))
        .withColumn("lang", F.lit("it")).withColumn("text_content", F.col("text_clean"))
    )
    held_nodes = t.read("nodes")
    first_of_path = upserts.earliest(nodes.select("version_id", "canonical_path", "ordinal", *[c for c in held_nodes.columns if c not in ("version_id", "canonical_path", "ordinal")]), ["version_id", "canonical_path"], "ordinal")
    kept = held_nodes.join(fresh.select("version_id").distinct(), "version_id", "left_anti")
    out = {"nodes": t.write("nodes", kept.unionByName(first_of_path.select(*held_nodes.columns)))}
    gone = held_nodes.join(fresh.select("version_id").distinct(), "version_id", "left_semi").select("node_id").join(t.read("nodes").select("node_id"), "node_id", "left_anti").distinct()
    references = t.read("references_extracted")
    if not references.join(gone.withColumnRenamed("node_id", "source_node_id"), "source_node_id", "left_semi").isEmpty():
        t.write("references_extracted", references.join(gone.withColumnRenamed("node_id", "source_node_id"), "source_node_id", "left_anti").select(*references.columns))
    out["document_versions"] = t.write("document_versions", upserts.upsert(held_versions, fresh.select(*held_versions.columns), key, [], "source_raw_id"))
    out["documents"] = t.write("documents", upserts.upsert(held_docs, docs.select(*held_docs.columns), ["doc_id"], ["created_at"], "last_seen_raw_id"))
    state = listed.select("raw_id", F.when(F.col("parse_error").isNull(), "parsed").otherwise("error").alias("_s"), F.col("parse_error").alias("_e"))
    marked = raw.join(state, "raw_id", "left").withColumn("error_text", F.when(F.col("_s").isNotNull(), F.col("_e")).otherwise(F.col("error_text"))).withColumn("status", F.coalesce("_s", "status"))
    t.write("raw_files", marked.select(*raw.columns))
    out["errors"] = t.read("raw_files").where("status = 'error'").count()
    listed.unpersist()
    return out


def extract_references(t: Tables) -> int:
    """Citations of all nodes that are not held yet; returns how many were added."""
    held = t.read("references_extracted")
    job = citations.extraction_job(t.read("nodes").select("node_id", "doc_id", "text_content"), t.read("documents"), held).persist()
    named = upserts.numbered(job, "ref_id", "source_node_id", "ordinal").withColumn("ref_id", F.col("ref_id") + _next(held, "ref_id") - 1)
    t.append("urn_resolution_log", citations.resolution_log(job))
    added = t.append("references_extracted", named.select(*held.columns))
    job.unpersist()
    return added


def resolve_references(t: Tables) -> int:
    return t.write("references_resolved", citations.merge_edges(t.read("references_resolved"), citations.resolution_job(t.read("references_extracted"), t.read("nodes"), t.read("documents"), normalize_fragment=True)))


def detect_conflicts(t: Tables) -> int:
    held = t.read("conflict_events")
    before = held.count()
    return before + t.append("conflict_events", conflicts.new_events(conflicts.conflict_pairs(t.read("nodes")), held).select(*held.columns))


def build_deltas(t: Tables) -> int:
    rows = t.read("nodes").withColumn("loaded_at", F.lit(0))
    return t.write("document_version_deltas", deltas.version_deltas(rows))


def build_fts(t: Tables) -> int:
    """Write the full-text index of the nodes; returns its number of entries."""
    return t.write("fts", lookups.build_index(t.read("nodes"), "node_id", "text_content"))


def search(t: Tables, q: str) -> DataFrame:
    """Nodes whose text has all words of q, from the index."""
    return t.read("nodes").join(lookups.search_index(t.read("fts"), "node_id", q), "node_id", "left_semi")


def backfill_hierarchy(t: Tables) -> int:
    return t.write("nodes", lookups.backfilled(t.read("nodes")))


def export(t: Tables, path: str) -> int:
    """Write the export records as JSON lines; returns their number."""
    docs = t.read("documents")
    act = docs.select("doc_id", "title", "canonical_doc", F.lit(True).alias("known"))
    joined = t.read("nodes").join(act, "doc_id", "left")
    rows = joined.select(
        F.col("node_id").alias("id"), text.source_name(F.col("title"), F.col("canonical_doc"), F.coalesce("known", F.lit(False))).alias("source"), F.coalesce("canonical_doc", F.lit("")).alias("source_id"),
        text.export_context(F.col("hierarchy_string")).alias("context"), F.col("text_content").alias("text"), F.coalesce("source_url", F.lit("")).alias("url"),
    )
    files.write_jsonl(rows, path)
    return rows.count()


def latest_versions(t: Tables) -> DataFrame:
    """The version of highest id of each document."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("version_id"))
    return t.read("document_versions").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
