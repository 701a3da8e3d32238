"""Schemas of the store's tables (DDL), with the version they came in, and checks of their column lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = 3
TABLES = {
    "ingestion_runs": (1, "run_id long, started_at timestamp, finished_at timestamp, status string, input_dir string, files long, xml long, zip long"),
    "raw_files": (1, "raw_id long, path string, derived_from string, is_from_zip boolean, sha256 string, size_bytes long, mtime timestamp, discovered_at timestamp, status string, error_text string"),
    "documents": (1, "doc_id string, canonical_doc string, doc_type string, act_number int, act_year int, title string, urn string, authority string, publication_date date, last_seen_raw_id long, created_at timestamp, updated_at timestamp"),
    "document_versions": (1, "version_id long, doc_id string, version_tag string, valid_from date, valid_to date, source_raw_id long, checksum_text string"),
    "nodes": (
        1,
        "node_id string, doc_id string, version_id long, node_type string, label string, eid string, canonical_path string, sort_key string, hierarchy_string string, ordinal int, heading string, text_raw string, text_content string, "
        "text_hash string, level int, lang string, valid_from date, valid_to date, is_current_law boolean, source_url string, text_xml_fragment string",
    ),
    "references_extracted": (
        1,
        "ref_id long, source_node_id string, doc_id string, raw_snippet string, match_text string, relation_type string, target_canonical_doc string, target_article string, target_comma string, target_letter string, "
        "target_number string, target_canonical_node string, confidence double, method string",
    ),
    "references_resolved": (1, "source_node_id string, target_canonical_node string, relation_type string, target_node_id string, confidence double"),
    "urn_resolution_log": (1, "original_text string, resolved_urn string, confidence_score double, resolution_method string, document_id string"),
    "conflict_events": (2, "node_id_a string, node_id_b string, doc_id string, canonical_path string, version_id_a long, version_id_b long, valid_from_a date, valid_from_b date, valid_to_a date, valid_to_b date, severity string, status string"),
    "document_version_deltas": (3, "doc_id string, canonical_path string, version_id long, base_version_id long, delta_text string, compression_ratio double"),
}
#: Longest values that a relational store of these tables takes.
LENGTHS = {"canonical_doc": 128, "doc_type": 32, "version_tag": 128, "node_type": 32, "label": 128, "canonical_path": 256, "sort_key": 256, "relation_type": 32, "method": 64}


def schema(table: str) -> str:
    return TABLES[table][1]


def tables(version: int = VERSION) -> list[str]:
    """Tables that exist at a schema version."""
    return [t for t, (since, _) in TABLES.items() if since <= version]


def too_long(rows: DataFrame) -> DataFrame:
    """column_name, n_rows of values longer than LENGTHS: a data quality check, not a limit."""
    checked = [c for c in rows.columns if c in LENGTHS]
    if not checked:
        return rows.sparkSession.createDataFrame([], "column_name string, n_rows long")
    counts = rows.agg(*[F.count_if(F.length(c) > LENGTHS[c]).alias(c) for c in checked])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in checked])).alias("x")).select("x.*")
