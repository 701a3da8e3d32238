"""The pN_ queries of the core (problems 1 to 5 and 7), and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.operators import history, incremental, intervals, nested, references, snapshots
from lexgrain.plans.scale import read, shared_dir


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.links(read(spark, d, "parsed_acts"))


def p1_nodes(spark: SparkSession, d: str) -> DataFrame:
    flat = nested.flat_nodes(read(spark, d, "parsed_acts")).distinct()
    return flat.select("parse_id", "node_pos", "eid", "canonical_path", "level", F.length("text_content").alias("n_chars"), F.length("text_xml_fragment").alias("n_xml"))


def p1_refs(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_refs(read(spark, d, "parsed_acts")).distinct()


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_records(read(spark, d, "parsed_acts"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = history.periods(read(spark, d, "document_versions"))
    return found.select("doc_id", F.coalesce("state", F.lit("")).alias("checksum_text"), history.day(F.col("valid_from")).alias("valid_from"), history.day(F.col("valid_to")).alias("valid_to"))


def p2_current(spark: SparkSession, d: str) -> DataFrame:
    found = history.periods(read(spark, d, "document_versions")).where("is_current")
    return found.select("doc_id", F.col("state").alias("checksum_text"), history.day(F.col("valid_from")).alias("valid_from"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.changes(read(spark, d, "nodes"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.feed_runs(read(spark, d, "raw_files"), read(spark, d, "ingestion_runs"), f"{shared_dir(spark)}/feed-{uuid.uuid4().hex}")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = intervals.periods_and_gaps(read(spark, d, "document_versions"))
    return found.select("doc_id", "span_kind", history.day(F.col("start_date")).alias("start_date"), history.day(F.col("end_date")).alias("end_date"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = references.orphans(read(spark, d, "references_extracted"), read(spark, d, "nodes"), read(spark, d, "acts"))
    return found.select("ref_id", "ref_field", "cause").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(read(spark, d, "references_extracted"), read(spark, d, "nodes"), read(spark, d, "acts"))


QUERIES = {q.__name__: q for q in (p1_found, p1_nodes, p1_refs, p1_records, p2_found, p2_current, p3_found, p4_found, p5_found, p7_found, p7_report)}

_P2 = """
WITH one AS (
  SELECT doc_id, valid_from, valid_to, checksum_text AS state FROM document_versions
  WHERE doc_id IS NOT NULL AND valid_from IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY doc_id, valid_from ORDER BY loaded_at DESC NULLS LAST, version_id DESC NULLS LAST, valid_to DESC NULLS LAST, checksum_text DESC NULLS LAST) = 1),
marked AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(state) OVER w IS NOT DISTINCT FROM state THEN 0 ELSE 1 END AS chg FROM one WINDOW w AS (PARTITION BY doc_id ORDER BY valid_from)),
isl AS (SELECT *, sum(chg) OVER (PARTITION BY doc_id ORDER BY valid_from) AS g FROM marked),
per AS (SELECT doc_id, g, any_value(state) AS state, min(valid_from) AS s, arg_max(coalesce(valid_to, DATE '9999-12-31'), valid_from) AS said FROM isl GROUP BY doc_id, g),
nxt AS (SELECT *, lead(s) OVER (PARTITION BY doc_id ORDER BY g) AS nx FROM per)
"""
_P7 = """
WITH par AS (SELECT node_id, min(loaded_at) AS fl FROM nodes WHERE node_id IS NOT NULL GROUP BY node_id),
src AS (SELECT r.ref_id, r.created_at, 'source_node_id' AS ref_field, CASE WHEN p.node_id IS NULL THEN 'missing' WHEN p.fl > r.created_at THEN 'late' END AS cause
  FROM references_extracted r LEFT JOIN par p ON p.node_id = r.source_node_id),
lat AS (SELECT * FROM acts WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC) = 1),
nam AS (SELECT lower(trim(n)) AS k, bool_and(deleted_at IS NOT NULL) AS gone, min(created_at) AS born FROM (SELECT urn AS n, deleted_at, created_at FROM lat UNION ALL SELECT akn_uri, deleted_at, created_at FROM lat) GROUP BY 1),
dst0 AS (SELECT ref_id, created_at, regexp_replace(destination_urn, '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') AS u FROM references_extracted),
dst1 AS (SELECT DISTINCT ref_id, created_at, regexp_replace(lower(u), '(#|~|@|/ita|/!main).*$', '') AS k FROM dst0 WHERE u <> ''),
dst AS (SELECT d.ref_id, d.created_at, 'destination_urn' AS ref_field, CASE WHEN n.k IS NULL THEN 'missing' WHEN n.gone THEN 'deleted' WHEN n.born > d.created_at THEN 'late' END AS cause
  FROM dst1 d LEFT JOIN nam n ON n.k = d.k),
bad AS (SELECT DISTINCT * FROM (SELECT * FROM src UNION ALL SELECT * FROM dst) WHERE cause IS NOT NULL)
"""

_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
# Enclosing nodes by comparing all pairs of a record whose paths allow it: whole fragments that hold one another, else texts.
_P1 = rf"""
WITH rec AS (SELECT row_number() OVER () AS rid, * FROM (SELECT DISTINCT parse_id, nodes FROM parsed_acts)),
node AS (SELECT rid, parse_id, CAST(i - 1 AS INTEGER) AS pos, nodes[i].canonical_path AS p, regexp_replace(coalesce(nodes[i].text_content, ''), '{_WS}', '', 'g') AS t, coalesce(nodes[i].text_xml_fragment, '') AS f, nodes[i].refs AS refs
  FROM (SELECT rid, parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM rec)),
kept AS (SELECT *, count(*) OVER (PARTITION BY rid, p) AS times, regexp_extract(f, '^\s*<(\w+)', 1) <> '' AND regexp_extract(f, '^\s*<(\w+)', 1) = regexp_extract(f, '</(\w+)>\s*$', 1)
  AND len(regexp_extract_all(f, '<[a-zA-Z]')) = len(regexp_extract_all(f, '</')) + len(regexp_extract_all(f, '/>')) AS whole FROM node),
ord AS (SELECT rid, max(times) FILTER (p <> '') > 1 AS ordered FROM kept GROUP BY rid),
near AS (SELECT c.rid, c.pos, a.p AS ap, CASE WHEN o.ordered THEN max(a.pos) ELSE min(a.pos) END AS apos FROM kept c JOIN ord o USING (rid) JOIN kept a ON a.rid = c.rid AND a.p <> '' AND starts_with(c.p, a.p || '/') AND (NOT coalesce(o.ordered, false) OR a.pos < c.pos) GROUP BY c.rid, c.pos, a.p, o.ordered),
enc AS (SELECT n.rid, n.pos, arg_max(n.apos, length(n.ap)) AS parent FROM near n JOIN kept c ON c.rid = n.rid AND c.pos = n.pos JOIN kept a ON a.rid = n.rid AND a.pos = n.apos
  WHERE CASE WHEN c.whole AND a.whole THEN contains(a.f, trim(c.f)) ELSE a.t = '' OR contains(a.t, c.t) END GROUP BY n.rid, n.pos)
SELECT DISTINCT c.parse_id, 'node' AS child_kind, c.pos AS child_pos, CAST(coalesce(e.parent, -1) AS INTEGER) AS parent_pos FROM kept c LEFT JOIN enc e ON e.rid = c.rid AND e.pos = c.pos
UNION SELECT DISTINCT parse_id, 'ref', CAST(j - 1 AS INTEGER), pos FROM (SELECT parse_id, pos, refs, unnest(range(1, len(refs) + 1)) AS j FROM kept) WHERE coalesce(refs[j].href, '') <> '' OR coalesce(refs[j]."text", '') <> ''"""

ORACLES = {
    "p1_found": _P1,
    "p1_nodes": """SELECT DISTINCT parse_id, CAST(i - 1 AS INTEGER) AS node_pos, nodes[i].eid AS eid, nodes[i].canonical_path AS canonical_path, nodes[i].level AS level,
        CAST(length(nodes[i].text_content) AS INTEGER) AS n_chars, CAST(length(nodes[i].text_xml_fragment) AS INTEGER) AS n_xml
        FROM (SELECT parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM parsed_acts)""",
    "p1_refs": """SELECT DISTINCT parse_id, CAST(i - 1 AS INTEGER) AS node_pos, CAST(j - 1 AS INTEGER) AS ref_pos, refs[j].href AS href, refs[j]."text" AS "text"
        FROM (SELECT parse_id, i, nodes[i].refs AS refs, unnest(range(1, len(nodes[i].refs) + 1)) AS j FROM (SELECT parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM parsed_acts))
        WHERE coalesce(refs[j].href, '') <> '' OR coalesce(refs[j]."text", '') <> ''""",
    "p1_records": "SELECT DISTINCT parse_id, raw_id, urn, work_urn, expression_urn, manifestation_urn, publication_date, version_date FROM parsed_acts",
    "p2_found": _P2
    + """SELECT doc_id, coalesce(state, '') AS checksum_text, strftime(s, '%Y-%m-%d') AS valid_from,
        CASE WHEN nx IS NOT NULL THEN strftime(nx - 1, '%Y-%m-%d') WHEN said = DATE '9999-12-31' THEN '' ELSE strftime(said, '%Y-%m-%d') END AS valid_to FROM nxt""",
    "p2_current": _P2 + "SELECT doc_id, state AS checksum_text, strftime(s, '%Y-%m-%d') AS valid_from FROM nxt WHERE nx IS NULL",
    "p3_found": """
WITH r AS (SELECT doc_id, version_id, canonical_path, regexp_replace(nfc_normalize(coalesce(text_content, '')), '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', '', 'g') AS t FROM nodes
  QUALIFY row_number() OVER (PARTITION BY doc_id, version_id, canonical_path ORDER BY loaded_at DESC) = 1),
v AS (SELECT doc_id, version_id, lag(version_id) OVER (PARTITION BY doc_id ORDER BY version_id) AS older FROM (SELECT DISTINCT doc_id, version_id FROM r)),
n AS (SELECT r.*, v.older FROM r JOIN v USING (doc_id, version_id) WHERE v.older IS NOT NULL),
o AS (SELECT r.doc_id, v.version_id, r.canonical_path, r.t FROM r JOIN v ON r.doc_id = v.doc_id AND r.version_id = v.older)
SELECT version_id, canonical_path, kind AS change_kind FROM (
  SELECT coalesce(n.version_id, o.version_id) AS version_id, coalesce(n.canonical_path, o.canonical_path) AS canonical_path,
    CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' WHEN n.t <> o.t THEN 'changed' END AS kind
  FROM n FULL JOIN o ON n.doc_id = o.doc_id AND n.version_id = o.version_id AND n.canonical_path = o.canonical_path) WHERE kind IS NOT NULL""",
    "p4_found": """
WITH fin AS (SELECT run_id, min(started_at) AS s FROM ingestion_runs GROUP BY run_id HAVING bool_or(status = 'finished')),
pl AS (SELECT run_id, s, lag(s) OVER (ORDER BY s, run_id) AS p FROM fin UNION ALL SELECT 0, NULL, max(s) FROM fin),
de AS (SELECT DISTINCT raw_id, arrived_at, sha256 FROM raw_files WHERE status = 'new'),
nw AS (SELECT d.raw_id, pl.run_id, pl.s, arg_max(d.sha256, d.arrived_at) AS h FROM de d JOIN pl ON (pl.p IS NULL OR d.arrived_at >= pl.p) AND (pl.s IS NULL OR d.arrived_at < pl.s) GROUP BY ALL),
lg AS (SELECT *, lag(h) OVER (PARTITION BY raw_id ORDER BY s NULLS LAST) AS b FROM nw)
SELECT run_id, raw_id FROM lg WHERE b IS NULL OR b <> h""",
    "p5_found": """
WITH c AS (SELECT doc_id, coalesce(valid_from, DATE '0001-01-01') AS s, coalesce(valid_to, DATE '9999-12-31') AS e FROM document_versions WHERE doc_id IS NOT NULL),
m AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM c WHERE s <= e),
g AS (SELECT *, sum(CASE WHEN r IS NULL OR s - r > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m),
p AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM g GROUP BY doc_id, i),
a AS (SELECT doc_id, 'period' AS span_kind, s, e FROM p UNION ALL SELECT doc_id, 'gap', e + 1, n - 1 FROM (SELECT doc_id, e, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM p) WHERE n IS NOT NULL)
SELECT doc_id, span_kind, CASE WHEN s = DATE '0001-01-01' THEN '' ELSE strftime(s, '%Y-%m-%d') END AS start_date, CASE WHEN e = DATE '9999-12-31' THEN '' ELSE strftime(e, '%Y-%m-%d') END AS end_date FROM a""",
    "p7_found": _P7 + "SELECT DISTINCT ref_id, ref_field, cause FROM bad",
    "p7_report": _P7
    + """SELECT CASE WHEN ref_field = 'source_node_id' THEN 'nodes' ELSE 'acts' END AS table_name, coalesce(strftime(created_at, '%Y-%m'), '') AS "month", cause, count(DISTINCT ref_id) AS n_refs FROM bad GROUP BY 1, 2, 3""",
}
