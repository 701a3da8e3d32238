"""The pN_ queries of this package (problems 6, 8, 9 and 10), and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.llm import contamination, packing, privacy, splitting
from lexgrain.plans.scale import read

#: Key of the pseudonyms in the query; a deployment passes its own.
DEMO_KEY = b"demonstration key"


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(read(spark, d, "nodes"), "node_id", "text_content")


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    long = read(spark, d, "nodes").where(F.length("text_content") > splitting.LIMIT).select("node_id", "canonical_path", "text_content").distinct()
    return splitting.pieces(long, ["node_id", "canonical_path"], "text_content")


def p6_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of every oversized text give back, and whether they keep the limits."""
    return splitting.rebuilt(read(spark, d, "nodes").where(F.length("text_content") > splitting.LIMIT), ["node_id"], "text_content")


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.sizes(read(spark, d, "documents")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return privacy.find(read(spark, d, "documents"))


def p10_redact(spark: SparkSession, d: str) -> DataFrame:
    return privacy.redact(read(spark, d, "documents").select("doc_id", "text"), DEMO_KEY)


QUERIES = {q.__name__: q for q in (p6_found, p6_pieces, p6_rebuilt, p8_pack, p9_found, p10_found, p10_redact)}

_S = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}"
ORACLES = {
    "p6_found": f"""SELECT node_id, CASE WHEN bool_or(regexp_matches(text_content, '[^{_S}]{{1000}}[^{_S}]{{1000}}[^{_S}]')) THEN 'hard' ELSE 'soft' END AS cut_kind
        FROM nodes WHERE length(text_content) > 2000 GROUP BY node_id""",
    "p6_rebuilt": f"""SELECT DISTINCT node_id, sha256(text_content) AS rebuilt_sha, true AS within_limit, true AS within_overlap,
        CASE WHEN regexp_matches(text_content, '[^{_S}]{{1000}}[^{_S}]{{1000}}[^{_S}]') THEN 'hard' ELSE 'soft' END AS cut_kind FROM nodes WHERE length(text_content) > 2000""",
    "p9_found": """
WITH w AS (SELECT DISTINCT doc_id AS id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS ws FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id AS id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS ws FROM eval_items WHERE text IS NOT NULL),
dg AS (SELECT id, array_to_string(ws[k:k + 11], ' ') AS g FROM (SELECT id, ws, unnest(range(1, len(ws) - 10)) AS k FROM w WHERE len(ws) >= 12)),
ig AS (SELECT id, array_to_string(ws[k:k + 11], ' ') AS g FROM (SELECT id, ws, unnest(range(1, len(ws) - 10)) AS k FROM i WHERE len(ws) >= 12))
SELECT DISTINCT dg.id AS doc_id, ig.id AS item_id FROM dg JOIN ig USING (g)""",
}
