"""Queries over the operators of the document pipeline, with their SQL.  Keys begin with the operator's id."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.functions import ids, text, urn, vector
from lexgrain.operators import citations, conflicts, deltas, lookups, upserts, vectors
from lexgrain.plans.scale import read, shared_dir
from lexgrain.sources import acts_xml, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
C = F.col
#: A fixed moment that stands for now.
AS_OF = "2025-03-01 00:00:00"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def nodes(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "nodes")


def fragments(s: SparkSession, d: str) -> DataFrame:
    """parse_id, node_pos, f: the XML fragments of the parsed acts, without those that are missing."""
    return read(s, d, "parsed_acts").select("parse_id", F.posexplode("nodes.text_xml_fragment").alias("node_pos", "f")).where("f is not null")


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


# Regular expressions in the dialect of the SQL engine, kept apart from Spark's.
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_clean(x: str) -> str:
    return sql_strip(rf"regexp_replace(regexp_replace(regexp_replace({x}, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


# Patterns and names are those that the functions use, in the words of the SQL engine.
ART, LAW, _AKN, _MON = urn.ARTICLE, urn.LAW.format(more=""), urn.AKN, text.MONTHS
REL = "CASE " + " ".join(f"WHEN regexp_matches({{0}}, '(?i){form}') THEN '{name}'" for name, form in urn.RELATIONS if name != "CITES") + " ELSE 'CITES' END"


def sql_law(x: str) -> str:
    part = lambda k: f"regexp_extract({x}, '{LAW}', {k})"
    kind = f"lower({part(1)})"
    year = f"CASE WHEN length({part(3)}) = 2 THEN (CASE WHEN CAST({part(3)} AS INT) < 50 THEN '20' ELSE '19' END) || {part(3)} ELSE {part(3)} END"
    name = f"CASE WHEN contains({kind}, 'legge') OR contains({kind}, 'l.') THEN 'legge' WHEN contains({kind}, 'd.lgs') OR contains({kind}, 'legislativo') THEN 'decreto.legislativo' WHEN contains({kind}, 'd.l') THEN 'decreto.legge' WHEN contains({kind}, 'd.p.r') THEN 'decreto.presidente.repubblica' ELSE 'legge' END"
    return f"CASE WHEN {part(1)} <> '' THEN 'urn:nir:stato:' || {name} || ':' || ({year}) || ';' || {part(2)} END"


_PRETTY = "CASE " + " ".join(f"WHEN b IN {tuple(names)} THEN CASE WHEN r <> '' THEN '{with_id}' || r ELSE '{alone}' END" for names, with_id, alone in text.LEVELS) + " WHEN r <> '' THEN b || ' ' || r ELSE b END"
# Chains of all distinct paths: relation `chain(canonical_path, h)`.
CHAIN = f"""seg AS (SELECT canonical_path, i, string_split(canonical_path, '/')[i] AS s FROM (SELECT canonical_path, unnest(range(1, len(string_split(canonical_path, '/')) + 1)) AS i FROM (SELECT DISTINCT canonical_path FROM nodes WHERE canonical_path IS NOT NULL))),
ok AS (SELECT *, lower(s) IN {tuple(text.TECHNICAL)} AS tech FROM seg WHERE s <> ''),
pick AS (SELECT * FROM ok QUALIFY NOT tech OR bool_and(tech) OVER (PARTITION BY canonical_path)),
pr AS (SELECT canonical_path, i, trim(lower(split_part(s, ':', 1))) AS b, trim(CASE WHEN contains(s, ':') THEN substr(s, instr(s, ':') + 1) ELSE '' END) AS r FROM pick),
chain AS (SELECT canonical_path, string_agg({_PRETTY}, ' > ' ORDER BY i) AS h FROM pr GROUP BY canonical_path)"""
LATEST_ACT = "act AS (SELECT * FROM acts WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC) = 1)"


def acts_latest(s: SparkSession, d: str) -> DataFrame:
    return upserts.latest(read(s, d, "acts").where("doc_id is not null").select("doc_id", "canonical_doc", "updated_at"), ["doc_id"], "updated_at")


# --- sources -----------------------------------------------------------------------------------------------------


@query("SELECT url AS path, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes, collected_at AS mtime, false AS is_from_zip, 'new' AS status FROM documents")
def s02_raw_record(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    found = docs.select(C("url").alias("path"), F.lit(None).cast("string").alias("derived_from"), C("text").cast("binary").alias("content"), C("collected_at").alias("modificationTime"))
    return files.raw_records(found.withColumn("path", F.coalesce("path", F.lit("")))).withColumn("path", F.nullif("path", F.lit(""))).drop("derived_from")


@query("SELECT node_id, sha256(coalesce(text_content, '')) AS sha FROM nodes")
def s03_content_hash(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", F.sha2(F.coalesce("text_content", F.lit("")).cast("binary"), 256).alias("sha"))


@query("""SELECT lower(regexp_extract(f, '^\\s*<([A-Za-z_][^\\s/>]*)', 1)) AS root, count(*) AS n FROM (SELECT unnest(nodes).text_xml_fragment AS f FROM parsed_acts) WHERE f IS NOT NULL GROUP BY 1""")
def s06_root_sniff(s: SparkSession, d: str) -> DataFrame:
    found = read(s, d, "parsed_acts").select(F.explode("nodes.text_xml_fragment").alias("f")).where("f is not null")
    return found.groupBy(acts_xml.root_tag(C("f")).alias("root")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT version_id, CASE WHEN bool_or(starts_with(canonical_path, 'akomaNtoso')) THEN 'akoma' ELSE 'simple' END AS dialect FROM nodes GROUP BY version_id")
def s07_dialect(s: SparkSession, d: str) -> DataFrame:
    xml = F.concat(F.lit('<?xml version="1.0"?><!-- x --><'), F.split(F.split("canonical_path", "/")[0], ":")[0], F.lit(' xmlns="u"/>'))
    return nodes(s, d).select("version_id", acts_xml.dialect(xml).alias("k")).groupBy("version_id").agg(F.min("k").alias("dialect"))


_EXPORT = f"""WITH {LATEST_ACT}, {CHAIN}
SELECT n.node_id AS id, CASE WHEN a.doc_id IS NULL THEN 'Documento Sconosciuto' WHEN length(a.title) > 3 THEN replace({sql_strip("a.title")}, '_', ' ') ELSE a.canonical_doc END AS source,
  coalesce(a.canonical_doc, '') AS source_id,
  {sql_strip("replace(regexp_replace(replace(replace(coalesce(c.h, ''), 'body > ', ''), 'main > ', ''), 'akoma[a-zA-Z]* >|art_|para_|chp_|point_|__', '', 'g'), ' .', '.')")} AS context,
  {sql_clean("n.text_content")} AS text, '' AS url FROM nodes n LEFT JOIN act a ON a.doc_id = n.doc_id LEFT JOIN chain c ON c.canonical_path = n.canonical_path"""


@query(_EXPORT)
def s09_export_rows(s: SparkSession, d: str) -> DataFrame:
    return lookups.export_rows(nodes(s, d), read(s, d, "acts"))


@query(_EXPORT)
def s10_jsonl_roundtrip(s: SparkSession, d: str) -> DataFrame:
    lines = lookups.export_rows(nodes(s, d), read(s, d, "acts")).select(F.to_json(F.struct("*")).alias("value"))
    return files.parse_jsonl(lines).where("not bad").drop("bad")


@query("SELECT CAST(count(*) FILTER (NOT coalesce(is_from_zip, false)) AS BIGINT) AS files, CAST(count(*) FILTER (NOT coalesce(is_from_zip, false) AND lower(original_path) LIKE '%.xml') AS BIGINT) AS \"xml\", CAST(count(*) FILTER (NOT coalesce(is_from_zip, false) AND lower(original_path) LIKE '%.zip') AS BIGINT) AS zip FROM (SELECT DISTINCT * FROM raw_files)")
def s15_run_stats(s: SparkSession, d: str) -> DataFrame:
    return files.run_stats(read(s, d, "raw_files").distinct(), "original_path")


# --- parsing -----------------------------------------------------------------------------------------------------


def _act_xml(*inner: Column) -> Column:
    return F.concat(F.lit("<atto>"), *inner, F.lit("</atto>"))


def _tag(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


@query("""SELECT DISTINCT doc_id, coalesce(nullif(doc_type, ''), 'altro') || ':' || coalesce(act_number, 0) || ':' || coalesce(act_year, 0) AS canonical_doc, coalesce(nullif(doc_type, ''), 'altro') AS doc_type, act_number AS "number", act_year AS "year", nullif(title, '') AS title FROM acts""")
def x01_meta(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "acts").select("doc_id", "doc_type", "act_number", "act_year", "title").distinct()
    meta = _tag("meta", F.concat(_tag("doc_type", F.coalesce(F.upper("doc_type"), F.lit(""))), _tag("number", F.coalesce(C("act_number").cast("string"), F.lit(""))), _tag("year", F.coalesce(C("act_year").cast("string"), F.lit(""))), _tag("title", escaped(C("title")))))
    found = acts_xml.parsed(rows.select("doc_id", _act_xml(meta).alias("xml")), "doc_id", "xml")
    return found.select("doc_id", "doc.canonical_doc", "doc.doc_type", "doc.number", "doc.year", "doc.title")


def _nested_xml(path: Column, body: Column) -> Column:
    """The simple-dialect XML whose deepest element has the given path."""
    element = {"art": "articolo", "c": "comma", "lett": "lettera", "num": "numero", "allegato": "allegato", "tabella": "tabella", "nota": "nota"}
    names = F.create_map(*[F.lit(x) for kv in element.items() for x in kv])
    parts = F.split(path, "/")
    opened = F.array_join(F.transform(parts, lambda p: F.concat(F.lit("<"), F.element_at(names, F.split(p, ":")[0]), F.lit(' id="'), F.substring_index(p, ":", -1), F.lit('">'))), "")
    closed = F.array_join(F.transform(F.reverse(parts), lambda p: F.concat(F.lit("</"), F.element_at(names, F.split(p, ":")[0]), F.lit(">"))), "")
    return _act_xml(opened, body, closed)


_SIMPLE = "regexp_full_match(canonical_path, '(art|allegato|nota):[^/:]+(/(c|lett|num|tabella):[^/:]+)*')"


@query(
    f"""SELECT node_id, CAST(i - 1 AS INTEGER) AS ordinal, array_to_string(p[1:i], '/') AS canonical_path,
  CASE split_part(p[i], ':', 1) WHEN 'art' THEN 'articolo' WHEN 'c' THEN 'comma' WHEN 'lett' THEN 'lettera' WHEN 'num' THEN 'numero' ELSE split_part(p[i], ':', 1) END AS node_type,
  CASE split_part(p[i], ':', 1) WHEN 'art' THEN 'Art. ' WHEN 'c' THEN 'comma ' WHEN 'lett' THEN 'lett. ' WHEN 'num' THEN 'num. ' WHEN 'allegato' THEN 'Allegato ' WHEN 'tabella' THEN 'Tabella ' ELSE 'nota ' END || split_part(p[i], ':', 2) AS "label",
  CASE WHEN starts_with(p[i], 'art:') THEN sha256('') ELSE sha256({sql_clean("t")}) END AS text_hash
FROM (SELECT node_id, p, t, unnest(range(1, len(p) + 1)) AS i FROM (SELECT DISTINCT node_id, string_split(canonical_path, '/') AS p, coalesce(text_content, '') AS t FROM nodes WHERE {_SIMPLE} AND NOT regexp_matches(coalesce(text_content, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\r]')))"""
)
def x05_article_tree(s: SparkSession, d: str) -> DataFrame:
    body = F.coalesce("text_content", F.lit(""))
    rows = nodes(s, d).where(C("canonical_path").rlike("^(art|allegato|nota):[^/:]+(/(c|lett|num|tabella):[^/:]+)*$") & ~body.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\r]"))
    xml = rows.select("node_id", "canonical_path", body.alias("b")).distinct().select("node_id", _nested_xml(C("canonical_path"), escaped(C("b"))).alias("xml"))
    found = acts_xml.parsed(xml, "node_id", "xml").select("node_id", F.explode("nodes").alias("n"))
    return found.select("node_id", "n.ordinal", "n.canonical_path", "n.node_type", "n.label", "n.text_hash")


@query(f"SELECT DISTINCT doc_id, 'atto/preambolo' AS canonical_path, 'atto_preambolo' AS node_type, sha256({sql_clean('title')}) AS text_hash FROM acts WHERE title IS NOT NULL")
def x04_preamble(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "acts").where("title is not null").select("doc_id", _act_xml(_tag("preambolo", escaped(C("title")))).alias("xml")).distinct()
    found = acts_xml.parsed(rows, "doc_id", "xml").select("doc_id", F.explode("nodes").alias("n"))
    return found.select("doc_id", "n.canonical_path", "n.node_type", "n.text_hash").distinct()


@query(
    r"""SELECT DISTINCT parse_id, CAST(i - 1 AS INTEGER) AS node_pos, 'akomaNtoso/act/body/' || regexp_extract(f, '^\s*<(\w+)', 1) || coalesce(':' || nullif(regexp_extract(f, '^\s*<\w+[^>]*?\seId="([^"]*)"', 1), ''), '') AS canonical_path, CAST(3 AS INTEGER) AS "level"
FROM (SELECT parse_id, i, nodes[i].text_xml_fragment AS f FROM (SELECT parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM parsed_acts)) WHERE f IS NOT NULL AND regexp_matches(f, '^\s*<(article|paragraph|point|list|item|section|chapter|annex)[ >]') AND regexp_extract(f, '^\s*<(\w+)', 1) = regexp_extract(f, '</(\w+)>\s*$', 1)
  AND len(regexp_extract_all(f, '<[a-zA-Z]')) = len(regexp_extract_all(f, '</'))"""
)
def x13_paths(s: SparkSession, d: str) -> DataFrame:
    """Path and level of the outermost element of every whole fragment."""
    whole = F.concat(F.lit(f'<akomaNtoso xmlns="{acts_xml.AKN_NAMESPACE}3.0"><act><body>'), C("f"), F.lit("</body></act></akomaNtoso>"))
    keyed = fragments(s, d).distinct().select(F.to_json(F.struct("parse_id", "node_pos")).alias("k"), whole.alias("xml"))
    parsed = acts_xml.parsed(keyed, "k", "xml", recover=False).where("parse_error is null")
    key, top = F.from_json("k", "parse_id long, node_pos int"), F.get("nodes", F.lit(0))
    return parsed.where(F.size("nodes") > 0).select(key["parse_id"].alias("parse_id"), key["node_pos"].alias("node_pos"), top["canonical_path"].alias("canonical_path"), top["level"].alias("level"))


@query(
    r"""SELECT parse_id, CAST(i - 1 AS INTEGER) AS node_pos, CAST(len(regexp_extract_all(f, '<(article|paragraph|point|list|item|section|chapter|annex)[ >]')) AS INTEGER) AS n_nodes,
  CAST(len(regexp_extract_all(f, '<ref[ >]')) AS INTEGER) AS n_refs, lower(regexp_extract(f, '^\s*<(\w+)', 1)) AS root
FROM (SELECT parse_id, i, nodes[i].text_xml_fragment AS f FROM (SELECT DISTINCT parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM parsed_acts)) WHERE f IS NOT NULL AND regexp_matches(f, '^\s*<(article|paragraph|point|list|item|section|chapter|annex)[ >]') AND regexp_extract(f, '^\s*<(\w+)', 1) = regexp_extract(f, '</(\w+)>\s*$', 1)
  AND len(regexp_extract_all(f, '<[a-zA-Z]')) = len(regexp_extract_all(f, '</')) AND NOT regexp_matches(f, '/>')"""
)
def x09_akoma_visit(s: SparkSession, d: str) -> DataFrame:
    found = fragments(s, d).distinct()
    whole = F.concat(F.lit(f'<akomaNtoso xmlns="{acts_xml.AKN_NAMESPACE}3.0"><act><body>'), C("f"), F.lit("</body></act></akomaNtoso>"))
    keyed = found.select(F.struct("parse_id", "node_pos").alias("k"), whole.alias("xml"))
    parsed = acts_xml.parsed(keyed.select(F.to_json("k").alias("k"), "xml"), "k", "xml", recover=False).where("parse_error is null")
    key = F.from_json("k", "parse_id long, node_pos int")
    top = F.get("nodes", F.lit(0))
    return parsed.where(F.size("nodes") > 0).select(key["parse_id"].alias("parse_id"), key["node_pos"].alias("node_pos"), F.size("nodes").alias("n_nodes"), F.size(top["refs"]).alias("n_refs"), top["node_type"].alias("root"))


@query(rf"""SELECT node_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text_content, ''), '[\x00-\x1F\x7F]', ' ', 'g'), '{WS}+', ' ', 'g'), '\s+([.,;:])', '\1', 'g')) AS txt FROM nodes""")
def x12_inline_whitespace(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", text.clean_inline(F.coalesce("text_content", F.lit(""))).alias("txt"))


@query("""SELECT DISTINCT parse_id, nullif(urn, '') AS urn, nullif(work_urn, '') AS work_urn, nullif(expression_urn, '') AS expression_urn, nullif(manifestation_urn, '') AS manifestation_urn, nullif(publication_date, '') AS publication_date, nullif(version_date, '') AS version_date FROM parsed_acts""")
def x15_frbr(s: SparkSession, d: str) -> DataFrame:
    v = lambda name, c, attr="value": F.concat(F.lit(f'<{name} {attr}="'), escaped(C(c)), F.lit('"/>'))
    xml = F.concat(
        F.lit("<akomaNtoso><act><meta><identification><FRBRWork>"), v("FRBRthis", "urn"), v("FRBRuri", "work_urn"), v("FRBRdate", "publication_date", "date"),
        F.lit("</FRBRWork><FRBRExpression>"), v("FRBRthis", "expression_urn"), v("FRBRdate", "version_date", "date"), F.lit("</FRBRExpression><FRBRManifestation>"), v("FRBRthis", "manifestation_urn"),
        F.lit("</FRBRManifestation></identification></meta></act></akomaNtoso>"),
    )
    return read(s, d, "parsed_acts").select("parse_id", acts_xml.frbr(xml).alias("m")).distinct().select("parse_id", "m.*")


@query("SELECT node_id, list_extract(string_split(canonical_path, '/'), -1) AS seg, split_part(list_extract(string_split(canonical_path, '/'), -1), ':', 1) AS kind FROM nodes")
def x17_last_segment(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", ids.last_segment(C("canonical_path")).alias("seg"), ids.node_type(C("canonical_path")).alias("kind"))


@query(r"""SELECT doc_id, urn, nullif(regexp_extract(urn, '([a-z.]+):(\d{4})[^;]*;(\d+)', 1), '') AS doc_type, CAST(nullif(regexp_extract(urn, '([a-z.]+):(\d{4})[^;]*;(\d+)', 2), '') AS INTEGER) AS act_year, CAST(nullif(regexp_extract(urn, '([a-z.]+):(\d{4})[^;]*;(\d+)', 3), '') AS BIGINT) AS "number" FROM acts""")
def x19_urn_parts(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "acts").select("doc_id", "urn", *[c.alias(k) for k, c in urn.nir_parts(C("urn")).items()])


@query(f"""SELECT doc_id, akn_uri, coalesce(nullif(lower(regexp_extract(akn_uri, '{_AKN}', 2)), ''), 'altro') AS doc_type, CAST(nullif(regexp_extract(akn_uri, '{_AKN}', 5), '') AS BIGINT) AS "number", CAST(nullif(regexp_extract(akn_uri, '{_AKN}', 4)[:4], '') AS INTEGER) AS act_year, nullif(regexp_extract(akn_uri, '{_AKN}', 3), '') AS authority FROM acts""")
def x20_akn_parts(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "acts").select("doc_id", "akn_uri", *[c.alias(k) for k, c in urn.akn_parts(C("akn_uri")).items()])


# --- scalar functions --------------------------------------------------------------------------------------------


@query("SELECT canonical_doc, sha256(canonical_doc) AS doc_id FROM acts")
def f01_doc_hash(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "acts").select("canonical_doc", ids.text_sha(C("canonical_doc")).alias("doc_id"))


@query("SELECT doc_id, coalesce(nullif(doc_type, ''), '0') || ':' || coalesce(CAST(act_number AS VARCHAR), '0') || ':' || coalesce(CAST(act_year AS VARCHAR), '0') AS made FROM acts")
def f02_canonical_doc(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "acts").select("doc_id", ids.canonical_doc(C("doc_type"), C("act_number"), C("act_year")).alias("made"))


@query("SELECT node_id, sha256(doc_id || ':' || version_id || ':' || canonical_path) AS made FROM nodes")
def f03_node_id(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", ids.node_id(C("doc_id"), C("version_id"), C("canonical_path")).alias("made"))


_G = lambda k: f"nullif(regexp_extract(text_content, '{ART}', {k}), '')"


@query(f"""WITH p AS (SELECT node_id, doc_id, {_G(1)} AS a, {_G(2)} AS c, {_G(3)} AS l, {_G(4)} AS n FROM nodes),
t AS (SELECT *, concat_ws('/', 'art:' || a, 'c:' || c, 'lett:' || l, 'num:' || n) AS f, concat_ws('-', 'art' || a, 'com' || c, 'let' || l, 'num' || n) AS g FROM p)
SELECT node_id, doc_id || CASE WHEN f <> '' THEN '#' || f ELSE '' END AS node_ref, doc_id || CASE WHEN g <> '' THEN '#' || g ELSE '' END AS urn FROM t""")
def f04_node_ref(s: SparkSession, d: str) -> DataFrame:
    parts = urn.article_parts(C("text_content"))
    return nodes(s, d).select("node_id", ids.node_ref(C("doc_id"), *parts).alias("node_ref"), urn.with_fragment(C("doc_id"), *parts).alias("urn"))


@query("SELECT node_id, replace(canonical_path, '/', '_') AS sort_key, doc_id || '/' || canonical_path AS joined FROM nodes")
def f05_sort_key(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", ids.sort_key(C("canonical_path")).alias("sort_key"), ids.join_path(C("doc_id"), C("canonical_path")).alias("joined"))


@query(f"SELECT doc_id, {sql_clean('text')} AS txt FROM documents")
def f07_clean(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", text.clean(C("text")).alias("txt"))


@query(r"""SELECT parse_id, CAST(i - 1 AS INTEGER) AS node_pos, regexp_replace(regexp_replace(regexp_replace(f, '<[^>]*>', '', 'g'), '&lt;', '<', 'g'), '\s+', '', 'g') AS txt FROM (SELECT parse_id, i, nodes[i].text_xml_fragment AS f FROM (SELECT DISTINCT parse_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM parsed_acts))
WHERE regexp_matches(f, '^<(point|item)[ >]') AND regexp_matches(f, '</(point|item)>$') AND NOT regexp_matches(f, '&')""")
def f08_element_text(s: SparkSession, d: str) -> DataFrame:
    found = fragments(s, d)
    shown = found.where(C("f").rlike("^<(point|item)[ >]") & C("f").rlike("</(point|item)>$") & ~C("f").contains("&")).distinct()  # what its SQL can follow
    return shown.select("parse_id", "node_pos", F.regexp_replace(acts_xml.element_texts(C("f")), r"\s+", "").alias("txt"))


@query()
def f08_all_elements(s: SparkSession, d: str) -> DataFrame:
    """The text of every fragment of any element, as it is joined; null where the fragment cannot be parsed."""
    return fragments(s, d).distinct().select("parse_id", "node_pos", acts_xml.element_texts(C("f")).alias("txt"))


@query(f"SELECT node_id, sha256(coalesce(nullif({sql_clean('text_content')}, ''), nullif(text_content, ''), '')) AS h FROM nodes")
def f09_text_hash(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", text.content_hash(text.clean(C("text_content")), C("text_content")).alias("h"))


@query(f"WITH {CHAIN} SELECT n.node_id, c.h AS chain FROM nodes n LEFT JOIN chain c USING (canonical_path)")
def f10_hierarchy(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", text.hierarchy(C("canonical_path")).alias("chain"))


@query(f"""SELECT node_id, {sql_strip("replace(regexp_replace(replace(replace(replace(canonical_path, '/', ' > '), 'body > ', ''), 'main > ', ''), 'akoma[a-zA-Z]* >|art_|para_|chp_|point_|__', '', 'g'), ' .', '.')")} AS context FROM nodes""")
def f11_export_context(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", text.export_context(F.replace("canonical_path", F.lit("/"), F.lit(" > "))).alias("context"))


@query(f"SELECT doc_id, CASE WHEN length(title) > 3 THEN replace({sql_strip('title')}, '_', ' ') ELSE canonical_doc END AS source FROM acts")
def f12_source_name(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "acts").select("doc_id", text.source_name(C("title"), C("canonical_doc"), F.lit(True)).alias("source"))


_DM = rf"(?i)\b(\d{{1,2}})\s+({'|'.join(_MON)})\s+(\d{{4}})\b"
_DS = r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"


@query(f"""WITH p AS (SELECT doc_id, regexp_extract(text, '{_DS}', 1) AS a, regexp_extract(text, '{_DS}', 2) AS b, regexp_extract(text, '{_DS}', 3) AS c, regexp_extract(text, '{_DM}', 1) AS x, list_position(['{"','".join(_MON)}'], lower(regexp_extract(text, '{_DM}', 2))) AS y, regexp_extract(text, '{_DM}', 3) AS z FROM documents)
SELECT doc_id, CASE WHEN a <> '' AND CAST(b AS INT) <> 0 THEN TRY_CAST(c || '-' || lpad(b, 2, '0') || '-' || lpad(a, 2, '0') AS DATE) WHEN x <> '' THEN TRY_CAST(z || '-' || lpad(CAST(y AS VARCHAR), 2, '0') || '-' || lpad(x, 2, '0') AS DATE) END AS found FROM p""")
def f13_italian_date(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", text.italian_date(C("text")).alias("found"))


@query(f"""SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN '(testo vuoto)' WHEN s = '' THEN text[:400] ELSE s END AS around FROM (SELECT doc_id, text, {sql_strip("substr(text, greatest(0, n_chars // 2 - 200) + 1, least(length(text), n_chars // 2 + 200) - greatest(0, n_chars // 2 - 200))")} AS s FROM documents)""")
def f14_snippet(s: SparkSession, d: str) -> DataFrame:
    at = F.floor(C("n_chars") / 2).cast("int")
    return read(s, d, "documents").select("doc_id", text.snippet(C("text"), at).alias("around"))


@query(f"SELECT node_id, {REL.format('text_content')} AS relation FROM nodes")
def f15_relation(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", urn.relation(C("text_content")).alias("relation"))


@query("SELECT doc_id, CASE WHEN contains(lower(t), 'tuir') THEN 'dpr:917:1986' WHEN contains(lower(t), 'statuto del contribuente') THEN 'l:212:2000' END AS target FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ex TUIR ' WHEN doc_id % 3 = 1 THEN 'STATUTO DEL CONTRIBUENTE ' ELSE '' END || coalesce(text, '') AS t FROM documents)")
def f16_alias(s: SparkSession, d: str) -> DataFrame:
    mixed = F.concat(F.when(C("doc_id") % 3 == 0, "ex TUIR ").when(C("doc_id") % 3 == 1, "STATUTO DEL CONTRIBUENTE ").otherwise(""), F.coalesce("text", F.lit("")))
    return read(s, d, "documents").select("doc_id", urn.alias_target(mixed).alias("target"))


@query(f"SELECT node_id, {sql_law('text_content')} AS urn FROM nodes")
def f17_dynamic_law(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", urn.law_urn(C("text_content")).alias("urn"))


@query("SELECT node_type, CAST(count(*) FILTER (coalesce(text_content, '') = '') AS BIGINT) AS n_empty FROM nodes GROUP BY 1")
def f19_empty(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).groupBy("node_type").agg(F.count_if(text.is_empty(C("text_content"))).alias("n_empty"))


@query("SELECT node_id, CASE WHEN length(coalesce(text_content, '')) = 0 THEN 0.0 ELSE greatest(0.0, 1 - length(canonical_path) / length(text_content)) END AS ratio FROM nodes")
def f20_ratio(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", text.compression_ratio(C("text_content"), C("canonical_path")).alias("ratio"))


_EMB = f"{sql_strip('''coalesce(text, '')''')}"


@query(f"""SELECT doc_id, {sql_strip("'passage: ' || " + sql_strip("coalesce(source, '')") + " || ' ' || " + _EMB)}[:2000] AS document FROM documents WHERE length({_EMB}) > 10""")
def f21_embedding_text(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", text.embedding_text(C("source"), C("text")).alias("document")).where("document is not null")


@query(f"SELECT doc_id, coalesce(source, '')[:200] AS source, coalesce(canonical_doc, '')[:100] AS source_id, coalesce(url, '')[:500] AS url, coalesce({sql_strip('text')}, '')[:1500] AS original_text FROM documents")
def f22_metadata(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", text.metadata(C("source"), C("canonical_doc"), C("url"), C("text")).alias("m")).select("doc_id", "m.*")


# --- filters, joins ----------------------------------------------------------------------------------------------


@query("SELECT DISTINCT raw_id, original_path, arrived_at FROM raw_files WHERE status = 'new'")
def p01_queue(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "raw_files").where("status = 'new'").select("raw_id", "original_path", "arrived_at").distinct().orderBy("raw_id", "arrived_at")


@query("SELECT node_id, length(text_content) AS n FROM nodes WHERE length(text_content) > 50")
def p02_long_text(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).where(F.length("text_content") > 50).select("node_id", F.length("text_content").cast("long").alias("n"))


@query("SELECT node_id, canonical_path FROM nodes WHERE heading IS NULL OR heading = ''")
def p03_missing(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).where(text.is_empty(C("heading"))).select("node_id", "canonical_path")


@query("SELECT n.node_id FROM nodes n WHERE n.doc_id IN (SELECT doc_id FROM acts WHERE deleted_at IS NOT NULL)")
def p04_in_set(s: SparkSession, d: str) -> DataFrame:
    gone = read(s, d, "acts").where("deleted_at is not null").select("doc_id").distinct()
    return nodes(s, d).join(gone, "doc_id", "left_semi").select("node_id")


@query("SELECT canonical_doc, doc_type, act_number, act_year, title, publication_date FROM acts WHERE doc_type = 'l' AND act_year = 1952")
def p05_acts_filter(s: SparkSession, d: str) -> DataFrame:
    return lookups.acts_query(read(s, d, "acts"), "l", 1952, 0)


@query(f"SELECT CAST(coalesce(count(*) FILTER (status = 'error') / nullif(count(*), 0), 0) AS DOUBLE) AS error_rate FROM raw_files WHERE discovered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS")
def p06_recent_errors(s: SparkSession, d: str) -> DataFrame:
    return lookups.error_rate(read(s, d, "raw_files"), AS_OF)


@query("SELECT doc_id FROM documents WHERE text ILIKE '%impianti%depurazione%'")
def p07_like(s: SparkSession, d: str) -> DataFrame:
    return lookups.search_like(read(s, d, "documents"), "text", "impianti%depurazione").select("doc_id")


@query(f"WITH {LATEST_ACT} SELECT n.node_id, a.canonical_doc FROM nodes n LEFT JOIN act a USING (doc_id)")
def j01_node_act(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).join(acts_latest(s, d).select("doc_id", "canonical_doc"), "doc_id", "left").select("node_id", "canonical_doc")


@query("SELECT r.ref_id, r.source_node_id FROM references_extracted r WHERE r.confidence < 0.6 AND NOT EXISTS (SELECT 1 FROM references_extracted e WHERE e.confidence >= 0.6 AND e.source_node_id = r.source_node_id AND e.relation_type = r.relation_type)")
def j02_not_existing(s: SparkSession, d: str) -> DataFrame:
    refs = read(s, d, "references_extracted")
    sure = refs.where("confidence >= 0.6").select("source_node_id", "relation_type").distinct()
    return refs.where("confidence < 0.6").join(sure, ["source_node_id", "relation_type"], "left_anti").select("ref_id", "source_node_id")


_PAIRS = """pr AS (SELECT a.node_id AS node_id_a, b.node_id AS node_id_b, a.doc_id, a.canonical_path, a.version_id AS version_id_a, b.version_id AS version_id_b,
  CASE WHEN coalesce(a.is_current_law AND b.is_current_law, false) OR (a.valid_to IS NULL AND b.valid_to IS NULL) THEN 'critical' ELSE 'warning' END AS severity
  FROM one a JOIN one b ON a.doc_id = b.doc_id AND a.canonical_path = b.canonical_path AND a.node_id < b.node_id
  WHERE coalesce(a.valid_from, DATE '0001-01-01') <= coalesce(b.valid_to, DATE '9999-12-31') AND coalesce(b.valid_from, DATE '0001-01-01') <= coalesce(a.valid_to, DATE '9999-12-31'))"""
_ONE = "one AS (SELECT DISTINCT node_id, doc_id, version_id, canonical_path, valid_from, valid_to, is_current_law FROM nodes QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY loaded_at DESC, valid_from DESC NULLS LAST, valid_to DESC NULLS LAST, is_current_law DESC NULLS LAST) = 1)"


def _one_node(s: SparkSession, d: str) -> DataFrame:
    picked = nodes(s, d).select("node_id", "loaded_at", "valid_from", "valid_to", "is_current_law", "doc_id", "version_id", "canonical_path")
    return upserts.latest(picked, ["node_id"], "loaded_at", "valid_from", "valid_to", "is_current_law")


@query(f"WITH {_ONE}, {_PAIRS} SELECT node_id_a, node_id_b, severity FROM pr")
def j05_overlap(s: SparkSession, d: str) -> DataFrame:
    return conflicts.conflict_pairs(_one_node(s, d)).select("node_id_a", "node_id_b", "severity")


@query(f"""WITH {_ONE}, {_PAIRS} SELECT doc_id, severity, 'pending' AS status, count(*) AS n FROM pr p WHERE NOT EXISTS (SELECT 1 FROM pr h WHERE h.severity = 'critical' AND h.node_id_a = p.node_id_a AND h.node_id_b = p.node_id_b) GROUP BY ALL""")
def t04_conflict_events(s: SparkSession, d: str) -> DataFrame:
    pairs = conflicts.conflict_pairs(_one_node(s, d))
    return conflicts.new_events(pairs, pairs.where("severity = 'critical'")).groupBy("doc_id", "severity", "status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT node_id, valid_to IS NULL AS is_current FROM nodes")
def t05_current(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", conflicts.is_current(C("valid_to")).alias("is_current"))


@query(f"""WITH {LATEST_ACT}, v AS (SELECT DISTINCT doc_id, version_id, version_tag, valid_from, valid_to FROM document_versions)
SELECT a.doc_id, a.canonical_doc, CAST(count(v.version_id) AS INTEGER) AS n_versions, min(v.version_id) AS first_version FROM act a LEFT JOIN v ON v.doc_id = a.doc_id GROUP BY ALL""")
def j06_act_versions(s: SparkSession, d: str) -> DataFrame:
    found = lookups.with_versions(acts_latest(s, d), read(s, d, "document_versions"))
    return found.select("doc_id", "canonical_doc", F.coalesce(F.size("versions"), F.lit(0)).alias("n_versions"), F.get("versions", F.lit(0))["version_id"].alias("first_version"))


# --- aggregates, upserts -----------------------------------------------------------------------------------------


@query("SELECT node_type, count(*) AS n_nodes, CAST(count(*) FILTER (coalesce(text_content, '') = '') AS BIGINT) AS n_empty FROM nodes GROUP BY 1")
def a01_quality(s: SparkSession, d: str) -> DataFrame:
    return lookups.quality(nodes(s, d))


@query(f"""SELECT 'ok' AS status, (SELECT run_id FROM ingestion_runs WHERE status = 'finished' ORDER BY finished_at DESC NULLS FIRST, run_id DESC LIMIT 1) AS last_run, CAST(count(*) FILTER (status = 'new') AS BIGINT) AS pending,
  CAST(coalesce(count(*) FILTER (status = 'error' AND discovered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS) / nullif(count(*) FILTER (discovered_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS), 0), 0) AS DOUBLE) AS error_rate FROM raw_files""")
def q01_health(s: SparkSession, d: str) -> DataFrame:
    return lookups.health(read(s, d, "ingestion_runs"), read(s, d, "raw_files"), AS_OF)


@query("SELECT run_id, started_at, finished_at FROM ingestion_runs WHERE status = 'finished' ORDER BY finished_at DESC NULLS FIRST, run_id DESC LIMIT 1")
def a04_last_run(s: SparkSession, d: str) -> DataFrame:
    return lookups.last_finished(read(s, d, "ingestion_runs")).select("run_id", "started_at", "finished_at")


@query("""WITH o AS (SELECT DISTINCT version_id, canonical_path, loaded_at, coalesce(text_content, '') AS t FROM nodes)
SELECT version_id, sha256(string_agg(t, chr(10) ORDER BY canonical_path, loaded_at, t)) AS checksum_text FROM o GROUP BY 1""")
def a05_checksum(s: SparkSession, d: str) -> DataFrame:
    rows = nodes(s, d).select("version_id", "canonical_path", "loaded_at", F.coalesce("text_content", F.lit("")).alias("text_content")).distinct()
    return upserts.version_checksum(rows, ["version_id"], ["canonical_path", "loaded_at"], "text_content")


@query(f"""WITH {LATEST_ACT}, {CHAIN}, e AS ({_EXPORT[_EXPORT.index("SELECT n.node_id"):]}), b AS (SELECT {_EMB} AS body, {sql_strip("context")} AS ctx FROM e)
SELECT CAST(count(*) FILTER (length(body) > 10) AS BIGINT) AS processed, CAST(count(*) FILTER (length(body) <= 10) AS BIGINT) AS skipped_short, CAST(0 AS BIGINT) AS skipped_json, CAST(count(*) FILTER (length(body) > 10 AND length({sql_strip("'passage: ' || ctx || ' ' || body")}) > 2000) AS BIGINT) AS truncated FROM b""")
def a07_vector_counters(s: SparkSession, d: str) -> DataFrame:
    lines = lookups.export_rows(nodes(s, d), read(s, d, "acts")).select(F.to_json(F.struct("*")).alias("value"))
    return vectors.counters(files.parse_jsonl(lines))


@query("SELECT sha256, min(original_path) AS original_path FROM raw_files WHERE sha256 IS NOT NULL AND original_path IS NOT NULL GROUP BY sha256")
def u01_dedup_content(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "raw_files").where("sha256 is not null and original_path is not null").select("sha256", "original_path")
    return upserts.earliest(rows, ["sha256"], "original_path")


_HELD = "TIMESTAMP '2019-12-31 00:00:00'"


@query(f"""WITH h AS (SELECT doc_id, title, created_at, updated_at FROM acts WHERE updated_at < {_HELD} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC, title DESC NULLS LAST, created_at DESC) = 1),
f AS (SELECT doc_id, title, created_at, updated_at FROM acts WHERE updated_at >= {_HELD} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC, title DESC NULLS LAST, created_at DESC) = 1)
SELECT doc_id, CASE WHEN f.doc_id IS NOT NULL THEN f.title ELSE h.title END AS title, CASE WHEN h.doc_id IS NOT NULL THEN h.created_at ELSE f.created_at END AS created_at, CASE WHEN f.doc_id IS NOT NULL THEN f.updated_at ELSE h.updated_at END AS updated_at FROM h FULL JOIN f USING (doc_id)""")
def u02_upsert_act(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "acts").select("doc_id", "title", "created_at", "updated_at")
    cut = F.lit("2019-12-31 00:00:00").cast("timestamp_ntz")
    held = upserts.latest(rows.where(C("updated_at") < cut), ["doc_id"], "updated_at", "title", "created_at")
    return upserts.upsert(held, rows.where(C("updated_at") >= cut), ["doc_id"], ["created_at"], "updated_at", "title", "created_at")


@query("SELECT doc_id, version_tag, max(loaded_at) AS loaded_at, min(version_id) AS version_id FROM document_versions WHERE version_tag IS NOT NULL GROUP BY ALL")
def u03_upsert_version(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "document_versions").where("version_tag is not null").select("doc_id", "version_tag", "loaded_at", "version_id")
    first = upserts.earliest(rows.select("doc_id", "version_tag", "version_id"), ["doc_id", "version_tag"], "version_id")
    last = upserts.latest(rows.select("doc_id", "version_tag", "loaded_at"), ["doc_id", "version_tag"], "loaded_at")
    return last.join(first, ["doc_id", "version_tag"])


@query("""SELECT version_id, canonical_path, loaded_at, length(text_content) AS n FROM nodes QUALIFY row_number() OVER (PARTITION BY version_id, canonical_path ORDER BY loaded_at DESC, length(text_content) DESC NULLS LAST) = 1""")
def u04_upsert_node(s: SparkSession, d: str) -> DataFrame:
    rows = nodes(s, d).select("version_id", "canonical_path", "loaded_at", F.length("text_content").cast("long").alias("n"))
    return upserts.latest(rows, ["version_id", "canonical_path"], "loaded_at", "n")


@query("SELECT source_node_id, destination_urn, relation_type, min(ref_id) AS ref_id FROM references_extracted WHERE destination_urn IS NOT NULL GROUP BY ALL")
def u05_first_wins(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "references_extracted").where("destination_urn is not null").select("source_node_id", "destination_urn", "relation_type", "ref_id")
    return upserts.earliest(rows, ["source_node_id", "destination_urn", "relation_type"], "ref_id")


@query("""WITH o AS (SELECT source_node_id, destination_urn, relation_type, arg_max(confidence, ref_id) FILTER (ref_id % 2 = 1) AS a, max(ref_id) FILTER (ref_id % 2 = 1) AS ra, arg_max(confidence, ref_id) FILTER (ref_id % 2 = 0) AS b FROM references_extracted WHERE source_node_id IS NOT NULL AND destination_urn IS NOT NULL GROUP BY ALL)
SELECT source_node_id, destination_urn AS target_canonical_node, relation_type, CASE WHEN ra IS NOT NULL THEN a ELSE b END AS confidence FROM o""")
def u06_merge_edges(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "references_extracted").where("source_node_id is not null and destination_urn is not null").select("source_node_id", C("destination_urn").alias("target_canonical_node"), "relation_type", "ref_id", "confidence")
    key = ["source_node_id", "target_canonical_node", "relation_type"]
    part = lambda k: upserts.latest(rows.where(C("ref_id") % 2 == k), key, "ref_id").withColumn("target_node_id", F.lit(None).cast("string")).drop("ref_id")
    return citations.merge_edges(part(0), part(1)).drop("target_node_id")


@query("SELECT least(source_node_id, doc_id) AS node_id_a, greatest(source_node_id, doc_id) AS node_id_b, CASE WHEN source_node_id > doc_id THEN ref_id ELSE -1 END AS v_a, CASE WHEN source_node_id > doc_id THEN -1 ELSE ref_id END AS v_b FROM (SELECT source_node_id, sha256(relation_type) AS doc_id, ref_id FROM references_extracted)")
def u07_pair_order(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "references_extracted").select(C("source_node_id").alias("node_id_a"), F.sha2("relation_type", 256).alias("node_id_b"), F.lit(-1).cast("long").alias("v_a"), C("ref_id").alias("v_b"))
    return conflicts.ordered_pair(rows, "node_id_a", "node_id_b", "v")


@query("SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'it') ")
def s12_resume(s: SparkSession, d: str) -> DataFrame:
    """What is left of the documents when the Italian ones are in the vector table already."""
    docs = read(s, d, "documents").select(C("doc_id").cast("string").alias("id"), "lang")
    return vectors.pending(docs, docs.where("lang = 'it'")).select("id").distinct()


@query("SELECT count(*) AS n FROM acts")
def s13_publish(s: SparkSession, d: str) -> DataFrame:
    """Rows of a table after it was published and read again."""
    path = f"{shared_dir(s)}/published-{uuid.uuid4().hex}"
    files.publish(read(s, d, "acts"), path)
    return s.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT label, max(vec_id) AS vec_id FROM embeddings GROUP BY label")
def u08_vector_upsert(s: SparkSession, d: str) -> DataFrame:
    return upserts.latest(read(s, d, "embeddings").select("label", "vec_id"), ["label"], "vec_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS number FROM (SELECT DISTINCT doc_id FROM acts)")
def l01_numbered(s: SparkSession, d: str) -> DataFrame:
    return upserts.numbered(read(s, d, "acts").select("doc_id").distinct(), "number", "doc_id")


@query("SELECT node_id, canonical_path FROM (SELECT DISTINCT node_id, canonical_path FROM nodes) ORDER BY canonical_path, node_id LIMIT 20")
def l02_limit(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).select("node_id", "canonical_path").distinct().orderBy("canonical_path", "node_id").limit(20)


@query()
def q08_preview(s: SparkSession, d: str) -> DataFrame:
    return lookups.preview(nodes(s, d), read(s, d, "acts"), 10)


# --- citations ---------------------------------------------------------------------------------------------------

_FORMS = [(k, f) for k, f in citations.ACTS]
_TXT = "src AS (SELECT DISTINCT node_id, doc_id, text_content AS t FROM nodes WHERE text_content IS NOT NULL)"


def _places_sql(form: str, groups: int) -> str:
    """Matches of a form with their 0-based places, by splitting and summing lengths."""
    take = ", ".join(f"regexp_extract_all(t, '{form}', {k})[i] AS g{k}" for k in range(1, groups + 1))
    return f"""SELECT node_id, doc_id, t, i, regexp_extract_all(t, '{form}')[i] AS m, {take},
      CAST(list_sum(list_transform(string_split_regex(t, '{form.replace("(?i)", "(?i)")}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, '{form}')[1:i - 1], lambda x: length(x))), 0) AS INTEGER) AS p
      FROM (SELECT node_id, doc_id, t, unnest(range(1, len(regexp_extract_all(t, '{form}')) + 1)) AS i FROM src)"""


_SNIP = sql_strip("substr(t, greatest(0, p - 200) + 1, least(length(t), p + 200) - greatest(0, p - 200))")
_ACTS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS kind, node_id, doc_id, t, p, m, '{k}:' || g1 || ':' || g2 AS target, NULL AS article, NULL AS comma, NULL AS letter, NULL AS number, CASE WHEN regexp_matches(substr(t, greatest(0, p - 80) + 1, p + length(m) + 80 - greatest(0, p - 80)), '{ART}') THEN 0.9 ELSE 0.6 END AS confidence FROM ({_places_sql(f, 2)})"
    for i, (k, f) in enumerate(_FORMS)
)
_ARTS_SQL = f"SELECT {len(_FORMS)} AS kind, node_id, doc_id, t, p, m, NULL AS target, nullif(g1, '') AS article, nullif(g2, '') AS comma, nullif(g3, '') AS letter, nullif(g4, '') AS number, 0.4 AS confidence FROM ({_places_sql(ART, 4)})"
_REFS = f"{_TXT}, refs AS (SELECT *, {REL.format('t')} AS relation_type, {_SNIP} AS snip FROM ({_ACTS_SQL} UNION ALL {_ARTS_SQL}))"


def _texts(s: SparkSession, d: str) -> DataFrame:
    """node_id, doc_id, text_content and a hash of the text.  Repeated texts of a node are told by it after the extraction, so no text is shuffled."""
    return nodes(s, d).where("text_content is not null").select("node_id", "doc_id", "text_content", F.xxhash64("text_content").alias("text_key"))


def _job(s: SparkSession, d: str, existing: DataFrame | None = None) -> DataFrame:
    job = citations.extraction_job(_texts(s, d), acts_latest(s, d), existing, keep=("text_key",))
    return job.dropDuplicates(["source_node_id", "doc_id", "text_key", "ordinal"])


def _references(s: SparkSession, d: str) -> DataFrame:
    return citations.extract(_texts(s, d), keep=("text_key",)).dropDuplicates(["node_id", "doc_id", "text_key", "ordinal"])


@query(f"WITH {_REFS} SELECT node_id, p AS \"start\", m AS match_text, target AS target_canonical_doc, article AS target_article, comma AS target_comma, letter AS target_letter, number AS target_number, CAST(confidence AS DOUBLE) AS confidence, relation_type, snip AS raw_snippet FROM refs")
def r02_references(s: SparkSession, d: str) -> DataFrame:
    """All act and article citations with places (no alias occurs in the texts)."""
    return _references(s, d).where("method = 'regex:v1'").drop("ordinal", "method", "doc_id", "text_key")


@query(f"WITH {_REFS} SELECT node_id, CAST(row_number() OVER (PARTITION BY node_id, t ORDER BY kind, p) - 1 AS INTEGER) AS ordinal, p AS \"start\", m AS match_text FROM refs")
def r04_order(s: SparkSession, d: str) -> DataFrame:
    """Citations in their order: by kind, then by place."""
    return _references(s, d).select("node_id", "ordinal", "start", "match_text")


@query("SELECT doc_id, alias AS match_text, target AS target_canonical_doc FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ex TUIR ' WHEN doc_id % 3 = 1 THEN 'STATUTO DEL CONTRIBUENTE ' ELSE '' END || coalesce(text, '') AS t FROM documents), (VALUES ('TUIR', 'dpr:917:1986'), ('Statuto del contribuente', 'l:212:2000')) v(alias, target) WHERE contains(lower(t), lower(alias))")
def r01_alias(s: SparkSession, d: str) -> DataFrame:
    mixed = F.concat(F.when(C("doc_id") % 3 == 0, "ex TUIR ").when(C("doc_id") % 3 == 1, "STATUTO DEL CONTRIBUENTE ").otherwise(""), F.coalesce("text", F.lit("")))
    found = citations.extract(read(s, d, "documents").select("doc_id", mixed.alias("text")), "text", "doc_id")
    return found.where("method = 'alias:v1'").select("doc_id", "match_text", "target_canonical_doc")


@query(f"WITH {_REFS} SELECT node_id, CAST(count(*) AS INTEGER) AS n, CAST(bool_and(substr(t, p + 1, length(m)) = m) AS BOOLEAN) AS placed FROM refs GROUP BY node_id, t")
def r05_offsets(s: SparkSession, d: str) -> DataFrame:
    found = citations.found_references(C("text_content"))
    rows = _texts(s, d).select("node_id", "text_content", "text_key", found.alias("r")).where(F.size("r") > 0)
    return rows.select("text_key", "node_id", F.size("r").alias("n"), F.forall("r", lambda r: F.substring(C("text_content"), r["start"] + 1, F.length(r["match_text"])) == r["match_text"]).alias("placed")).distinct().drop("text_key")


_PART = lambda k: f"nullif(regexp_extract(m, '{ART}', {k}), '')"
_SOLVED = f"""WITH {LATEST_ACT}, {_REFS},
k AS (SELECT refs.*, a.canonical_doc, {sql_law("trim(m || ' ' || snip)")} AS law, concat_ws('-', 'art' || {_PART(1)}, 'com' || {_PART(2)}, 'let' || {_PART(3)}, 'num' || {_PART(4)}) AS frag, {_PART(1)} AS art FROM refs LEFT JOIN act a USING (doc_id)),
z AS (SELECT *, CASE WHEN law IS NOT NULL THEN 'dynamic_parsing' WHEN art IS NOT NULL AND coalesce(canonical_doc, '') <> '' THEN 'contextual' ELSE 'unresolved' END AS how,
  CASE WHEN law IS NOT NULL THEN law || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END WHEN art IS NOT NULL AND coalesce(canonical_doc, '') <> '' THEN canonical_doc || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END END AS u FROM k)"""


@query(f"{_SOLVED} SELECT node_id AS source_node_id, m AS match_text, relation_type, coalesce(target, u) AS target_canonical_doc, u AS resolved_urn, CAST(CASE how WHEN 'dynamic_parsing' THEN 0.85 WHEN 'contextual' THEN 0.6 ELSE 0 END AS DOUBLE) AS confidence_score, how AS resolution_method, CAST(confidence AS DOUBLE) AS confidence FROM z")
def r07_extract_job(s: SparkSession, d: str) -> DataFrame:
    return _job(s, d).select("source_node_id", "match_text", "relation_type", "target_canonical_doc", "resolved_urn", "confidence_score", "resolution_method", "confidence")


@query(f"{_SOLVED} SELECT node_id AS source_node_id, m AS match_text, relation_type, count(*) AS n FROM z WHERE NOT EXISTS (SELECT 1 FROM z h WHERE h.how = 'contextual' AND h.node_id = z.node_id AND h.m = z.m AND h.relation_type = z.relation_type) GROUP BY ALL")
def r07_existing(s: SparkSession, d: str) -> DataFrame:
    """A job over nodes some of whose references (the contextual ones) are held already."""
    held = _job(s, d).where("resolution_method = 'contextual'")
    return _job(s, d, held).groupBy("source_node_id", "match_text", "relation_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_SOLVED} SELECT relation_type, coalesce(target, u) AS target_canonical_doc, count(*) AS n, round(avg(CAST(confidence AS DOUBLE)), 6) AS mean_confidence FROM z GROUP BY ALL")
def r06_targets(s: SparkSession, d: str) -> DataFrame:
    """Citations per relation type and target act."""
    return _job(s, d).groupBy("relation_type", "target_canonical_doc").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


_RESOLVED = rf"""WITH r AS (SELECT source_node_id, {sql_strip("destination_urn")} AS target, relation_type, arg_min(confidence, ref_id) AS confidence FROM (SELECT DISTINCT * FROM references_extracted) WHERE {sql_strip("coalesce(destination_urn, '')")} <> '' GROUP BY ALL),
q AS (SELECT *, CASE WHEN contains(target, '#') THEN trim(substr(target, instr(target, '#') + 1)) ELSE target END AS f FROM r),
h AS (SELECT *, CASE WHEN regexp_matches(f, '^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$') THEN concat_ws('/', 'art:' || nullif(regexp_extract(f, '^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$', 1), ''), 'c:' || nullif(regexp_extract(f, '^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$', 2), ''), 'lett:' || nullif(regexp_extract(f, '^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$', 3), ''), 'num:' || nullif(regexp_extract(f, '^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$', 4), '')) ELSE f END AS path FROM q),
n AS (SELECT canonical_path AS path, arg_min(node_id, (version_id, node_id)) AS target_node_id FROM nodes WHERE canonical_path IS NOT NULL GROUP BY 1)
SELECT source_node_id, target AS target_canonical_node, relation_type, target_node_id, confidence FROM h LEFT JOIN n USING (path)"""


@query(_RESOLVED)
def r08_resolve_job(s: SparkSession, d: str) -> DataFrame:
    refs = read(s, d, "references_extracted").select("ref_id", "source_node_id", F.lit(None).cast("string").alias("target_canonical_node"), C("destination_urn").alias("target_canonical_doc"), "relation_type", "confidence").distinct()
    return citations.resolution_job(refs, nodes(s, d), None, normalize_fragment=True)


@query(_RESOLVED.replace("LEFT JOIN n USING (path)", """LEFT JOIN n ON n.path = h.path AND NOT contains(target, '#')
LEFT JOIN (SELECT urn, canonical_path AS path, arg_min(node_id, (version_id, node_id)) AS node_id FROM nodes JOIN (SELECT DISTINCT doc_id, urn FROM acts WHERE urn IS NOT NULL) USING (doc_id) GROUP BY ALL) w ON contains(target, '#') AND w.path = h.path AND w.urn = trim(split_part(target, '#', 1))""").replace("target_node_id, confidence FROM h", "coalesce(target_node_id, w.node_id) AS target_node_id, confidence FROM h"))
def r08_scoped(s: SparkSession, d: str) -> DataFrame:
    """Edges of the citation graph with paths sought in the act that the target names."""
    refs = read(s, d, "references_extracted").select("ref_id", "source_node_id", F.lit(None).cast("string").alias("target_canonical_node"), C("destination_urn").alias("target_canonical_doc"), "relation_type", "confidence").distinct()
    acts = read(s, d, "acts").where("urn is not null").select("doc_id", C("urn").alias("canonical_doc")).distinct()
    return citations.resolution_job(refs, nodes(s, d), acts, normalize_fragment=True)


# --- versions, search, vectors -----------------------------------------------------------------------------------


@query("SELECT DISTINCT doc_id, canonical_path, version_id, true AS equal FROM nodes")
def v01_delta_roundtrip(s: SparkSession, d: str) -> DataFrame:
    made = deltas.version_deltas(nodes(s, d))
    return made.select("doc_id", "canonical_path", "version_id", (deltas.apply_delta("base", "delta_text") == C("updated")).alias("equal"))


@query("SELECT doc_id, canonical_path, version_id, lag(version_id) OVER (PARTITION BY doc_id, canonical_path ORDER BY version_id) AS base_version_id FROM (SELECT DISTINCT doc_id, canonical_path, version_id FROM nodes)")
def v03_version_bases(s: SparkSession, d: str) -> DataFrame:
    return deltas.version_deltas(nodes(s, d)).select("doc_id", "canonical_path", "version_id", "base_version_id")


@query(f"WITH {LATEST_ACT}, a AS (SELECT doc_id FROM act WHERE canonical_doc = 'dlgs:4545:1997'), v AS (SELECT max(version_id) AS version_id FROM document_versions WHERE doc_id IN (SELECT doc_id FROM a)) SELECT node_id, replace(canonical_path, '/', '_') AS sort_key, level FROM nodes WHERE version_id IN (SELECT version_id FROM v)")
def q04_tree(s: SparkSession, d: str) -> DataFrame:
    return lookups.tree(read(s, d, "acts"), read(s, d, "document_versions"), nodes(s, d), "dlgs:4545:1997").select("node_id", "sort_key", "level")


@query(f"""WITH e AS (SELECT DISTINCT source_node_id, {sql_strip("destination_urn")} AS target, relation_type FROM references_extracted WHERE {sql_strip("coalesce(destination_urn, '')")} <> ''),
x AS (SELECT source_node_id, count(*) AS n FROM (SELECT DISTINCT ref_id, source_node_id, destination_urn, relation_type FROM references_extracted) GROUP BY 1), y AS (SELECT source_node_id, count(*) AS n FROM e GROUP BY 1)
SELECT n.node_id, n.version_id, CAST(coalesce(x.n, 0) AS INTEGER) AS n_refs, CAST(coalesce(y.n, 0) AS INTEGER) AS n_resolved FROM (SELECT DISTINCT node_id, version_id FROM nodes) n LEFT JOIN x ON x.source_node_id = n.node_id LEFT JOIN y ON y.source_node_id = n.node_id""")
def q05_node_references(s: SparkSession, d: str) -> DataFrame:
    rows = nodes(s, d).select("node_id", "version_id").distinct()
    found = lookups.node_with_references(rows, read(s, d, "references_extracted"), r08_resolve_job(s, d))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return found.select("node_id", "version_id", size("refs").alias("n_refs"), size("resolved").alias("n_resolved"))


@query(f"WITH {CHAIN} SELECT n.node_id, coalesce(nullif(n.heading, ''), c.h) AS hierarchy_string FROM nodes n LEFT JOIN chain c USING (canonical_path)")
def q09_backfill(s: SparkSession, d: str) -> DataFrame:
    rows = nodes(s, d).select("node_id", "canonical_path", C("heading").alias("hierarchy_string"))
    return lookups.backfilled(rows).select("node_id", "hierarchy_string")


@query(r"SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pM\pN_]+'), 'depurazione') AND list_contains(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pM\pN_]+'), 'sanzione')")
def k02_fulltext(s: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(s)}/fts-{uuid.uuid4().hex}"
    lookups.build_index(read(s, d, "documents"), "doc_id", "text").write.parquet(path)
    return lookups.search_index(s.read.schema("token string, doc_id long").parquet(path), "doc_id", "Sanzione depurazione")


@query("""SELECT query_id, vec_id, round(score, 6) AS score FROM (SELECT q.vec_id AS query_id, r.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS score FROM embeddings q JOIN embeddings r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""")
def k03_cosine_topk(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(rows, rows.where(C("vec_id") % 50 == 0), 10).withColumn("score", F.round("score", 6))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))), 6) AS mirrored FROM embeddings")
def k03_cosine_columns(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "embeddings").select("vec_id", F.round(vector.norm(C("embedding")), 6).alias("norm"), F.round(vector.cosine(C("embedding"), F.reverse("embedding")), 6).alias("mirrored"))
