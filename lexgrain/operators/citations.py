"""Citations in running text, and their resolution: one narrow pass of built-in expressions per text.

All places of a pattern come from split() and regexp_extract_all() over the same pattern: the pieces between
matches and the matches themselves have cumulative lengths that are the offsets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexgrain.functions import ids, text, urn
from lexgrain.plans.scale import spread

# Kinds of act and the forms of their citation (number, year), in order of output.
ACTS = [
    ("dlgs", r"(?i)decreto legislativo n\.\s*(\d+)\s+del\s+(\d{4})"),
    ("dlgs", r"(?i)d\.lgs\.\s*(\d+)/(\d{4})"),
    ("dpr", r"(?i)d\.?p\.?r\.?\s*(\d+)/(\d{4})"),
    ("l", r"(?i)legge\s*(\d+)/(\d{4})"),
    ("l", r"(?i)l\.\s*n\.\s*(\d+)/(\d{4})"),
]
#: An article citation within so many characters of an act raises its confidence.
NEAR = 80
@dataclass(frozen=True)
class Patterns:
    """What is taken for a citation: aliases of acts, forms of act citations, phrases of relation types."""

    aliases: dict[str, str] = field(default_factory=lambda: dict(urn.ALIASES))
    acts: tuple[tuple[str, str], ...] = tuple(ACTS)
    relations: tuple[tuple[str, str], ...] = tuple(urn.RELATIONS)


REFERENCE = (
    "struct<kind:int,start:int,match_text:string,raw_snippet:string,target_canonical_doc:string,target_article:string,target_comma:string,"
    "target_letter:string,target_number:string,confidence:double,method:string>"
)


def places(c: Column, form: str, groups: int) -> Column:
    """ARRAY<STRUCT<start, match, groups ARRAY<STRING>>> of all matches; start counts characters from 0."""
    add = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    groups_of = [F.regexp_extract_all(c, F.lit(form), F.lit(k)) for k in range(1, groups + 1)]
    found = F.struct(F.regexp_extract_all(c, F.lit(form), F.lit(0)).alias("m"), F.transform(F.split(c, form, -1), F.length).alias("between"), *[g.alias(f"g{k}") for k, g in enumerate(groups_of)])

    def placed(f: Column) -> Column:
        lengths = F.transform(f["m"], F.length)
        start = lambda i: add(F.slice(f["between"], F.lit(1), i + 1)) + add(F.slice(lengths, F.lit(1), i))
        parts = lambda i: F.array(*[F.get(f[f"g{k}"], i) for k in range(groups)])
        return F.transform(f["m"], lambda m, i: F.struct(start(i).alias("start"), m.alias("match"), parts(i).alias("groups")))

    nothing = F.array().cast("array<struct<start:int,match:string,groups:array<string>>>")
    return F.when(c.rlike(form), ids.let(found, placed)).otherwise(nothing)


def _reference(kind: int, start: Column, match: Column, around: Column, doc: Column, confidence: Column, method: str, parts: list[Column] | None = None) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(F.lit(kind), start.cast("int"), match, around, doc, *(parts or [nothing] * 4), confidence.cast("double"), F.lit(method)).cast(REFERENCE)


def _act_at(c: Column, k: int, kind: str) -> Callable[[Column], Column]:
    """The reference made of a match of form k of an act citation."""

    def made(m: Column) -> Column:
        low = F.greatest(F.lit(0), m["start"] - NEAR)
        window = F.substring(c, low + 1, m["start"] + F.length(m["match"]) + NEAR - low)
        sure = F.when(window.rlike(urn.ARTICLE), 0.9).otherwise(0.6)
        doc = F.concat_ws(":", F.lit(kind), m["groups"][0], m["groups"][1])
        return _reference(k, m["start"], m["match"], text.snippet(c, m["start"]), doc, sure, "regex:v1")

    return made


def found_references(c: Column, patterns: Patterns = Patterns()) -> Column:  # noqa: B008
    """ARRAY of references in a text: aliases, then acts by form and place, then articles by place."""
    out = []
    for k, (alias, target) in enumerate(patterns.aliases.items()):
        at = F.instr(F.lower(c), alias.lower()) - 1
        one = F.array(_reference(k, at, F.lit(alias), text.snippet(c, at), F.lit(target), F.lit(0.6), "alias:v1"))
        out.append(F.when(at >= 0, one).otherwise(F.array().cast(f"array<{REFERENCE}>")))
    for k, (kind, form) in enumerate(patterns.acts, len(patterns.aliases)):
        out.append(F.transform(places(c, form, 2), _act_at(c, k, kind)))
    articles = places(c, urn.ARTICLE, 4)
    last = len(patterns.aliases) + len(patterns.acts)
    out.append(
        F.transform(
            articles,
            lambda m: _reference(last, m["start"], m["match"], text.snippet(c, m["start"]), F.lit(None).cast("string"), F.lit(0.4), "regex:v1", [ids.filled(m["groups"][k]) for k in range(4)]),
        )
    )
    return F.concat(*out)


def extract(nodes: DataFrame, text_col: str = "text_content", key: str = "node_id", patterns: Patterns = Patterns(), keep: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """key, ordinal and the columns of each reference found in a text, with the relation type of the whole text.

    The columns of `keep` come along.
    """
    c = F.coalesce(F.col(text_col), F.lit(""))
    keys = list(dict.fromkeys([key, *(["doc_id"] if "doc_id" in nodes.columns else []), *keep]))
    nodes = spread(nodes.select(*dict.fromkeys([*keys, text_col])), key, text_col)
    found = nodes.select(*keys, F.posexplode(found_references(c, patterns)).alias("ordinal", "r"), urn.relation(c, list(patterns.relations)).alias("relation_type"))
    fields = [f for f in ("start", "match_text", "raw_snippet", "target_canonical_doc", "target_article", "target_comma", "target_letter", "target_number", "confidence", "method")]
    return found.select(*dict.fromkeys(keys), "ordinal", *[F.col(f"r.{f}").alias(f) for f in fields], "relation_type")


def extract_text(spark, value: str) -> DataFrame:  # noqa: ANN001
    """References of one text given on demand."""
    return extract(spark.createDataFrame([("", value)], "node_id string, text_content string")).drop("node_id")


def extraction_job(nodes: DataFrame, acts: DataFrame, existing: DataFrame | None = None, strict_reference: bool = True, dedup_within_run: bool = False, patterns: Patterns = Patterns(), keep: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """References of all nodes with their resolved URN, score and method.

    A reference that `existing` already holds (same source, text and relation) is left out; within one run repeats
    are kept unless `dedup_within_run`.  Acts are one row each and joined by key; Catalyst picks the join.
    """
    found = extract(nodes, patterns=patterns, keep=keep).where(F.col("match_text") != "").join(acts.select("doc_id", "canonical_doc"), "doc_id", "left")
    solved = found.withColumn("u", urn.resolve(F.col("match_text"), F.col("raw_snippet"), F.col("canonical_doc"), strict_reference, patterns.aliases))
    out = solved.select(
        F.col("node_id").alias("source_node_id"), "doc_id", "ordinal", "raw_snippet", "match_text", "relation_type",
        F.coalesce("target_canonical_doc", "u.urn").alias("target_canonical_doc"), "target_article", "target_comma", "target_letter", "target_number",
        F.when(F.col("target_article").isNotNull() & F.col("target_canonical_doc").isNotNull(), ids.node_ref(F.col("target_canonical_doc"), *[F.col(f"target_{p}") for p in ("article", "comma", "letter", "number")])).alias("target_canonical_node"),
        "confidence", "method", F.col("u.urn").alias("resolved_urn"), F.col("u.score").alias("confidence_score"), F.col("u.method").alias("resolution_method"), *keep,
    )
    key = ["source_node_id", "match_text", "relation_type"]
    if dedup_within_run:
        first = Window.partitionBy(*key).orderBy("ordinal")
        out = out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return out.join(existing.select(*key).distinct(), key, "left_anti") if existing is not None else out


def resolution_log(job: DataFrame) -> DataFrame:
    """Log rows of an extraction job."""
    return job.select(F.col("match_text").alias("original_text"), "resolved_urn", "confidence_score", "resolution_method", F.col("doc_id").alias("document_id"))


def resolution_job(references: DataFrame, nodes: DataFrame, acts: DataFrame | None, normalize_fragment: bool = False) -> DataFrame:
    """source_node_id, target_canonical_node, relation_type, target_node_id, confidence: the edges of the citation graph.

    The part of a target after # (or all of it) is looked up as a path; of several nodes with that path the one of
    the lowest version and id counts.  The first reference (by ref_id) of each (source, target, relation) stands.
    The path of a target with # is sought in the act before # only (`acts`: doc_id, canonical_doc, one row each); without
    acts (None) it is sought in any act, as is a path that names none.
    """
    target = text.strip(F.coalesce("target_canonical_node", "target_canonical_doc", F.lit("")))
    named = references.withColumn("target", target).where("target <> ''")
    first = named.groupBy("source_node_id", "target", "relation_type").agg(F.min(F.struct("ref_id", "confidence"))["confidence"].alias("confidence"))
    at = F.instr("target", "#")
    path = text.strip(F.when(at > 0, F.substring(F.col("target"), at + 1, F.length("target"))).otherwise(F.col("target")))
    looked = first.withColumn("path", ids.fragment_path(path) if normalize_fragment else path)
    known = nodes.where(F.col("canonical_path").isNotNull())
    best = F.min(F.struct("version_id", "node_id"))["node_id"].alias("target_node_id")
    paths = known.groupBy(F.col("canonical_path").alias("path")).agg(best)
    if acts is None:
        joined = looked.join(paths, "path", "left")
    else:
        scoped = known.join(acts.select("doc_id", F.col("canonical_doc").alias("act")), "doc_id").groupBy("act", F.col("canonical_path").alias("path")).agg(best)
        named = looked.withColumn("act", F.when(at > 0, text.strip(F.substring_index("target", "#", 1))))
        joined = named.where("act is not null").join(scoped, ["act", "path"], "left").drop("act").unionByName(named.where("act is null").drop("act").join(paths, "path", "left"))
    return joined.select("source_node_id", F.col("target").alias("target_canonical_node"), "relation_type", "target_node_id", "confidence")


def merge_edges(held: DataFrame, fresh: DataFrame) -> DataFrame:
    """Edges by primary key, fresh ones replacing held ones."""
    key = ["source_node_id", "target_canonical_node", "relation_type"]
    both = held.withColumn("_run", F.lit(0)).unionByName(fresh.withColumn("_run", F.lit(1)))
    return both.groupBy(*key).agg(F.max(F.struct("_run", "target_node_id", "confidence")).alias("e")).select(*key, "e.target_node_id", "e.confidence")
