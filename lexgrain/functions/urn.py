"""Names of acts: aliases, dynamic citations, URNs, as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexgrain.functions.ids import filled, let

# Aliases and the acts they name, in order of precedence.
ALIASES = {"TUIR": "dpr:917:1986", "Statuto del contribuente": "l:212:2000"}
# Relation types and the phrases that show them, in order of precedence.
RELATIONS = [
    ("AMENDS", "modificato da|sostituito da|inserito da"),
    ("REPEALS", "abrogato"),
    ("DEROGATES", "in deroga a"),
    ("CITES", "ai sensi di|a norma di|ex art"),
]
# Fixed value: an article citation (article, comma, letter, number).
ARTICLE = r"(?i)art(?:icolo|\.)\s*(\d+[a-z-]*)(?:,\s*comma\s*(\d+[a-z-]*))?(?:,\s*lettera\s*([a-z]))?(?:,\s*n\.\s*(\d+))?"
# Fixed value: kind of act, number and year of a law cited in running text.
LAW = (
    r"(?i)(legge|l\.|d\.lgs\.?|decreto legislativo|d\.l\.|decreto legge|d\.p\.r\.{more})(?:\s+(?:regionale|provinciale))?"
    r"[^0-9]*?\b(\d{{1,4}})\b(?:[^0-9]{{1,15}})?\b(\d{{2,4}})\b"
)
# Fixed value: an Akoma Ntoso URN (class, kind, authority, date, number).
AKN = r"(?i)/akn/[a-z]{2}/(act|bill|doc)/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d+)(?:/|$)"
#: Two-digit years below it belong to this century.
PIVOT = 50


def relation(text: Column, relations: list[tuple[str, str]] = RELATIONS) -> Column:
    """Relation type of a whole text; CITES if nothing says otherwise."""
    out = F.lit("CITES")
    for name, form in reversed(relations):
        out = F.when(text.rlike(f"(?i){form}"), name).otherwise(out)
    return out


def alias_target(text: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Act named by the first alias of the list that the text holds, else null."""
    low, out = F.lower(text), F.lit(None).cast("string")
    for alias, target in reversed(aliases.items()):
        out = F.when(F.contains(low, F.lit(alias.lower())), target).otherwise(out)
    return out


def law_urn(text: Column, strict_reference: bool = True) -> Column:
    """URN of the first law cited in a text, else null.

    With `strict_reference` a decree-law reads as a law and an undotted DPR is not seen; without it both are told apart.
    """
    form = LAW.format(more="" if strict_reference else "|dpr")
    return let(F.regexp_extract(text, form, 0), lambda m: _law_name(m, form, strict_reference))


def _law_name(match: Column, form: str, strict_reference: bool) -> Column:
    """URN made of a matched citation; null for ''."""
    part = lambda k: F.regexp_extract(match, form, k)

    def named(kind: Column) -> Column:
        has = lambda *w: reduce(or_, (F.contains(kind, F.lit(x)) for x in w))
        law, legislative = (has("legge", "l."), "legge"), (has("d.lgs", "legislativo"), "decreto.legislativo")
        decree_law, president = (has("d.l", "decreto legge"), "decreto.legge"), (has("d.p.r", "dpr"), "decreto.presidente.repubblica")
        name = F.lit("legge")
        for test, value in reversed([law, legislative, decree_law, president] if strict_reference else [legislative, decree_law, president, law]):
            name = F.when(test, value).otherwise(name)
        return name

    full = let(part(3), lambda y: F.when(F.length(y) == 2, F.concat(F.when(y.cast("int") < PIVOT, "20").otherwise("19"), y)).otherwise(y))
    return F.when(match != "", F.concat(F.lit("urn:nir:stato:"), let(F.lower(part(1)), named), F.lit(":"), full, F.lit(";"), part(2)))


def with_fragment(base: Column, article: Column, comma: Column, letter: Column, number: Column) -> Column:
    """base#artX-comY-letZ-numN without the missing parts."""
    tail = F.concat_ws("-", *[F.concat(F.lit(p), filled(c)) for p, c in (("art", article), ("com", comma), ("let", letter), ("num", number))])
    return F.when(tail == "", base).otherwise(F.concat(base, F.lit("#"), tail))


def article_parts(text: Column) -> list[Column]:
    """Article, comma, letter, number of the first article citation; nulls where missing."""
    return [filled(F.regexp_extract(text, ARTICLE, k)) for k in range(1, 5)]


def akn_parts(urn: Column) -> dict[str, Column]:
    """doc_type, number, act_year, authority of an Akoma Ntoso URN; doc_type is altro if it has another form."""
    part = lambda k: filled(F.regexp_extract(urn, AKN, k))
    return {
        "doc_type": F.coalesce(F.lower(part(2)), F.lit("altro")), "number": F.try_to_number(part(5), F.lit("9" * 18)).cast("long"),
        "act_year": F.left(part(4), F.lit(4)).cast("int"), "authority": part(3),
    }


def nir_parts(urn: Column) -> dict[str, Column]:
    """doc_type, act_year, number of a URN that ends in type:YYYY;N."""
    form = r"([a-z.]+):(\d{4})[^;]*;(\d+)"
    part = lambda k: filled(F.regexp_extract(urn, form, k))
    return {"doc_type": part(1), "act_year": part(2).cast("int"), "number": F.try_to_number(part(3), F.lit("9" * 18)).cast("long")}


def resolve(match: Column, around: Column, own_act: Column, strict_reference: bool = True, aliases: dict[str, str] = ALIASES) -> Column:
    """STRUCT<urn, score, method> of a citation: explicit URN, law in the text, alias, article of the own act, else unresolved."""
    both = F.trim(F.concat_ws(" ", match, around))
    law = law_urn(both) if strict_reference else F.coalesce(law_urn(match, False), law_urn(around, False))
    made = lambda urn, score, method: F.struct(urn.alias("urn"), F.lit(score).alias("score"), F.lit(method).alias("method"))

    def chosen(known: Column) -> Column:
        parts = [known[p] for p in ("article", "comma", "letter", "number")]
        return (
            F.when(F.contains(match, F.lit("urn:")), made(F.regexp_extract(match, r"(?U)(\S+)", 1), 1.0, "explicit"))
            .when(known["law"].isNotNull(), made(with_fragment(known["law"], *parts), 0.85, "dynamic_parsing"))
            .when(known["alias"].isNotNull(), made(with_fragment(known["alias"], *parts), 0.8, "alias"))
            .when(parts[0].isNotNull() & (F.coalesce(own_act, F.lit("")) != ""), made(with_fragment(own_act, *parts), 0.6, "contextual"))
            .otherwise(made(F.lit(None).cast("string"), 0.0, "unresolved"))
        )

    named = zip(article_parts(match), ("article", "comma", "letter", "number"), strict=True)
    return let(F.struct(law.alias("law"), alias_target(both, aliases).alias("alias"), *[c.alias(n) for c, n in named]), chosen)
