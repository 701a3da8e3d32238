"""Text cleaning, context lines and dates as Column expressions.

Patterns use (?U) so that white space, digits and case are Unicode's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexgrain.functions.ids import filled, let

#: Nothing longer goes into an embedding; texts of at most LEAST_CHARS are left out.
EMBED_CHARS, LEAST_CHARS = 2000, 10
NO_TITLE = "Documento Sconosciuto"

# Path segments that name no level of the act.
TECHNICAL = ["akomantoso", "akomanotoso", "akoma", "akn", "it", "act", "main", "main.xml"]
# Segment names and how they read with and without an id.
LEVELS = [
    (["art", "articolo", "article"], "Art. ", "Art."),
    (["com", "comma", "paragraph"], "Comma ", "Comma"),
    (["let", "lett", "letter", "lettera"], "lett. ", "Lettera"),
    (["num", "numero", "item", "number"], "n. ", "Numero"),
    (["capo", "chapter"], "Capo ", "Capo"),
    (["tit", "titolo", "title"], "Titolo ", "Titolo"),
]
# Italian months.
MONTHS = ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"]


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """LF line ends, single blanks, at most one empty line in a row, no white space at the ends."""
    lines = F.regexp_replace(c, r"\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(lines, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def clean_inline(c: Column) -> Column:
    """Control characters and runs of white space to one blank, none before . , ; :"""
    one = F.regexp_replace(F.regexp_replace(c, r"[\x00-\x1F\x7F]", " "), r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(one, r"\s+([.,;:])", "$1"))


def content_hash(cleaned: Column, raw: Column) -> Column:
    """sha256 of the cleaned text, else of the raw one, else of ''."""
    return F.sha2(F.coalesce(filled(cleaned), filled(raw), F.lit("")), 256)


def _pretty(segment: Column) -> Column:
    def named(x: Column) -> Column:
        base, rest = x["base"], x["rest"]
        out = F.when(rest != "", F.concat_ws(" ", base, rest)).otherwise(base)
        for names, with_id, alone in reversed(LEVELS):
            out = F.when(base.isin(names), F.when(rest != "", F.concat(F.lit(with_id), rest)).otherwise(alone)).otherwise(out)
        return out

    at = F.instr(segment, ":")
    rest = F.trim(F.when(at > 0, F.substring(segment, at + 1, F.length(segment))).otherwise(""))
    return let(F.struct(F.trim(F.lower(F.substring_index(segment, ":", 1))).alias("base"), rest.alias("rest")), named)


def hierarchy(path: Column) -> Column:
    """Readable chain of a canonical path; null for a path without segments."""
    technical = lambda p: F.lower(p).isin(TECHNICAL)

    def chain(parts: Column) -> Column:
        chosen = F.when(F.exists(parts, lambda p: ~technical(p)), F.filter(parts, lambda p: ~technical(p))).otherwise(parts)
        return F.when(F.size(parts) > 0, F.array_join(F.transform(chosen, _pretty), " > "))

    return let(F.filter(F.split(path, "/"), lambda p: p != ""), chain)


def export_context(chain: Column) -> Column:
    """A hierarchy string without technical tokens; '' for null."""
    short = F.replace(F.replace(F.coalesce(chain, F.lit("")), F.lit("body > "), F.lit("")), F.lit("main > "), F.lit(""))
    tokens = F.regexp_replace(short, r"akoma[a-zA-Z]* >|art_|para_|chp_|point_|__", "")
    return strip(F.replace(tokens, F.lit(" ."), F.lit(".")))


def source_name(title: Column, canonical_doc: Column, known: Column) -> Column:
    """The cleaned title if it has more than three characters, else the act's name, else a fixed text."""
    titled = F.when(F.length(title) > 3, F.translate(strip(title), "_", " "))
    return F.when(known, F.coalesce(titled, canonical_doc)).otherwise(F.lit(NO_TITLE))


def italian_date(c: Column) -> Column:
    """The first D/M/YYYY, else the first D <month> YYYY; null if that is no date."""
    slash = r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"
    named = rf"(?i)\b(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})\b"
    month = F.create_map(*[x for k, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(str(k)))])
    day = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    part = lambda p, k: F.regexp_extract(c, p, k)
    by_name = F.when(c.rlike(named), day(part(named, 3), F.element_at(month, F.lower(part(named, 2))), part(named, 1)))
    month_zero = F.try_to_number(part(slash, 2), F.lit("99")) == 0
    by_slash = day(part(slash, 3), part(slash, 2), part(slash, 1))
    return F.when(c.rlike(slash) & ~F.coalesce(month_zero, F.lit(False)), by_slash).otherwise(by_name)


def snippet(text: Column, start: Column, width: int = 200) -> Column:
    """Up to `width` characters on both sides of a 0-based place; never empty."""
    low = F.greatest(F.lit(0), start - width)
    cut = strip(F.substring(text, low + 1, F.least(F.length(text), start + width) - low))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("(testo vuoto)")).when(cut == "", F.left(text, F.lit(400))).otherwise(cut)


def is_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def compression_ratio(base: Column, delta: Column) -> Column:
    """1 - length(delta) / length(base), at least 0; 0 for an empty base."""
    return F.when(F.coalesce(F.length(base), F.lit(0)) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - F.length(delta) / F.length(base)))


def embedding_text(context: Column, text: Column) -> Column:
    """passage: context text, cut; null for texts that are too short."""
    body = strip(F.coalesce(text, F.lit("")))
    whole = strip(F.concat(F.lit("passage: "), strip(F.coalesce(context, F.lit(""))), F.lit(" "), body))
    return F.when(F.length(body) > LEAST_CHARS, F.left(whole, F.lit(EMBED_CHARS)))


def metadata(source: Column, source_id: Column, url: Column, text: Column) -> Column:
    """Struct of the fields kept beside a vector, each cut to its length."""
    cut = lambda c, n: F.left(F.coalesce(c, F.lit("")), F.lit(n))
    return F.struct(cut(source, 200).alias("source"), cut(source_id, 100).alias("source_id"), cut(url, 500).alias("url"), cut(strip(text), 1500).alias("original_text"))
