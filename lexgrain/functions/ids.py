"""Identifiers and paths as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """The value, null if it is ''."""
    return F.nullif(c, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_sha(c: Column) -> Column:
    """Hex sha256 of a text's UTF-8 bytes."""
    return F.sha2(c, 256)


def canonical_doc(kind: Column, number: Column, year: Column) -> Column:
    """kind:number:year, with 0 for a missing part."""
    zero = lambda c: F.coalesce(filled(c.cast("string")), F.lit("0"))
    return F.concat_ws(":", zero(kind), zero(number), zero(year))


def node_id(doc: Column, version: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws(":", doc, version.cast("string"), path), 256)


def node_ref(doc: Column, article: Column, comma: Column, letter: Column, number: Column) -> Column:
    """doc#art:X/c:Y/lett:Z/num:N without the missing parts; no # if all are missing."""
    parts = [F.concat(F.lit(p), filled(c)) for p, c in (("art:", article), ("c:", comma), ("lett:", letter), ("num:", number))]
    tail = F.concat_ws("/", *parts)
    return F.when(tail == "", doc).otherwise(F.concat(doc, F.lit("#"), tail))


def sort_key(path: Column) -> Column:
    return F.translate(path, "/", "_")


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def node_type(path: Column) -> Column:
    """Tag of the last path segment."""
    return F.substring_index(last_segment(path), ":", 1)


def fragment_path(fragment: Column) -> Column:
    """art5-com2 style fragments as paths: art:5/c:2; other texts as they are."""
    form = r"^art(.+?)(?:-com(.+?))?(?:-let(.+?))?(?:-num(.+?))?$"
    part = lambda name, k: F.when(F.regexp_extract(fragment, form, k) != "", F.concat(F.lit(name), F.regexp_extract(fragment, form, k)))
    return F.when(fragment.rlike(form), F.concat_ws("/", part("art:", 1), part("c:", 2), part("lett:", 3), part("num:", 4))).otherwise(fragment)
