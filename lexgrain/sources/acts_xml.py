"""Parsers of act XML: a simple dialect and Akoma Ntoso, one row per file with its act and nodes.

Mixed content needs a real parser, so this is Python (Arrow batches of whole files, no shuffle).  A file that is not
well-formed is read by a recovering parser (`recover`), which closes what is open and leaves out what closes nothing;
a file without any element gives a row with parse_error and no nodes.  Comments and processing instructions are no text.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.functions import urn
from lexgrain.plans.scale import spread

AKN_NAMESPACE = "http://docs.oasis-open.org/legaldocml/ns/akn/"
# Where the FRBR metadata stand.
FRBR = {
    "urn": ("FRBRWork", "FRBRthis"), "work_urn": ("FRBRWork", "FRBRuri"), "expression_urn": ("FRBRExpression", "FRBRthis"), "manifestation_urn": ("FRBRManifestation", "FRBRthis"),
    "publication_date": ("FRBRWork", "FRBRdate"), "version_date": ("FRBRExpression", "FRBRdate"),
}
#: Deepest nesting that is serialised.
DEPTH = 20_000
DOC = "struct<canonical_doc:string,doc_type:string,number:int,year:int,title:string,version_tag:string,valid_from:string,valid_to:string,source_url:string,urn:string,work_urn:string,expression_urn:string,manifestation_urn:string,publication_date:string,version_date:string,authority:string>"
NODE = "struct<ordinal:int,node_type:string,label:string,canonical_path:string,sort_key:string,hierarchy_string:string,heading:string,text_raw:string,text_clean:string,text_hash:string,eid:string,level:int,text_xml_fragment:string,refs:array<struct<href:string,text:string>>>"


@dataclass(frozen=True)
class Tags:
    """Which elements become nodes and which subtrees are metadata."""

    # Element names of the two dialects.
    structural: frozenset = frozenset(
        ("article", "articolo", "paragraph", "comma", "clause", "section", "part", "chapter", "book", "annex", "allegato", "item", "point", "list")
    )
    metadata: frozenset = frozenset(
        (
            "meta", "identification", "publication", "classification", "lifecycle", "analysis", "references", "proprietary", "eli", "rdf", "FRBRWork", "FRBRExpression", "FRBRManifestation",
            "FRBRthis", "FRBRuri", "FRBRalias", "FRBRdate", "FRBRauthor", "FRBRcountry", "FRBRlanguage",
        )
    )
    #: Leave the text of nested structural elements out of a node's text.
    exclude_structural: bool = False

    def text(self, element: ET.Element) -> str:
        if not self.exclude_structural:
            return "".join(element.itertext())
        inner = [x for child in element for x in (("" if local(child.tag) in self.structural else self.text(child)), child.tail or "")]
        return (element.text or "") + "".join(inner)


def local(tag: object) -> str:
    return str(tag).rpartition("}")[2]


def clean(text: str) -> str:
    text = re.sub(r"[ \t]+", " ", re.sub(r"\r\n?", "\n", text))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def clean_inline(text: str) -> str:
    text = re.sub(r"\s+", " ", re.sub(r"[\x00-\x1f\x7f]", " ", text))
    return re.sub(r"\s+([.,;:])", r"\1", text).strip()


def _digits(value: str | None) -> int | None:
    return int(value) if value and value.isdigit() else None


def _node(out: list[dict], kind: str, label: str, path: str, raw: str, chain: str, heading: str | None = None, **more: object) -> None:
    cleaned = more.pop("cleaned", None)
    cleaned = clean(raw) if cleaned is None else cleaned
    digest = hashlib.sha256((cleaned or raw or "").encode()).hexdigest()
    base = {"eid": None, "level": None, "text_xml_fragment": None, "refs": []}
    out.append(
        base | {"ordinal": len(out), "node_type": kind, "label": label, "canonical_path": path, "sort_key": path.replace("/", "_"), "hierarchy_string": chain, "heading": heading, "text_raw": raw, "text_clean": cleaned, "text_hash": digest} | more
    )


#: Levels below an article and below an annex: element, path prefix, default id, label, name in the chain.
ARTICLE_LEVELS = [("comma", "c", "1", "comma", "Comma"), ("lettera", "lett", "a", "lett.", "Lettera"), ("numero", "num", "1", "num.", "Numero")]
ANNEX_LEVELS = [("tabella", "tabella", "1", "Tabella", "Tabella")]


def _all_text(element: ET.Element | None) -> str:
    return "" if element is None else " ".join(element.itertext())


def _descend(out: list[dict], parent: ET.Element, path: str, chain: str, levels: list) -> None:
    if not levels:
        return
    (tag, prefix, default, label, name), *deeper = levels
    for child in parent.findall(tag):
        own = child.get("id") or default
        below, named = f"{path}/{prefix}:{own}", f"{chain} > {name} {own}"
        _node(out, tag, f"{label} {own}", below, _all_text(child), named)
        _descend(out, child, below, named, deeper)


def parse_simple(root: ET.Element) -> tuple[dict, list[dict]]:
    """Act and nodes of the simple dialect: preamble, articles, annexes, notes, in this order."""
    meta = root.find("meta")
    said = lambda name: (meta.findtext(name) or None) if meta is not None else None
    kind = (said("doc_type") or "altro").lower()
    doc = {"doc_type": kind, "number": _digits(said("number")), "year": _digits(said("year")), "canonical_doc": ":".join([kind, said("number") or "0", said("year") or "0"])}
    doc |= {k: said(k) for k in ("title", "version_tag", "valid_from", "valid_to", "source_url")}
    out: list[dict] = []
    if (preamble := root.find("preambolo")) is not None:
        _node(out, "atto_preambolo", "Preambolo", "atto/preambolo", _all_text(preamble), "Atto > Preambolo")
    for article in root.findall("articolo"):
        own = article.get("id") or "1"
        heading = clean(article.findtext("rubrica") or "") or None
        chain = f"Articolo {own}" + (f" ({heading})" if heading else "")
        _node(out, "articolo", f"Art. {own}", f"art:{own}", _all_text(article.find("testo")), chain, heading)
        _descend(out, article, f"art:{own}", chain, ARTICLE_LEVELS)
    for annex in root.findall("allegato"):
        own = annex.get("id") or "A"
        _node(out, "allegato", f"Allegato {own}", f"allegato:{own}", _all_text(annex), f"Allegato {own}")
        _descend(out, annex, f"allegato:{own}", f"Allegato {own}", ANNEX_LEVELS)
    for note in root.findall("nota"):
        own = note.get("id") or "1"
        _node(out, "nota", f"nota {own}", f"nota:{own}", _all_text(note), f"Nota {own}")
    return doc, out


_AKN = re.compile(urn.AKN)


def frbr_of(root: ET.Element) -> dict[str, str | None]:
    """URNs and dates of the FRBR metadata of an Akoma document; the first of each kind counts, '' is null."""
    said: dict[tuple[str, str], str] = {}
    for part in root.iter():
        if local(part.tag) in ("FRBRWork", "FRBRExpression", "FRBRManifestation"):
            for x in part:
                said.setdefault((local(part.tag), local(x.tag)), x.get("value") or x.get("date") or "")
    return {name: said.get(key) or None for name, key in FRBR.items()}


def parse_akoma(root: ET.Element, tags: Tags = Tags()) -> tuple[dict, list[dict]]:  # noqa: B008
    """Act and nodes of an Akoma Ntoso document: structural elements with text, in preorder."""
    doc: dict = frbr_of(root)
    m = _AKN.search(doc["urn"] or "")
    kind = m[2].lower() if m else "altro"
    doc |= {"doc_type": kind, "number": int(m[5]) if m else None, "year": int(m[4][:4]) if m else None, "authority": m[3] if m else None}
    doc |= {"canonical_doc": f"{kind}:{m[5]}:{m[4][:4]}" if m else (doc["urn"] or "altro:0:0"), "version_tag": doc["expression_urn"] or doc["version_date"]}
    out: list[dict] = []
    stack = [(root, "", 0)]
    while stack:  # preorder without recursion, so depth has no limit
        element, above, level = stack.pop()
        tag = local(element.tag)
        if tag in tags.metadata:
            continue
        own = element.get("eId") or element.get("id")
        segment = f"{tag}:{own}" if own else tag
        path = f"{above}/{segment}" if above else segment
        if tag in tags.structural:
            raw = tags.text(element).strip()
            cleaned = clean_inline(raw)
            if cleaned:
                refs = [(x.get("href") or "", "".join(x.itertext()).strip()) for x in element.iter() if local(x.tag) == "ref"]
                refs = [{"href": h, "text": t} for h, t in refs if h or t]
                fragment = ET.tostring(element, encoding="unicode")
                _node(out, tag, segment, path, raw, path.replace("/", " > "), cleaned=cleaned, eid=own, level=level, text_xml_fragment=fragment, refs=refs)
        stack += [(child, path, level + 1) for child in reversed(element)]
    return doc, out


def is_akoma(root: ET.Element) -> bool:
    return local(root.tag).lower() == "akomantoso" or str(root.tag).startswith("{" + AKN_NAMESPACE)


_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<[?!][^>]*(?:>|\Z)|<(?P<close>/)?(?P<name>[A-Za-z_][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*?)(?P<void>/)?>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([A-Za-z_][^\s=/>]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def recovered(text: str) -> ET.Element | None:
    """The tree of a text that is not well-formed, None if it holds no element.

    An end tag closes all that stands open inside its element and is left out where no such element is open; what is
    open at the end is closed there; a '<' or '&' that begins nothing is text; text outside the first element is lost.
    """
    builder, stack, at, begun = ET.TreeBuilder(), [], 0, False
    spaces: dict[str, str] = {}
    for m in _MARKUP.finditer(text):
        if stack:
            builder.data(html.unescape(text[at : m.start()]) + (m["raw"] or ""))
        at = m.end()
        name = m["name"]
        if not name or (begun and not stack):
            continue
        if m["close"]:
            while name in stack:
                last = stack.pop()
                builder.end(last)
                if last == name:
                    break
            continue
        given = {x[1]: html.unescape(x[2] or x[3] or x[4] or "") for x in _ATTRIBUTE.finditer(m["rest"])}
        spaces |= {k: v for k, v in given.items() if k == "xmlns"}
        full = f"{{{spaces['xmlns']}}}{name}" if "xmlns" in spaces and ":" not in name else name.rpartition(":")[2]
        builder.start(full, {k.rpartition(":")[2]: v for k, v in given.items() if not k.startswith("xmlns")})
        begun = True
        if m["void"]:
            builder.end(full)
        else:
            stack.append(name)
    if not begun:
        return None
    if stack:
        builder.data(html.unescape(text[at:]))
    for name in reversed(stack):
        builder.end(name)
    return builder.close()


def _root(content: bytes | str | None, recover: bool) -> ET.Element:
    try:
        return ET.fromstring(content or "")
    except ET.ParseError:
        text = content.decode("utf-8", "replace") if isinstance(content, bytes) else content or ""
        root = recovered(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)) if recover else None
        if root is None:
            raise
        return root


def parse(content: bytes | str | None, tags: Tags = Tags(), recover: bool = True) -> tuple[dict | None, list[dict], str | None]:  # noqa: B008
    """(act, nodes, error) of one file; never raises."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), DEPTH))  # the serialiser recurses
    try:
        root = _root(content, recover)
        doc, nodes = parse_akoma(root, tags) if is_akoma(root) else parse_simple(root)
        return doc, nodes, None
    except Exception as e:
        return None, [], f"{type(e).__name__}: {e}"[:500]


def _filled(value: dict | None, names: list[str]) -> dict | None:
    return None if value is None else {k: value.get(k) for k in names}


_DOC_NAMES, _NODE_NAMES = (re.findall(r"(?:^struct<|,)(\w+):", re.sub(r"array<.*", "array", t)) for t in (DOC, NODE))


def parsed(files: DataFrame, key: str = "path", content: str = "content", tags: Tags = Tags(), recover: bool = True) -> DataFrame:  # noqa: B008
    """key, doc, nodes, parse_error of each file (content: binary or string)."""
    picked = spread(files.select(F.col(key).alias("key"), F.col(content).alias("content")), "key")
    kind = picked.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):  # trees and rows of few files are held at once
                part = batch.iloc[at : at + 64]
                rows = [(k, *parse(c, tags, recover)) for k, c in zip(part["key"], part["content"], strict=True)]
                yield pd.DataFrame(
                    {"key": [r[0] for r in rows], "doc": [_filled(r[1], _DOC_NAMES) for r in rows], "nodes": [[_filled(n, _NODE_NAMES) for n in r[2]] for r in rows], "parse_error": [r[3] for r in rows]}
                )

    return picked.mapInPandas(work, f"key {kind}, doc {DOC}, nodes array<{NODE}>, parse_error string").withColumnRenamed("key", key)


def element_text(fragment: str | None) -> str | None:
    """All text nodes of an element in document order, joined by one space; null for what cannot be parsed."""
    try:
        return " ".join(ET.fromstring(fragment or "").itertext())
    except ET.ParseError:
        return None


def element_texts(fragments: Column) -> Column:
    """element_text of every value."""
    return F.pandas_udf(lambda batch: batch.map(element_text), "string")(fragments)


def root_tag(xml: Column) -> Column:
    """Lower-case name of the first element, '' if there is none."""
    return F.lower(F.regexp_extract(xml, r"(?s)^(?:[\s\x{FEFF}]|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)*<([A-Za-z_][^\s/>]*)", 1))


def dialect(xml: Column) -> Column:
    return F.when(F.contains(root_tag(xml), F.lit("akoma")), "akoma").when(root_tag(xml) != "", "simple")


def frbr(xml: Column) -> Column:
    """STRUCT of the FRBR metadata of an Akoma document; all null for a text that cannot be parsed."""

    def work(batch: pd.Series) -> pd.DataFrame:
        found = []
        for content in batch:
            try:
                found.append(frbr_of(ET.fromstring(content or "")))
            except ET.ParseError:
                found.append(dict.fromkeys(FRBR))
        return pd.DataFrame(found, columns=[*FRBR], dtype=object)

    return F.pandas_udf(work, ", ".join(f"{name} string" for name in FRBR))(xml)
