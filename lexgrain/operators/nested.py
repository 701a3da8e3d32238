"""Nested document records to linked flat tables.

A record holds an array of nodes, each with a path, an XML fragment, a text and an array of references.
It becomes rows that name their parent: `records`, `nodes` and `refs`.  Parents are found in one narrow
pass over the records (no shuffle): the structural index of the fragments gives the span of every element,
and a node is enclosed by the nearest listed node on its path whose spans hold the node's own element.

Defined results: a null or empty array yields no rows; a null node keeps its position and has parent -1;
a node without a path has parent -1; repeated records yield their rows once per record as delivered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.operators.structure import index_elements, span_hashes
from lexgrain.plans.scale import spread

#: Fragments are indexed in buffers of about this many bytes, which bounds a worker's memory.
BUFFER_BYTES = 2_000_000


def _strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 buffer and bounds of a string array, nulls as ''."""
    array = pa.concat_arrays([array.cast(pa.large_string()).fill_null("")])
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    buf = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, bounds - bounds[0]


def _squeezed(text: str | None) -> str:
    return "".join((text or "").split())


class _Fragments:
    """What the structural index says about the fragments of some nodes."""

    def __init__(self, array: pa.Array) -> None:
        buf, bounds = _strings(array)
        found = index_elements(buf, bounds)
        whole = found.end >= 0
        hashes = np.zeros(len(found.start), np.uint64)
        hashes[whole] = span_hashes(buf, found.start[whole], found.end[whole])
        root = np.full(len(bounds) - 1, -1, np.int64)
        first = np.flatnonzero(np.concatenate([[True], found.fragment[1:] != found.fragment[:-1]])) if len(found.start) else []
        for k in first:
            root[found.fragment[k]] = k
        self._lo = np.searchsorted(found.fragment, np.arange(len(bounds) - 1), side="left")
        self._hi = np.searchsorted(found.fragment, np.arange(len(bounds) - 1), side="right")
        self._spans = list(zip(hashes.tolist(), (found.end - found.start).tolist(), strict=True))
        self._whole, self._root, self._sets = whole, root, {}

    def own(self, i: int) -> tuple[int, int] | None:
        """Hash and length of node i's own element, None if its fragment is missing or cut off."""
        k = self._root[i]
        return self._spans[k] if k >= 0 and self._whole[k] else None

    def holds(self, i: int) -> set | None:
        """All elements inside node i's element, None if its fragment is missing or cut off."""
        k = self._root[i]
        if k < 0 or not self._whole[k]:
            return None
        if i not in self._sets:
            self._sets[i] = set(self._spans[self._lo[i] : self._hi[i]])
        return self._sets[i]


def _parents(paths: list, texts: list, base: int, fragments: _Fragments) -> list[int]:
    """Position of each node's nearest listed encloser, -1 if none.

    With unique paths any position may be the parent (the array may be in any order).  Where a path
    repeats the array is in document order, so the parent is the last node of that path before.
    """
    listed: dict[str, list[int]] = {}
    for i, p in enumerate(paths):
        if p:
            listed.setdefault(p, []).append(i)
    ordered = any(len(x) > 1 for x in listed.values())
    seen: dict[str, int] = {}
    squeezed: dict[int, str] = {}

    def text(i: int) -> str:
        if i not in squeezed:
            squeezed[i] = _squeezed(texts[i])
        return squeezed[i]

    def encloses(a: int, i: int) -> bool:
        inner, outer = fragments.own(base + i), fragments.holds(base + a)
        if inner is not None and outer is not None:
            return inner in outer
        return text(i) in text(a) if text(a) else True

    out = []
    for i, p in enumerate(paths):
        parent, at = -1, p.rfind("/") if p else -1
        while at > 0:
            q = p[:at]
            a = seen.get(q, -1) if ordered else listed.get(q, [-1])[0]
            if a >= 0 and encloses(a, i):
                parent = a
                break
            at = p.rfind("/", 0, at)
        out.append(parent)
        if p:
            seen[p] = i
    return out


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, arrays = batch.column(0), batch.column(1)
        lengths = arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        fragments = pc.binary_length(arrays.flatten().field("text_xml_fragment")).fill_null(0).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(fragments, dtype=np.int64)])[np.concatenate([[0], np.cumsum(lengths)])]
        start = 0
        while start < batch.num_rows:  # slices of bounded size; a single record is never split
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] + BUFFER_BYTES, side="right")) - 1)
            yield _link(ids.slice(start, stop - start), arrays.slice(start, stop - start))
            start = stop


def _link(ids: pa.Array, arrays: pa.Array) -> pa.RecordBatch:
    flat = arrays.flatten()
    owner = np.repeat(np.arange(len(ids)), arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    column = lambda name: flat.field(name)
    valid = flat.is_valid()
    blank = pa.nulls(len(flat), pa.string())
    paths = pc.if_else(valid, column("canonical_path"), blank).to_pylist()
    texts = pc.if_else(valid, column("text_content"), blank).to_pylist()
    fragments = _Fragments(pc.if_else(valid, column("text_xml_fragment"), blank))
    position, parent = np.zeros(len(flat), np.int32), np.full(len(flat), -1, np.int32)
    lo = 0
    for size in np.bincount(owner, minlength=len(ids)) if len(flat) else []:
        hi = lo + int(size)
        position[lo:hi] = np.arange(size)
        parent[lo:hi] = _parents(paths[lo:hi], texts[lo:hi], lo, fragments)
        lo = hi
    return pa.record_batch([ids.take(pa.array(owner)), pa.array(position), pa.array(parent), flat], names=["parse_id", "node_pos", "parent_pos", "node"])


def link_nodes(records: DataFrame, id_col: str = "parse_id", array_col: str = "nodes") -> DataFrame:
    """One row per listed node: parse_id, node_pos, parent_pos and the node itself.

    The record id and the array are the only columns that reach Python; a record is never split since its
    nodes are one row already, so no key can become hot.
    """
    picked = spread(records.select(F.col(id_col).alias("parse_id"), F.col(array_col).alias("nodes")), "parse_id")
    node = picked.schema["nodes"].dataType.elementType.simpleString()
    kind = picked.schema["parse_id"].dataType.simpleString()
    return picked.mapInArrow(_link_batches, f"parse_id {kind}, node_pos int, parent_pos int, node {node}")


def flat_nodes(records: DataFrame) -> DataFrame:
    """Flat table of nodes: parse_id, node_pos, parent_pos, eid, canonical_path, text_content, text_xml_fragment, level."""
    return link_nodes(records).select("parse_id", "node_pos", "parent_pos", *[f"node.{c}" for c in ("eid", "canonical_path", "text_content", "text_xml_fragment", "level")])


def flat_refs(records: DataFrame) -> DataFrame:
    """Flat table of inline references with a non-empty href or text: parse_id, node_pos, ref_pos, href, text."""
    nodes = records.select("parse_id", F.posexplode("nodes").alias("node_pos", "node"))
    refs = nodes.select("parse_id", "node_pos", F.posexplode("node.refs").alias("ref_pos", "ref"))
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return refs.where(filled("ref.href") | filled("ref.text")).select("parse_id", "node_pos", "ref_pos", F.col("ref.href").alias("href"), F.col("ref.text").alias("text"))


def flat_records(records: DataFrame) -> DataFrame:
    """Flat table of the records themselves, without the nested array."""
    return records.drop("nodes").distinct()


def links(records: DataFrame) -> DataFrame:
    """Parent links of nodes and references: parse_id, child_kind, child_pos, parent_pos, each once.

    One pass gives both kinds: a row per node carries the positions of its non-void references.
    """
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    refs = F.coalesce(F.col("node.refs"), F.array().cast(_ref_type(records)))
    position = F.transform(refs, lambda r, i: F.when(filled(r["href"]) | filled(r["text"]), i))
    named = F.transform(F.filter(position, lambda x: x.isNotNull()), lambda x: F.struct(F.lit("ref").alias("child_kind"), x.alias("child_pos"), F.col("node_pos").alias("parent_pos")))
    node = F.array(F.struct(F.lit("node").alias("child_kind"), F.col("node_pos").alias("child_pos"), F.col("parent_pos").alias("parent_pos")))
    return link_nodes(records).select("parse_id", F.explode(F.concat(node, named)).alias("x")).select("parse_id", "x.*").distinct()


def _ref_type(records: DataFrame) -> str:
    return records.schema["nodes"].dataType.elementType["refs"].dataType.simpleString()
