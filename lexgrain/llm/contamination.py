"""Held-out passages inside corpus texts: SimHash windows, multi-index blocks, verification by shingles.

The window is as long as the shortest passage that counts, WINDOW words.  Every window of an item and of a document
gets a 64-bit SimHash of its word shingles.  Fingerprints are cut into radius + 1 blocks of bits; two fingerprints
within `radius` bits agree in one block at least, so a join on (block, bits of the block) finds all of them.
Candidates within the radius are verified by the weighted similarity of their shingles.  With `exact` a shingle counts
with its place in the window and the similarity must be 1, which is the rule of a run of WINDOW equal words: it is 1 if
all words are equal and only then, and equal windows have distance 0, so none is lost.  No radius adds rows to that rule;
what it brings besides, the verification drops.  Without `exact` the places do not matter, and the radius must be large
enough for the similarity asked for (`radius_for`).

The corpus is read once, for any number of items: a document's windows meet a filter of the items' block keys (a bit
array of at most FILTER_BYTES, so its size is bounded; the fuller it is, the more windows pass it, none is lost), and
only windows that pass are written down with their words.  These are compared as distinct texts: a passage that a third
of the corpus holds is verified once.  Documents come back by the words of the window, over SALTS parts.

Defined results: null and blank texts and texts or items of fewer than WINDOW words give nothing; repeated
documents and items count once per id; several items may share a passage and all are reported.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.operators.structure import span_hashes
from lexgrain.plans.scale import cut_lineage, spread

WINDOW, SHINGLE, RADIUS, SIMILAR = 12, 5, 1, 0.8
#: Characters of texts that a worker treats together, and windows that get their fingerprints at once.
TEXT_CHARS, WINDOW_BLOCK = 400_000, 16_384
#: Bits of the filter for each block key, hash places per key, and its greatest size.
FILTER_BITS, FILTER_PLACES, FILTER_BYTES = 32, 3, 32 * 2**20
#: Bytes of a part of the filter while it is built.
FILTER_PART = 65_536
#: Parts over which the documents of a window are spread.
SALTS = 16
_WORD = re.compile(r"[a-z0-9]+")
_MARKS = re.compile("[\u0300-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_IS_MARK = np.array([bool(_MARKS.match(chr(c))) for c in range(0x10000)])
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123)]] = True
#: Of each byte value, the bits as eight bytes of 0 or 1.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def folded(text: str) -> str:
    """Lower-case text without accents."""
    text = text.lower()
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", text))


def words(text: str | None) -> list[str]:
    """Maximal runs of a-z and 0-9 after lower-casing and removing accents."""
    return _WORD.findall(folded(text)) if text else []


class Words:
    """All words of some texts: where they stand in one byte buffer, whose text they are of, and their hashes."""

    def __init__(self, texts: list[str]) -> None:
        joined = "\0".join(t.replace("\0", " ") for t in texts).lower()
        if joined.isascii():
            self.buf = np.frombuffer(joined.encode(), np.uint8)
        else:
            codes = np.frombuffer(unicodedata.normalize("NFD", joined).encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = codes[~_IS_MARK[np.minimum(codes, 0xFFFF)]]
            self.buf = np.where(codes < 128, codes, ord("?")).astype(np.uint8)
        inside = np.concatenate([[False], _IS_WORD[self.buf], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.owner = np.searchsorted(np.flatnonzero(self.buf == 0), self.start)
        self.hashes = np.empty(len(self.start), np.uint64)
        low = 0
        while low < len(self.start):  # a few words at a time, so that what a long text needs stays small
            high = max(low + 1, int(np.searchsorted(self.end, self.start[low] + TEXT_CHARS, side="right")))
            at = self.start[low]
            self.hashes[low:high] = span_hashes(self.buf[at : self.end[high - 1]], self.start[low:high] - at, self.end[low:high] - at)
            low = high
        self.hashes ^= self.hashes >> np.uint64(31)

    def text(self, first: int, window: int) -> str:
        """The words of a window with one blank between them."""
        inner = self.buf[self.start[first] : self.end[first + window - 1]].tobytes()
        return " ".join(_WORD.findall(inner.decode()))

    def windows(self, window: int, shingle: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first words, fingerprints) of all windows within one text, in blocks."""
        for low in range(0, len(self.start) - window + 1, WINDOW_BLOCK):
            high = min(low + WINDOW_BLOCK, len(self.start) - window + 1)
            prints = fingerprints(self.hashes[low : high + window - 1], window, shingle)
            first = np.arange(low, high)
            whole = self.owner[first] == self.owner[first + window - 1]
            yield first[whole], prints[whole]


def shingle_hashes(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """Hash of the words i .. i + shingle - 1 for each i."""
    n = len(hashes) - shingle + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(shingle):
            out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def fingerprints(hashes: np.ndarray, window: int, shingle: int) -> np.ndarray:
    """SimHash of each run of `window` words: the bits that more than half of its shingles have.

    The 64 counts of a window are bytes side by side, summed over its shingles by doubling.
    """
    inside = window - shingle + 1
    if not 0 < inside < 256:
        raise ValueError("a window must hold 1 to 255 shingles")
    shingles = shingle_hashes(hashes, shingle)
    n = len(shingles) - inside + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _LANES[shingles.view(np.uint8).reshape(-1, 8)]  # sums over 1, 2, 4, ... shingles
    total, done, width = None, 0, 1
    while True:
        if inside & width:
            part = power[done : done + n]
            total, done = part if total is None else total + part, done + width
        if done == inside:
            break
        power, width = power[:-width] + power[width:], 2 * width
    ones = np.ascontiguousarray(total).view(np.uint8).reshape(n, 64) > inside // 2
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each of radius + 1 blocks of 64 bits."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def radius_for(similar: float) -> int:
    """Bits within which nearly all windows of a shingle similarity lie: the expected distance and three deviations."""
    p = math.acos(min(1.0, 2 * similar / (1 + similar))) / math.pi
    return math.ceil(64 * p + 3 * math.sqrt(64 * p * (1 - p)))


class BlockFilter:
    """A bit array of block keys: every key that was added is found, others now and then."""

    def __init__(self, radius: int, bits: int, data: np.ndarray | None = None) -> None:
        self.radius, self.bits = radius, bits
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    @staticmethod
    def bits_for(keys: int) -> int:
        return min(8 * FILTER_BYTES, max(8 * FILTER_PART, 1 << (max(1, keys) * FILTER_BITS - 1).bit_length()))

    def _places(self, prints: np.ndarray) -> Iterator[list[np.ndarray]]:
        mask = np.uint64(self.bits - 1)
        for k, (shift, width) in enumerate(blocks(self.radius)):
            x = ((prints >> np.uint64(shift)) & np.uint64(2**width - 1)) + np.uint64(k + 1)
            with np.errstate(over="ignore"):
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x ^= x >> np.uint64(31)
                step = (x >> np.uint64(40)) | np.uint64(1)
                yield [((x + np.uint64(j) * step) & mask).astype(np.int64) for j in range(FILTER_PLACES)]

    def add(self, prints: np.ndarray) -> None:
        for places in self._places(prints):
            for at in places:
                np.bitwise_or.at(self.data, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def passing(self, prints: np.ndarray) -> np.ndarray:
        """Positions of fingerprints one of whose block keys may have been added."""
        found = np.zeros(len(prints), bool)
        for places in self._places(prints):
            held = np.arange(len(prints))
            for at in places:
                here = at[held]
                held = held[(self.data[here >> 3] >> (here & 7).astype(np.uint8)) & 1 > 0]
            found[held] = True
        return np.flatnonzero(found)


def _windows(rows: DataFrame, key: str, window: int, shingle: int, held: object = None) -> DataFrame:
    """key, print, words of the windows of texts, each once per text; only those that pass the filter if there is one."""
    kind = rows.schema[key].dataType.simpleString()

    def found_in(group: list[tuple[object, str]]) -> pd.DataFrame:
        w = Words([t for _, t in group])
        out = {}
        for first, prints in w.windows(window, shingle):
            at = held.value.passing(prints) if held else np.arange(len(prints))
            for i, p in zip(first[at].tolist(), prints[at].view(np.int64).tolist(), strict=True):
                out[int(w.owner[i]), w.text(i, window)] = p
        return pd.DataFrame([(group[k][0], p, t) for (k, t), p in out.items()], columns=[key, "print", "words"])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            group, total = [], 0
            for k, t in zip(batch[key], batch["text"], strict=True):
                group.append((k, t))
                total += len(t)
                if total >= TEXT_CHARS:
                    yield found_in(group)
                    group, total = [], 0
            if group:
                yield found_in(group)

    return rows.select(key, "text").mapInPandas(work, f"{key} {kind}, print long, words string")


def _filter(prints: DataFrame, radius: int) -> BlockFilter:
    """The filter of all fingerprints, built in parts where they lie and put together part by part."""
    bits = BlockFilter.bits_for(prints.count() * (radius + 1))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = BlockFilter(radius, bits)
        for b in batches:
            own.add(b["print"].to_numpy(np.int64).view(np.uint64))
        parts = own.data.reshape(-1, FILTER_PART)
        for k in np.flatnonzero(parts.any(axis=1)):
            yield pd.DataFrame({"part": [int(k)], "data": [parts[k].tobytes()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros(FILTER_PART, np.uint8)
        for x in group["data"]:
            data |= np.frombuffer(x, np.uint8)
        return pd.DataFrame({"part": group["part"].iloc[:1], "data": [data.tobytes()]})

    out = BlockFilter(radius, bits)
    for r in prints.mapInPandas(build, "part int, data binary").groupBy("part").applyInPandas(merge, "part int, data binary").toLocalIterator():
        out.data[r["part"] * FILTER_PART : (r["part"] + 1) * FILTER_PART] = np.frombuffer(r["data"], np.uint8)
    return out


def similarity(a: str, b: str, shingle: int = SHINGLE, placed: bool = False) -> float:
    """Weighted Jaccard similarity of the shingles of two windows; a shingle weighs its letters, as often as it stands there.

    `placed` shingles are the same only at the same place, so that 1 means equal words: without places windows of the
    same shingles in another order (a cycle of words begun elsewhere) have 1 as well.
    """
    x, y = ({}, {})
    for text, bag in ((a, x), (b, y)):
        ws = text.split(" ")
        for i in range(len(ws) - shingle + 1):
            s = " ".join(ws[i : i + shingle])
            at = (i, s) if placed else s
            bag[at] = bag.get(at, 0) + len(s)
    both = sum(min(n, y.get(s, 0)) for s, n in x.items())
    return both / max(1, sum(x.values()) + sum(y.values()) - both)


def _similarity(shingle: int, placed: bool):  # noqa: ANN202
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y, shingle, placed) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run.asNondeterministic()  # so that it stays behind the distinct and sees each pair once


def _keys(radius: int) -> Column:
    """Array of a fingerprint's (block, bits)."""
    bits = [(F.shiftrightunsigned("print", shift).bitwiseAND(F.lit(2**width - 1 if width < 64 else -1))).cast("long") for shift, width in blocks(radius)]
    return F.array(*[F.struct(F.lit(k).alias("block"), x.alias("bits")) for k, x in enumerate(bits)])


def alike(left: DataFrame, right: DataFrame, radius: int, shingle: int, similar: float, exact: bool) -> DataFrame:
    """words, other: verified pairs of the distinct windows (print, words) of both sides."""
    keyed = lambda df, name: df.select(F.col("print").alias(f"{name}_print"), F.col("words").alias(name), F.explode(_keys(radius)).alias("key")).select("*", "key.*").drop("key")
    pairs = keyed(left, "words").join(keyed(right, "other"), ["block", "bits"])
    near = pairs.where(F.bit_count(F.col("words_print").bitwiseXOR(F.col("other_print"))) <= radius).select("words", "other").distinct()
    return near.where(_similarity(shingle, exact)("words", "other") >= (1.0 if exact else similar))


def leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, radius: int = RADIUS, exact: bool = True, similar: float = SIMILAR) -> DataFrame:
    """doc_id, item_id: documents that hold a run of `window` words of an item (or, not exact, one much like it)."""
    if not exact and radius < radius_for(similar):
        raise ValueError(f"windows of similarity {similar} may differ in {radius_for(similar)} bits")
    known = lambda df, key: df.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, "text")
    held = cut_lineage(_windows(known(items, "item_id").distinct(), "item_id", window, shingle))
    wanted = held.select("print", "words").distinct()
    sent = documents.sparkSession.sparkContext.broadcast(_filter(wanted.select("print"), radius))
    found = cut_lineage(_windows(spread(documents.where(F.col("text").isNotNull()).select("doc_id", "text"), "doc_id"), "doc_id", window, shingle, sent))
    pairs = alike(found.select("print", "words").distinct(), wanted, radius, shingle, similar, exact)
    named = pairs.join(held.select(F.col("words").alias("other"), "item_id"), "other").select("words", "item_id").distinct()
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread_out = found.select("doc_id", "words", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    return spread_out.join(salted, ["words", "salt"]).select("doc_id", "item_id").distinct()
