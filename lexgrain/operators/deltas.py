"""Compact text deltas between versions: keep, delete and insert tokens, and their application.

A delta is tab-separated tokens: =n keeps n characters, -n deletes n, +text inserts percent-encoded text.

The difference is sought between words: what both texts begin and end with is kept, words that stand once in either
text anchor the rest, and between two anchors the same is done again.  That takes little more than time in proportion
to the texts, so texts of any length are treated alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexgrain.functions.text import compression_ratio

_PLAIN = " !~*'();/?:@&=+$,#-_.<>«»"
_WORD = re.compile(r"\w+|\s+|[^\w\s]")


def _ends(a: list | str, b: list | str) -> tuple[int, int]:
    """How many items both begin with, and how many both end with after that."""
    start, least = 0, min(len(a), len(b))
    while start < least and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < least - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    return start, stop


def _anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of words that stand once in both, as many as keep their order."""
    once = [w for w, n in Counter(a).items() if n == 1]
    count, place = Counter(b), {w: j for j, w in enumerate(b)}
    at = {w: i for i, w in enumerate(a)}
    pairs = sorted((at[w], place[w]) for w in once if count[w] == 1)
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):  # longest increasing run of places
        n = bisect_left(tails, j)
        tails[n : n + 1] = [j]
        ends[n : n + 1] = [k]
        back.append(ends[n - 1] if n else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _steps(a: list[str], b: list[str]) -> Iterator[tuple[str, object]]:
    """Steps from the words a to the words b."""
    work = [(0, len(a), 0, len(b))]
    while work:
        i, j, k, m = work.pop()
        x, y = a[i:j], b[k:m]
        start, stop = _ends(x, y)
        if start or stop:
            if start == len(x) == len(y):
                yield "=", sum(map(len, x))
                continue
            work += [(j - stop, j, m - stop, m)] * bool(stop) + [(i + start, j - stop, k + start, m - stop)] + [(i, i + start, k, k + start)] * bool(start)
            continue
        anchors = _anchors(x, y)
        if not anchors:  # different words: only the letters they share at their ends are kept
            old, new = "".join(x), "".join(y)
            start, stop = _ends(old, new)
            yield from (("=", start), ("-", len(old) - start - stop), ("+", new[start : len(new) - stop]), ("=", stop))
            continue
        parts, p, q = [], 0, 0
        for u, v in [*anchors, (len(x), len(y))]:
            parts.append((i + p, i + u, k + q, k + v))
            p, q = u, v
        work += reversed(parts)


def build(base: str | None, updated: str | None) -> str:
    """Delta from base to updated; null counts as ''."""
    merged: list[list] = []
    for sign, value in _steps(_WORD.findall(base or ""), _WORD.findall(updated or "")):
        if not value:
            continue
        if merged and merged[-1][0] == sign:
            merged[-1][1] += value
        else:
            merged.append([sign, value])
    return "\t".join(s + (quote(v, safe=_PLAIN) if s == "+" else str(v)) for s, v in merged)


def apply(base: str | None, delta: str | None) -> str:
    """The updated text."""
    base, at, out = base or "", 0, []
    for token in (delta or "").split("\t"):
        sign, value = token[:1], token[1:]
        if sign == "+":
            out.append(unquote(value))
        elif sign in ("=", "-"):
            n = int(value)
            if sign == "=":
                out.append(base[at : at + n])
            at += n
    return "".join(out)


def _pairwise(f):  # noqa: ANN001, ANN202
    @F.pandas_udf(StringType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([f(x, y) for x, y in zip(a, b, strict=True)], index=a.index, dtype=object)

    return run


build_delta, apply_delta = _pairwise(build), _pairwise(apply)


def version_deltas(nodes: DataFrame) -> DataFrame:
    """Per act and path: version_id, base_version_id, delta_text, compression_ratio against the version before.

    The first version has no base.  Of repeated deliveries the one loaded last counts.
    """
    last = nodes.groupBy("doc_id", "canonical_path", "version_id").agg(F.max(F.struct("loaded_at", F.coalesce("text_content", F.lit("")).alias("t")))["t"].alias("updated"))
    order = Window.partitionBy("doc_id", "canonical_path").orderBy("version_id")
    pairs = last.withColumn("base_version_id", F.lag("version_id").over(order)).withColumn("base", F.coalesce(F.lag("updated").over(order), F.lit("")))
    made = pairs.withColumn("delta_text", build_delta("base", "updated"))
    return made.select("doc_id", "canonical_path", "version_id", "base_version_id", "base", "updated", "delta_text", compression_ratio(F.col("base"), F.col("delta_text")).alias("compression_ratio"))
