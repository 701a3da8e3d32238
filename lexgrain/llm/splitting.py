"""Splitting of oversized texts at natural boundaries, with overlap, range by range.

A piece has at most `limit` characters.  Pieces after the first repeat up to `overlap` characters of the one
before, from the start of a word where there is one.  A cut falls, in this order of preference, at the last
paragraph start in the second half of the room, the last sentence start there, the last edge of a word in the
room, or an edge of a word that fits when the overlap is shortened; only a run of more than `limit` characters
without white space is cut inside ('hard').

The cuts are a function of the position alone (`Boundaries.next_cut`), so every text, in a column or in a file, is
worked on in ranges.  A range sees a halo on both sides.  Its boundary table gives, for each position at which a cut
could enter it, the position at which the chain of cuts leaves it and how many pieces it makes (`entry_tables`; chains
that meet are followed once).  The tables of a text are stitched (`stitched`): piece numbers and character offsets
are prefix sums.  Then each range emits its own pieces (`emitted`).  The ranges of a column's text lie in one row, so
all of it is one narrow pass; those of a giant file are read by byte offset in tasks of their own, and their tables are
composed in blocks of FAN, blocks of blocks and so on, so no task holds a file or all of its tables.

Defined results: null, blank and short texts are no case for `oversized`; `pieces` gives a text within the limit
back as one piece, null and empty texts as none; rows are treated one by one, so repeated rows repeat pieces; the
pieces of a text depend on nothing but the text and the parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.plans.scale import cut_lineage

LIMIT, OVERLAP = 2000, 200
#: Characters of a range of a text in a column, and characters of ranges that are worked on together.
RANGE_CHARS, BUFFER_CHARS = 8_192, 1_000_000
#: Bytes of a range of a giant file.
RANGE_BYTES = 16 * 2**20
#: Boundary tables that are composed in one task.
FAN = 256
_FAR = 2**40
#: White space by Unicode's White_Space property.
SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_IS_SPACE = np.zeros(0x3001, bool)
_IS_SPACE[list(SPACES)] = True
_ENDS = np.array([ord(c) for c in ".;!?:"], np.uint32)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _last(marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Greatest mark in (low, high], -1 if none."""
    if not len(marks):
        return np.full(len(low), -1, np.int64)
    k = np.searchsorted(marks, high, side="right") - 1
    found = np.where(k >= 0, marks[np.maximum(k, 0)], -1)
    return np.where(found > low, found, -1)


class Boundaries:
    """Natural boundaries in a buffer of ranges, each with its halos and a zero in front that belongs to no text."""

    def __init__(self, chars: np.ndarray, limit: int = LIMIT, overlap: int = OVERLAP) -> None:
        space = _IS_SPACE[np.minimum(chars, 0x3000)] & (chars <= 0x3000)
        before, after = space[:-1], space[1:]
        self.words = np.flatnonzero(before | after) + 1
        self.starts = at = np.flatnonzero(before & ~after) + 1
        self.paragraphs = self.starts[chars[at - 1] == 10]
        self.sentences = self.starts[(at >= 2) & np.isin(chars[np.maximum(at - 2, 0)], _ENDS)]
        self.limit, self.overlap = limit, overlap

    def repeat_from(self, cut: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where the piece that follows a cut begins."""
        low = np.maximum(cut - self.overlap, begin)
        k = np.searchsorted(self.starts, low, side="left")
        word = self.starts[np.minimum(k, len(self.starts) - 1)] if len(self.starts) else cut
        found = np.where((k < len(self.starts)) & (word < cut), word, low)
        return np.where(cut > begin, found, begin)

    def next_cut(self, cut: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each cut: the next cut, the start of the piece between them, and whether the next cut is hard."""
        start = self.repeat_from(cut, begin)
        room = start + self.limit
        half = cut + np.maximum((room - cut) // 2, 1)
        choice = _last(self.paragraphs, half, room)
        for marks, low in ((self.sentences, half), (self.words, cut)):
            choice = np.where(choice < 0, _last(marks, low, room), choice)
        late = _last(self.words, cut, cut + self.limit)
        squeezed = (choice < 0) & (late >= 0)
        hard = (choice < 0) & (late < 0)
        following = np.where(hard, room, np.where(squeezed, late, choice))
        whole = np.maximum(end - self.limit, begin) <= cut  # the rest fits, if need be with less overlap
        final = whole | (end <= room)
        last = np.where(end > room, np.maximum(end - self.limit, begin), start)
        start = np.where(final, last, np.where(squeezed, late - self.limit, start))  # what lies behind the end has no say
        return np.where(final, end, following), start, hard & ~final


@dataclass
class Range:
    """Part of a text with its halos; `rest` is how much of the text follows it (_FAR: more than the halo shows)."""

    before: str
    own: str
    after: str
    first: bool
    rest: int


class RangeBuffer:
    """Ranges side by side in one buffer, with their boundaries."""

    def __init__(self, ranges: list[Range], limit: int, overlap: int) -> None:
        lengths = np.array([[1 + len(r.before), len(r.own), len(r.after)] for r in ranges], np.int64).reshape(-1, 3)
        whole = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])
        self.limit = limit
        self.low = whole[:-1] + lengths[:, 0]
        self.high = self.low + lengths[:, 1]
        first = np.array([r.first for r in ranges], bool)
        self.first = first
        self.begin = np.where(first, self.low, -_FAR)
        self.end = self.high + np.array([r.rest for r in ranges], np.int64)
        self.marks = Boundaries(codes("".join(x for r in ranges for x in ("\0", r.before, r.own, r.after))), limit, overlap)

    def next_cut(self, cut: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.marks.next_cut(cut, self.begin[owner], self.end[owner])


def entry_tables(ranges: list[Range], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each range, for each entry position: how far behind its end the chain of cuts leaves, and how many pieces it makes.

    The next cut of a position is found once, however many chains pass it; exits and counts come by doubling.
    """
    buf = RangeBuffer(ranges, limit, overlap)
    counts = np.where(buf.first, 1, np.minimum(limit, buf.high - buf.low) + 1)
    owner = np.repeat(np.arange(len(ranges)), counts)
    entry = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + buf.low[owner]
    inside = entry < buf.high[owner]
    at, of = entry[inside], owner[inside]  # sorted, each once
    seen = np.zeros(int(buf.high[-1]) + 1 if len(ranges) else 0, bool)
    places, owners, nexts = [at[:0]], [of[:0]], [at[:0]]
    while len(at):
        seen[at] = True
        upto = buf.next_cut(at, of)[0]
        places, owners, nexts = [*places, at], [*owners, of], [*nexts, upto]
        on = upto < buf.high[of]
        at, k = np.unique(upto[on], return_index=True)
        fresh = ~seen[at]
        at, of = at[fresh], of[on][k][fresh]
    place, of, leave = (np.concatenate(x) for x in (places, owners, nexts))
    order = np.argsort(place)
    place, of, leave = place[order], of[order], leave[order]
    made = np.ones(len(place), np.int64)
    hop = np.where(leave < buf.high[of], np.searchsorted(place, leave), -1)
    while (live := hop >= 0).any():
        h = hop[live]
        made[live] += made[h]
        leave[live] = leave[h]
        hop[live] = hop[h]
    left, number = np.zeros(len(entry), np.int64), np.zeros(len(entry), np.int64)
    k = np.searchsorted(place, entry[inside])
    left[inside], number[inside] = leave[k] - buf.high[owner[inside]], made[k]
    edges = np.cumsum(counts)[:-1]
    return list(zip(np.split(left, edges), np.split(number, edges), strict=True))


def _behind(table: tuple[int, np.ndarray, np.ndarray], entry: int, piece: int, offset: int) -> tuple[int, int, int]:
    """Entry, piece number and character offset behind a range, given its (characters, left, made)."""
    chars, left, made = table
    return int(left[entry]), piece + int(made[entry]), offset + chars


def stitched(tables: list[tuple[int, np.ndarray, np.ndarray]], entry: int = 0, piece: int = 0, offset: int = 0) -> Iterator[tuple[int, int, int]]:
    """(entry, first piece number, character offset) of consecutive ranges."""
    at = (entry, piece, offset)
    for table in tables:
        yield at
        at = _behind(table, *at)


def composed(tables: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """The table of consecutive ranges as one range."""
    chars, left, made = tables[0]
    for more, following, count in tables[1:]:
        chars, left, made = chars + more, following[left], made + count[left]
    return chars, left, made


def emitted(ranges: list[Range], entries: list[int], limit: int = LIMIT, overlap: int = OVERLAP) -> Iterator[tuple[int, int, int, int, bool]]:
    """(range, number in the range, start, end, hard) of the pieces whose cut enters each range; places count from its start."""
    buf = RangeBuffer(ranges, limit, overlap)
    cut = buf.low + np.array(entries, np.int64)
    live, number = np.flatnonzero(cut < buf.high), 0
    while len(live):
        upto, start, hard = buf.next_cut(cut[live], live)
        low = buf.low[live]
        yield from zip(live.tolist(), [number] * len(live), (start - low).tolist(), (upto - low).tolist(), hard.tolist(), strict=True)
        cut[live] = upto
        live, number = live[upto < buf.high[live]], number + 1


def _ranges_of(text: str, limit: int, overlap: int, size: int) -> list[Range]:
    ahead, behind, n = limit + 2, overlap + 4, len(text)
    return [Range(text[max(0, k - behind) : k], text[k : k + size], text[k + size : k + size + ahead], k == 0, max(0, n - k - size)) for k in range(0, n, size)]


def _in_groups(items: Iterator[tuple], size: int) -> Iterator[list]:
    """Items (with a range first) in groups of bounded length."""
    group, total = [], 0
    for x in items:
        group.append(x)
        total += len(x[0].own)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


def cut_batch(texts: list[str | None], limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE_CHARS) -> Iterator[tuple[int, int, int, int, bool]]:
    """(text number, piece number, start, end, hard) of all pieces of the texts, in no order, in bounded memory."""
    if size < limit:
        raise ValueError("a range must hold a piece")
    ranges = ((r, i, k) for i, t in enumerate(texts) if t for k, r in enumerate(_ranges_of(t, limit, overlap, size)))
    placed: dict[int, tuple[int, int, int]] = {}  # of the text that a group may have ended in: entry, piece, offset
    for group in _in_groups(ranges, BUFFER_CHARS):
        open_ = [x for x in group if x[0].rest]  # what follows the last range of a text is never asked
        tables = {x[1:]: (len(x[0].own), *t) for x, t in zip(open_, entry_tables([x[0] for x in open_], limit, overlap), strict=True)} if open_ else {}
        starts = []
        for r, i, k in group:
            starts.append(placed.pop(i, (0, 0, 0)) if k else (0, 0, 0))
            if r.rest:
                placed[i] = _behind(tables[i, k], *starts[-1])
        for n, number, a, b, hard in emitted([x[0] for x in group], [e for e, _, _ in starts], limit, overlap):
            _, piece, offset = starts[n]
            yield group[n][1], piece + number, offset + a, offset + b, hard


def pieces(rows: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True, range_chars: int = RANGE_CHARS) -> DataFrame:
    """keys, piece_no, start_at, end_at, cut_kind and piece_text of every piece: one narrow pass, no shuffle.

    start_at and end_at count characters; cut_kind says how the piece ends: 'soft', 'hard', or 'end'.
    """
    picked = rows.select(*keys, F.col(text).alias("_text"))
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.select(*keys).schema)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["_text"]]
            found = pd.DataFrame(cut_batch(texts, limit, overlap, range_chars), columns=["_i", "piece_no", "start_at", "end_at", "hard"])
            if not len(found):
                continue
            out = batch[keys].iloc[found["_i"]].reset_index(drop=True)
            out["piece_no"], out["start_at"], out["end_at"] = found["piece_no"].astype("int32"), found["start_at"], found["end_at"]
            whole = [len(texts[i]) == e for i, e in zip(found["_i"], found["end_at"], strict=True)]
            out["cut_kind"] = ["end" if w else "hard" if h else "soft" for w, h in zip(whole, found["hard"], strict=True)]
            if with_text:
                out["piece_text"] = [texts[i][a:b] for i, a, b in zip(found["_i"], found["start_at"], found["end_at"], strict=True)]
            yield out

    return picked.mapInPandas(work, f"{given}, piece_no int, start_at long, end_at long, cut_kind string" + ", piece_text string" * with_text)


def oversized(rows: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """key, cut_kind ('hard' or 'soft') of keys with a text longer than the limit, from the cuts of its pieces."""
    long = rows.where(F.length(text) > limit)
    cuts = pieces(long, [key], text, limit, overlap, with_text=False)
    return cuts.groupBy(key).agg(F.when(F.max(F.col("cut_kind") == "hard"), "hard").otherwise("soft").alias("cut_kind"))


def rebuilt(rows: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """keys, rebuilt_sha, within_limit, within_overlap, cut_kind of every distinct text: what its pieces give back when put together.

    The pieces of a text come together again, so a group is one text.
    """
    named = rows.select(*keys, F.sha2(F.col(text), 256).alias("_own"), text).distinct()
    cut = pieces(named, [*keys, "_own"], text, limit, overlap)
    joined = cut.groupBy(*keys, "_own").agg(F.array_sort(F.collect_list(F.struct("piece_no", "start_at", "end_at", "cut_kind", "piece_text"))).alias("p"))
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("p"), i - 1)["end_at"])
    fresh = F.array_join(F.transform("p", lambda x, i: F.substring(x["piece_text"], (before(i) - x["start_at"] + 1).cast("int"), x["end_at"].cast("int"))), "")
    overlaps = F.forall(F.transform("p", lambda x, i: before(i) - x["start_at"]), lambda n: (n >= 0) & (n <= overlap))
    hard = F.exists("p", lambda x: x["cut_kind"] == "hard")
    return joined.select(*keys, F.sha2(fresh, 256).alias("rebuilt_sha"), F.forall("p", lambda x: F.length(x["piece_text"]) <= limit).alias("within_limit"), overlaps.alias("within_overlap"), F.when(hard, "hard").otherwise("soft").alias("cut_kind"))


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _read_range(path: str, size: int, k: int, range_bytes: int, limit: int, overlap: int) -> Range:
    """A range of a UTF-8 file with its halos, cut at whole characters; only these bytes are read."""
    ahead, behind = limit + 2, overlap + 4
    low, high = k * range_bytes, min(size, (k + 1) * range_bytes)
    fs, name = _opened(path)
    with fs.open_input_file(name) as f:
        from_ = max(0, low - 4 * behind - 4)
        data = f.read_at(min(size, high + 4 * ahead + 4) - from_, from_)
    at, stop = low - from_, high - from_
    whole = lambda i: next((j for j in range(i, min(i + 4, len(data))) if data[j] & 0xC0 != 0x80), min(i, len(data)))
    at, stop = whole(at), whole(stop) if high < size else len(data)
    before, own, after = (data[a:b].decode("utf-8", "replace") for a, b in ((whole(0) if from_ else 0, at), (at, stop), (stop, len(data))))
    return Range(before, own, after, k == 0, len(after) if from_ + len(data) >= size else _FAR)


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """path, piece_no, start_at, end_at, piece_text of the pieces of giant UTF-8 files, read by byte ranges.

    The files must lie where every executor can read them (a shared folder or an object store URI).  No task
    holds more than one range with its halos or `fan` boundary tables of limit + 1 entries.
    """
    if range_bytes < 16 * limit:
        raise ValueError("a range must hold several pieces")
    sizes = [(p, fs.get_file_info(name).size) for p in paths for fs, name in [_opened(p)]]
    ranges = spark.createDataFrame(sizes, "path string, size long").where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0), F.expr(f"(size - 1) div {range_bytes}"))).alias("k"))
    total, most = sum(-(-s // range_bytes) for _, s in sizes), max((-(-s // range_bytes) for _, s in sizes), default=0)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, k in batch.itertuples(index=False):
                r = _read_range(path, size, k, range_bytes, limit, overlap)
                ((left, made),) = entry_tables([r], limit, overlap)
                yield pd.DataFrame({"path": [path], "size": [size], "k": [k], "chars": [len(r.own)], "left": [left.tobytes()], "made": [made.tobytes()]})

    def read(table: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
        return [(c, np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)) for c, x, y in zip(table["chars"], table["left"], table["made"], strict=True)]

    def compose(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("k")
        chars, left, made = composed(read(table))
        return pd.DataFrame({"path": table["path"].iloc[:1], "size": table["size"].iloc[:1], "k": table["k"].iloc[:1] // fan, "chars": [chars], "left": [left.tobytes()], "made": [made.tobytes()]})

    def place(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("k")
        at = [int(table[c].iloc[0]) for c in ("entry", "piece", "offset")] if "entry" in table else [0, 0, 0]
        return table[["path", "size", "k"]].reset_index(drop=True).join(pd.DataFrame(stitched(read(table), *at), columns=["entry", "piece", "offset"]))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, k, entry, piece, offset in batch.itertuples(index=False):
                r = _read_range(path, size, k, range_bytes, limit, overlap)
                text, n = r.before + r.own + r.after, len(r.before)
                rows = [(path, piece + m, offset + a, offset + b, text[n + a : n + b]) for _, m, a, b, _ in emitted([r], [entry], limit, overlap)]
                yield pd.DataFrame(rows, columns=["path", "piece_no", "start_at", "end_at", "piece_text"])

    kind, found = "path string, size long, k long, chars long, left binary, made binary", "path string, size long, k long, entry long, piece long, offset long"
    levels = [cut_lineage(ranges.repartition(max(1, total), "path", "k").mapInPandas(scan, kind))]
    while most > fan:  # blocks of tables, blocks of blocks, ...
        block = F.expr(f"k div {fan}").alias("block")
        levels.append(levels[-1].groupBy("path", block).applyInPandas(compose, kind))
        most = -(-most // fan)
    placed = levels.pop().groupBy("path").applyInPandas(place, found)
    for level in reversed(levels):
        upper = placed.select("path", F.col("k").alias("block"), "entry", "piece", "offset")
        placed = level.withColumn("block", F.expr(f"k div {fan}")).join(upper, ["path", "block"]).groupBy("path", "block").applyInPandas(place, found)
    return placed.repartition(max(1, total), "path", "k").mapInPandas(emit, "path string, piece_no long, start_at long, end_at long, piece_text string")
