"""Hierarchical packing of texts into containers of fixed token capacity, planned on the histogram of sizes.

Tokens are counted in a narrow pass.  A text larger than the capacity is cut into full containers and a rest;
everything else stays whole.  The plan is made on the driver from the histogram of sizes alone, whose size is
bounded by the capacity and not by the number of texts:

1. Sizes are routed to tiers of context lengths (capacity, 1/2, 1/4, ...): a size goes to the shortest that holds it.
2. Each tier, from the longest, is packed into windows of its own length, largest sizes first, best fit.
3. With `nested` the tier's windows are laid side by side into containers of the full capacity, those with most in them
   first, best fit; without it every window is a container of its own length.
4. The gaps that the tier leaves in its containers are filled from the shorter tiers, the largest size that fits first.
5. Containers are dealt to step groups in snake order, from those with the longest windows, so that every group holds
   nearly the same number of tokens and the same mix of windows.

All of this works on runs of equal windows, so its cost depends on the number of sizes only.  Items of a size get their
rank in a distributed way (salted groups with offsets), and rank and size give container, window and slot.

Defined results: null and empty texts have no tokens and take no room (they are left out); equal sizes are ordered
by hash and id; repeated rows are separate items unless the caller removes them; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexgrain.plans.scale import cut_lineage, spread

CAPACITY, STEP, TIERS = 2048, 8, 4
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Items of one size that are ranked together.
RANK_ROWS = 500_000
_ENCODINGS: dict = {}
#: Characters that are encoded at once, or more up to the next blank between words, where a token always begins.
PART_CHARS = 200_000
_BETWEEN = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def encoding(ranks: bytes):  # noqa: ANN201
    """The public byte-level BPE tokenizer of the given rank file's content."""
    if (name := hash(ranks)) not in _ENCODINGS:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODINGS[name] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[name]


def token_count(text: str | None, enc) -> int:  # noqa: ANN001
    """Tokens of a whole text.  Long texts are encoded part by part, cut only where the tokens are the same either way."""
    if not text:
        return 0
    text = text.encode("utf-8", "replace").decode()
    total, at = 0, 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PART_CHARS) if len(text) - at > PART_CHARS else None
        stop = cut.start() if cut else len(text)
        total += len(enc.encode_ordinary(text[at:stop]))
        at = stop
    return total


def sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens.  The rank file is read on the driver and sent to the workers."""
    with open(vocabulary, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [token_count(t, enc) for t in b["text"]]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return spread(documents.where(F.length("text") > 0).select("doc_id", "text"), "doc_id").mapInPandas(work, f"doc_id {kind}, n_tokens long")


def tier_lengths(capacity: int = CAPACITY, tiers: int = TIERS) -> list[int]:
    """Context lengths from the longest: each is half the one before."""
    return [x for x in (capacity >> k for k in range(tiers)) if x > 0]


@dataclass(frozen=True)
class Run:
    """`number` equal windows or containers; window i holds, of each (window, tier, size, rank) of `held`, the item of rank + i."""

    number: int
    used: int
    held: tuple[tuple[int, int, int, int], ...]

    def part(self, low: int, high: int) -> Run:
        return Run(high - low, self.used, tuple((w, t, s, r + low) for w, t, s, r in self.held))

    def beside(self, other: Run) -> Run:
        """Both together; the windows of the other one come after the own ones."""
        shift = max((w for w, *_ in self.held), default=-1) + 1
        return Run(self.number, self.used + other.used, self.held + tuple((w + shift, t, s, r) for w, t, s, r in other.held))



class _Rooms:
    """Runs by the room that is left in them."""

    def __init__(self, length: int) -> None:
        self.length, self._by, self._order = length, defaultdict(list), []

    def put(self, run: Run) -> None:
        room = self.length - run.used
        if not self._by[room]:
            insort(self._order, room)
        self._by[room].append(run)

    def take(self, size: int) -> Run | None:
        """A run with the least room that holds `size`."""
        k = bisect_left(self._order, size)
        if k == len(self._order):
            return None
        room = self._order[k]
        run = self._by[room].pop()
        if not self._by[room]:
            self._order.pop(k)
        return run

    def runs(self) -> list[Run]:
        return [run for room in self._order for run in self._by[room]]


def _laid(runs: list[Run], rooms: _Rooms) -> _Rooms:
    """The runs laid, in the given order, into what is open or anew, the tightest room first."""
    for run in runs:
        while run.number:
            open_ = rooms.take(run.used)
            if open_ is None:
                n = max(1, run.number // max(1, rooms.length // run.used))  # the others of this run go beside these
                rooms.put(run.part(0, n))
            else:
                n = min(open_.number, run.number)
                rooms.put(open_.part(0, n).beside(run.part(0, n)))
                if n < open_.number:
                    rooms.put(open_.part(n, open_.number))
            run = run.part(n, run.number)
    return rooms


def _filled(windows: list[Run], length: int, left: dict[int, int], taken: dict[int, int], tier_of: dict[int, int]) -> list[Run]:
    """Windows whose gaps are filled with what is left, the largest size that fits first."""
    open_sizes, out, work = sorted(s for s, n in left.items() if n), [], sorted(windows, key=lambda r: r.used)
    while work:
        run = work.pop()
        k = bisect_right(open_sizes, length - run.used)
        if not k:
            out.append(run)
            continue
        size = open_sizes[k - 1]
        n = min(run.number, max(1, left[size] // ((length - run.used) // size)))  # as often as it fits
        if n < run.number:
            work.append(run.part(n, run.number))
        work.append(run.part(0, n).beside(Run(n, size, ((0, tier_of[size], size, taken[size]),))))
        left[size], taken[size] = left[size] - n, taken[size] + n
        if not left[size]:
            open_sizes.pop(k - 1)
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, tiers: int = TIERS, nested: bool = True) -> list[Run]:
    """Runs of equal containers, those with the longest windows first."""
    lengths = tier_lengths(capacity, tiers)
    sizes = sorted((s for s, n in histogram.items() if s > 0 and n > 0), reverse=True)
    tier_of = {s: max(t for t, length in enumerate(lengths) if s <= length) for s in sizes}
    left, taken = {s: histogram[s] for s in sizes}, dict.fromkeys(sizes, 0)
    made: list[Run] = []
    for t, length in enumerate(lengths):
        mine = []
        for s in [s for s in sizes if tier_of[s] == t and left[s]]:
            mine.append(Run(left[s], s, ((0, t, s, taken[s]),)))
            taken[s], left[s] = taken[s] + left[s], 0
        windows = [Run(r.number, r.used, tuple((0, *x) for _, *x in r.held)) for r in _laid(mine, _Rooms(length)).runs()]
        windows.sort(key=lambda r: -r.used)
        if not nested:
            made += _filled(windows, length, left, taken, tier_of)
            continue
        rooms = _Rooms(capacity)
        for run in made:
            rooms.put(run)
        made = _filled(_laid(windows, rooms).runs(), capacity, left, taken, tier_of)
    return sorted(made, key=lambda r: (min(t for _, t, *_ in r.held), -r.used))


def _ranked(sized: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """The rows with their rank (from 0) among the rows of their size.

    A size is cut into salted groups of about RANK_ROWS rows, so the commonest size is no hot group; the counts of
    the groups, one number per RANK_ROWS rows and per size, give each group its offset.
    """
    salts = {s: -(-n // RANK_ROWS) for s, n in histogram.items() if n > RANK_ROWS}
    number = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in salts.items() for x in kv]), F.col("size")) if salts else F.lit(None).cast("long")
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part_no"), F.coalesce(number, F.lit(1).cast("long"))))
    if salts:
        offsets, before = [], defaultdict(int)
        for r in sorted(salted.where(F.col("size").isin([*salts])).groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n")).collect()):
            offsets.append((r["size"], r["salt"], before[r["size"]]))
            before[r["size"]] += r["n"]
        salted = salted.join(F.broadcast(sized.sparkSession.createDataFrame(offsets, "size long, salt long, base long")), ["size", "salt"], "left")
    else:
        salted = salted.withColumn("base", F.lit(0).cast("long"))
    nth = F.row_number().over(Window.partitionBy("size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", "part_no"))
    return salted.withColumn("rank", nth - 1 + F.coalesce("base", F.lit(0))).drop("base", "salt")


def pack(items: DataFrame, capacity: int = CAPACITY, step: int = STEP, tiers: int = TIERS, nested: bool = True) -> DataFrame:
    """container, window, slot, doc_id, part_no, n_tokens, tier, length, step_no of all items (doc_id, n_tokens).

    part_no numbers the parts of a text larger than the capacity; tier is that of the item's size; window numbers the
    windows of a container and slot the items of a container; length is the container's capacity; step_no groups `step`
    containers.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity)).cast("int")
    items = cut_lineage(items.select("doc_id", "n_tokens"))  # the counts are needed for the histogram and the result
    cut = items.where("n_tokens > 0").select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), parts)).alias("part_no"))
    size = F.least(F.lit(capacity), F.col("n_tokens") - (F.col("part_no") - 1) * capacity).cast("long")
    sized = cut.select("doc_id", (F.col("part_no") - 1).alias("part_no"), size.alias("size"))
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # `capacity` rows at most
    lengths = tier_lengths(capacity, tiers)
    rows, first = [], 0
    for run in plan(histogram, capacity, tiers, nested):
        whole = capacity if nested else lengths[min(t for _, t, *_ in run.held)]
        rows += [(s, r, r + run.number, first, w, k, t, whole) for k, (w, t, s, r) in enumerate(run.held)]
        first += run.number
    ranked = _ranked(sized, histogram)
    table = F.broadcast(items.sparkSession.createDataFrame(rows, "size long, low long, high long, first long, window int, slot int, tier int, length int"))
    held = (ranked["size"] == table["size"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    number = (F.col("first") + F.col("rank") - F.col("low")).alias("container")
    placed = ranked.join(table, held).select(number, "window", "slot", "doc_id", "part_no", ranked["size"].alias("n_tokens"), "tier", "length")
    steps = max(1, -(-first // step))
    turn, place = F.floor(F.col("container") / steps), F.col("container") % steps
    return placed.withColumn("step_no", F.when(turn % 2 == 0, place).otherwise(steps - 1 - place))
