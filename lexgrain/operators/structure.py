"""Vectorised structural index of XML text.

All fragments of an Arrow batch lie in one byte buffer.  Bitmaps of brackets and of both quote signs are built over
that buffer with numpy, without what stands in comments, CDATA sections, processing instructions and declarations;
prefix counts of the quotes tell the brackets that close a tag from those inside a value, nesting depth is a prefix
sum of +1 / -1, and element spans come from pairing the start and end tags of equal depth.  No fragment is walked in
Python; only the openings of comments and the like are visited one by one.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

#: Odd multiplier of the polynomial hash modulo 2**64 and its inverse.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@dataclass
class Elements:
    """Element spans of a buffer: `end` is -1 where the text is cut off inside the element."""

    fragment: np.ndarray
    start: np.ndarray
    end: np.ndarray
    depth: np.ndarray


def _last_before(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index into `marks` of the last mark before each position, -1 if none."""
    return np.searchsorted(marks, at, side="left") - 1


def _next_after(marks: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """First mark behind each position, `none` if there is none."""
    k = np.searchsorted(marks, at, side="right")
    return np.where(k < len(marks), marks[np.minimum(k, len(marks) - 1)], none) if len(marks) else np.full(len(at), none)


def _hidden_spans(buf: np.ndarray, bounds: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of comments, CDATA sections, processing instructions and declarations.

    One that is not closed reaches to the end of its fragment.
    """
    after = buf[np.minimum(opens + 1, len(buf) - 1)]
    starts, ends = [], []
    marked = opens[(after == ord("!")) | (after == ord("?"))]
    data = buf.tobytes() if len(marked) else b""
    done = 0
    for at in marked.tolist():
        if at < done:
            continue
        limit = int(bounds[np.searchsorted(bounds, at, side="right")])
        for opening, closing in ((b"<!--", b"-->"), (b"<![CDATA[", b"]]>"), (b"<?", b"?>"), (b"<!", b">")):
            if data.startswith(opening, at, limit):
                if opening == b"<!" and 0 <= data.find(b"[", at, limit) < data.find(b">", at, limit):
                    closing = b"]>"  # a document type with declarations of its own
                k = data.find(closing, at + len(opening), limit)
                done = limit if k < 0 else k + len(closing)
                break
        starts.append(at)
        ends.append(done)
    return np.array(starts, np.int64), np.array(ends, np.int64)


def _outside(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The marks outside the spans."""
    if not len(starts):
        return marks
    k = np.searchsorted(starts, marks, side="right") - 1
    return marks[(k < 0) | (marks >= ends[np.maximum(k, 0)])]


def _tag_ends(opens: np.ndarray, stops: np.ndarray, closes: np.ndarray, double: np.ndarray, single: np.ndarray, none: int) -> np.ndarray:
    """Closing bracket of the tag that begins at each opening bracket, -1 if it has none before its stop.

    Where only one kind of quote stands in a tag, a bracket outside values is one with an even number of them before
    it.  Tags with both kinds are followed value by value, all of them in step.
    """
    to = np.full(len(opens), -1, np.int64)
    owner = _last_before(opens, closes)
    close, owner = closes[owner >= 0], owner[owner >= 0]
    count = lambda marks, at: np.searchsorted(marks, at)
    even = (count(double, close) - count(double, opens[owner])) % 2 == 0
    first, k = np.unique(owner[even], return_index=True)
    to[first] = close[even][k]
    upto = np.where(to >= 0, to, np.concatenate([opens[1:], [none]])) if len(opens) else to
    live = np.flatnonzero(count(single, upto) > count(single, opens))
    to[live] = -1
    at = opens.copy()
    while len(live):
        here = at[live]
        bracket, quote, other = _next_after(closes, here, none), _next_after(double, here, none), _next_after(single, here, none)
        ends = bracket < np.minimum(quote, other)
        to[live[ends]] = bracket[ends]
        value_end = np.where(quote < other, _next_after(double, quote, none), _next_after(single, other, none))
        goes_on = ~ends & (value_end < stops[live])
        at[live[goes_on]] = value_end[goes_on]
        live = live[goes_on]
    return np.where(to < stops, to, -1)


def index_elements(buf: np.ndarray, bounds: np.ndarray) -> Elements:
    """Spans of all elements of the fragments buf[bounds[i]:bounds[i+1]] (uint8).

    Attribute values stand in double or single quotes and may hold '>' and the other quote; comments, CDATA sections,
    processing instructions and declarations hold no elements.  Malformed text yields the elements that can be paired,
    never an error.
    """
    none = np.zeros(0, np.int64)
    opens = np.flatnonzero(buf == ord("<"))
    if not len(opens):
        return Elements(none, none, none, none)
    hidden = _hidden_spans(buf, bounds, opens)
    opens, closes, double, single = (_outside(np.flatnonzero(buf == ord(c)), *hidden) for c in "<>\"'")
    frag = np.searchsorted(bounds, opens, side="right") - 1
    to = _tag_ends(opens, bounds[frag + 1], closes, double, single, len(buf))
    real = to >= 0
    if real.any():
        covered = np.concatenate([[-1], np.maximum.accumulate(np.where(real, to, -1))[:-1]])
        real &= opens > covered  # a bracket inside another tag's value opens nothing
    at, to, frag = opens[real], to[real], frag[real]
    if not len(at):
        return Elements(none, none, none, none)
    ending = buf[at + 1] == ord("/")
    void = (buf[to - 1] == ord("/")) & ~ending
    step = np.where(ending, -1, np.where(void, 0, 1))
    run = np.cumsum(step)
    first_of = np.searchsorted(frag, frag, side="left")
    depth = run - (run[first_of] - step[first_of])  # depth after the tag, counted from its fragment
    level = depth + (ending | void)  # depth inside the element
    order = np.lexsort((at, level, frag))
    order = order[~void[order]]
    o_frag, o_level, o_end = frag[order], level[order], ending[order]
    end = np.full(len(at), -1, np.int64)
    if len(order) > 1:
        paired = (o_frag[:-1] == o_frag[1:]) & (o_level[:-1] == o_level[1:]) & ~o_end[:-1] & o_end[1:]
        end[order[:-1][paired]] = to[order[1:][paired]] + 1
    end[void] = to[void] + 1
    starts = ~ending
    return Elements(frag[starts], at[starts], end[starts], level[starts])


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for buffers of up to `size` bytes."""
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)]), dtype=np.uint64) for x in (_BASE, _INVERSE))
    return up[1:], down


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hashes of buf[start:end], from one prefix sum over the buffer."""
    up, down = _powers(1 << max(16, (len(buf)).bit_length()))
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], dtype=np.uint64)])
        return (prefix[end] - prefix[start]) * down[start]
