"""Removal of long byte strings that also start earlier, by enhanced suffix arrays over the places that can repeat."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.anchors import BASES, LETTERS, Powers
from lakeloom.llm.arrow import map_batches, utf8
from lakeloom.llm.repeats import (
    Body,
    Units,
    covered,
    judged_runs,
    keyed,
    later_spans,
    spans_around_anchors,
    surroundings,
    with_spans,
)

# Bytes of surroundings in one array, which is closed at the next anchor, or part of a crowded one, beyond them.
ARRAY = 1 << 17
# Neighbours whose bytes are compared at a time.
COMPARED = 1 << 13


@dataclass(frozen=True)
class Suffixes:
    """Suffixes of some bodies in order, those of ``length`` bytes or more whose first ``length`` bytes occur twice."""

    body: np.ndarray
    offset: np.ndarray  # into the body
    common: np.ndarray  # bytes shared with the suffix before
    left: np.ndarray  # byte before the suffix, plus one; 0 at the start of a body


def suffix_array(bodies: list[bytes], length: int) -> Suffixes:
    """Sort the suffixes of the bodies and measure their common prefixes, which end with a body.

    Bytes are stored plus one, 0 standing for the end; no byte of UTF-8 text is 255.  Suffixes whose first bytes no
    other suffix has, by a hash, have no part in a repeat and are left out before the sort.
    """
    sizes = np.array([len(b) for b in bodies])
    width = int(sizes.max())
    flat = np.frombuffer(b"\xff".join([b"", *bodies, b"\xff" * width]), dtype=np.uint8) + np.uint8(1)
    begins = 1 + np.r_[0, np.cumsum(sizes + 1)[:-1]]
    counts = np.maximum(sizes - length + 1, 0)
    body = np.repeat(np.arange(len(bodies)), counts)
    offset = np.arange(len(body)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[body] + offset
    powers = Powers(BASES[0])
    starts = powers.spans(powers.prefix(LETTERS[flat]), at, at + length)
    order = np.argsort(starts)
    same = starts[order][1:] == starts[order][:-1]
    twice = np.sort(order[np.r_[False, same] | np.r_[same, False]])
    body, offset, at = body[twice], offset[twice], at[twice]
    rows = np.lib.stride_tricks.sliding_window_view(flat, width)[at]
    rows *= np.arange(width) < (sizes[body] - offset)[:, None]
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    rows = rows[order]
    common = np.zeros(len(rows), dtype=np.int64)
    for begin in range(1, len(rows), COMPARED):
        before, own = rows[begin - 1 : begin + COMPARED - 1], rows[begin : begin + COMPARED]
        alike = (own == before[: len(own)]) & (own != 0)
        common[begin : begin + COMPARED] = np.where(alike.all(axis=1), width, alike.argmin(axis=1))
    return Suffixes(body[order], offset[order], common, flat[at - 1][order])


def maximal_repeats(suffixes: Suffixes, length: int) -> Iterator[tuple[int, slice]]:
    """Groups (bytes, all suffixes) of the strings of at least ``length`` bytes that repeat and cannot be extended.

    The intervals of suffixes with a common prefix form a tree; a stack scan over the prefixes closes each interval,
    inner ones first.  One whose suffixes all follow the same byte repeats further to the left as well, so only the
    others are given.
    """
    common, left = suffixes.common, suffixes.left
    # Neighbours whose left sides differ; the start of a body differs from everything.
    differs = np.cumsum(np.r_[False, (left[1:] != left[:-1]) | (left[1:] == 0)])
    deep = np.flatnonzero(common >= length)
    if not len(deep):
        return
    stack: list[tuple[int, int]] = []  # (common prefix, first suffix of the interval)

    def close(down_to: int, last: int) -> Iterator[tuple[int, int, int]]:
        while stack and stack[-1][0] > down_to:
            depth, first = stack.pop()
            yield depth, first, last
            if stack and stack[-1][0] < down_to or not stack and down_to:
                stack.append((down_to, first))

    closed: list[tuple[int, int, int]] = []
    before = -2
    for at, depth in zip(deep.tolist(), common[deep].tolist()):
        if at != before + 1:
            closed.extend(close(0, before))
        if stack and stack[-1][0] > depth:
            closed.extend(close(depth, at - 1))
        if not stack or stack[-1][0] < depth:
            stack.append((depth, at - 1))
        before = at
    closed.extend(close(0, before))
    for depth, first, last in closed:
        if differs[last] > differs[first]:
            yield depth, slice(first, last + 1)


def later_occurrences(bodies: list[Body], length: int) -> tuple[np.ndarray, ...]:
    """(body, start, end) of all occurrences but the earliest of each maximal repeat."""
    docs, lows = (np.array([getattr(b, name) for b in bodies], dtype=np.int64) for name in ("doc", "lo"))
    suffixes = suffix_array([b.text for b in bodies], length)
    doc, start = docs[suffixes.body], lows[suffixes.body] + suffixes.offset
    place = np.lexsort((start, doc))
    earliness = np.empty(len(doc), dtype=np.int64)
    # The same place of a document may lie in several bodies.
    new = (doc[place][1:] != doc[place][:-1]) | (start[place][1:] != start[place][:-1])
    earliness[place] = np.cumsum(np.r_[True, new][: len(doc)])
    reach = np.zeros(len(doc), dtype=np.int64)
    for depth, group in maximal_repeats(suffixes, length):
        early = earliness[group]
        own = reach[group]
        own[(early > early.min()) & (own < depth)] = depth
    found = np.flatnonzero(reach)
    return suffixes.body[found], start[found], start[found] + reach[found]


def repeated_bytes(docs: DataFrame, units: Units, id_col: str, text_col: str) -> DataFrame:
    """Spans (doc, th, start, end) of bytes that lie in repeated strings; they may overlap."""
    texts = keyed(docs, id_col, text_col)
    judged = judged_runs(texts, units)
    bodies = surroundings(texts, judged, units)
    found = spans_around_anchors(bodies, units, lambda rows, _: later_occurrences(rows, units.length), ARRAY)
    return later_spans(judged, units).unionByName(found)


def suffix_dedup(
    docs: DataFrame, length: int = 100, gram: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document of a smaller id, or
    further up in its own.  Matches end with the document; overlaps count.  Texts are UTF-8 bytes, NULL is empty.
    Rows that repeat an id count as one document laid over itself; a NULL id orders before all others.  Other columns
    are ignored; an empty table gives no rows.

    A suffix array over the whole corpus would have to be one sorted sequence, so it is built where strings can repeat.
    Equal strings of ``length`` bytes share a winnowed anchor at the same place, so the runs around each anchor that
    occurs twice go together, each different run once.  Enhanced suffix arrays over such runs, of bounded size, are
    scanned for their common-prefix intervals, and those with different bytes to the left are the maximal repeats, with
    all occurrences.  The runs of an anchor that has very many are dealt over several arrays.  Each hands on the first
    occurrence of every class of equal beginnings of ``length`` bytes, and of these all but the earliest go as well.
    """
    units = Units("bytes", length, gram, inside=True)
    found = with_spans(docs, repeated_bytes(docs, units, id_col, text_col), id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {"doc_id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for row, text in enumerate(utf8(batch.column(1))):
                gone = covered(len(text), batch.column(2)[row], batch.column(3)[row])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()))
                out["kept"].append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if gone.any() else text)
            yield out

    return map_batches(found, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
