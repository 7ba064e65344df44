"""Removal of long word sequences that documents of smaller ids hold too, by seeds and their extension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

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

# Bytes of surroundings that are extended at a time.
HELD = 1 << 20


def _split(classes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Split each class by a further value."""
    return np.unique(classes * (int(by.max()) + 1) + by, return_inverse=True)[1]


def extended(bodies: list[Body], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(body, start, end) of the maximal stretches that also start in a smaller document, ``length`` words or longer.

    Bodies with the same anchor, word by word, are one class.  Their match is extended a word at a time, to the left and to
    the right: a class falls apart where the next words differ, and a body whose words end is a class of its own.  Bodies
    that stay together for r words to the left and ``length - gram - r`` to the right share that window.
    """
    reach, m = length - gram, len(bodies)
    known: dict[bytes, int] = {}
    words = np.zeros((m, reach + gram + reach), dtype=np.int64)
    for n, body in enumerate(bodies):
        own = [known.setdefault(word, len(known)) for word in body.text.split()]
        begin = reach - body.back
        words[n, begin : begin + len(own)] = own
        words[n, :begin] = words[n, begin + len(own) :] = -1
    words = np.where(words < 0, len(known) + np.arange(m)[:, None], words)
    seeds = np.unique(np.array([b.hash for b in bodies], dtype=np.int64), return_inverse=True)[1]
    for at in range(reach, reach + gram):
        seeds = _split(seeds, words[:, at])
    right = [seeds]
    for at in range(reach + gram, reach + gram + reach):
        right.append(_split(right[-1], words[:, at]))
    docs = np.array([b.doc for b in bodies], dtype=np.int64)
    shared = np.zeros((m, reach + 1), dtype=bool)
    left = seeds
    for r in range(reach + 1):
        if r:
            left = _split(left, words[:, reach - r])
        both = _split(left, right[reach - r])
        first = np.full(int(both.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, both, docs)
        shared[:, reach - r] = docs > first[both]
    # Windows in a row, by their start before the anchor, are one stretch.
    edges = np.diff(np.pad(shared.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    body, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    anchor = np.array([b.lo + b.back for b in bodies], dtype=np.int64)[body]
    return body, anchor - reach + begin, anchor - reach + end - 1 + length


def repeated_spans(docs: DataFrame, units: Units, id_col: str, text_col: str) -> DataFrame:
    """Spans (doc, th, start, end) of words that lie in repeated windows; they may overlap."""
    texts = keyed(docs, id_col, text_col)
    judged = judged_runs(texts, units)
    bodies = surroundings(texts, judged, units)
    found = spans_around_anchors(bodies, units, lambda rows, _: extended(rows, units.length, units.gram), HELD)
    return later_spans(judged, units).unionByName(found)


def substring_dedup(
    docs: DataFrame, length: int = 50, gram: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text.

    A word goes if it lies in ``length`` consecutive words that also start in a document of a smaller id.  Words are
    cut at white space and compared as they are; NULL and empty texts have none.  The words that stay are joined by
    one space.  Rows that repeat an id have a row each and do not take words from each other; a NULL id orders before
    all others.  Other columns are ignored; an empty table gives no rows.

    Seeds: every window of ``length`` words has one winnowed anchor, the smallest gram hash in it, so documents that
    share a window share an anchor.  Only anchors in several documents are followed.  Occurrences of an anchor whose
    whole reach, ``length - gram`` words to either side, has equal hashes of 128 bits are settled at once by the smallest of
    their ids.  The first of each are joined by anchor and extended: word by word, both ways, in classes that fall apart
    where words differ, so that no pair of documents is ever formed; the maximal stretches of ``length`` words or more are
    kept.  Where an anchor has very many different surroundings, they are extended in parts, whose first occurrences
    are compared across the parts.
    """
    units = Units("words", length, gram, inside=False)
    found = with_spans(docs, repeated_spans(docs, units, id_col, text_col), id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            totals, removed, texts = [], [], []
            for row, text in enumerate(utf8(batch.column(1))):
                words = text.split()
                gone = covered(len(words), batch.column(2)[row], batch.column(3)[row])
                kept = b" ".join([word for word, out in zip(words, gone.tolist()) if not out])
                totals.append(len(words))
                removed.append(int(gone.sum()))
                texts.append(kept.decode())
            yield {"doc_id": batch.column(0), "n_words": totals, "n_removed": removed, "kept_text": texts}

    return map_batches(found, run, "doc_id long, n_words long, n_removed long, kept_text string")
