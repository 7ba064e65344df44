"""Quality classifier: gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.arrow import bound_batches, map_batches, utf8

FEATURES = (
    "log_bytes log_words word_bytes upper digit punctuation symbol space not_ascii common_symbol ends_in_symbol "
    "ends_in_stop without_letter capitalised all_upper distinct_words distinct_pairs repeated_next top_word "
    "line_words distinct_lines entropy"
).split()

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SPACE = np.isin(_CODES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_STOP = np.isin(_CODES, list(b".,;:?"))
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOP) & ~np.isin(_CODES, list(b"'\"()-"))


def statistics(text: bytes) -> list[float]:
    """One number per feature; all are defined for every text, the empty one too."""
    raw = np.frombuffer(text, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    letters = max(1, counts[_LETTER].sum())
    words = text.split()
    n = max(1, len(words))
    known = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    del words
    times = np.unique(known, return_counts=True)[1]
    pairs = known[:-1] * np.int64(0x9E3779B97F4A7C15 >> 1) + known[1:]
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = raw[edges[::2]], raw[edges[1::2] - 1]
    letter_sums = np.r_[0, np.cumsum(_LETTER[raw])]
    upper_sums = np.r_[0, np.cumsum(_UPPER[raw])]
    in_word = letter_sums[edges[1::2]] - letter_sums[edges[::2]]
    upper_in_word = upper_sums[edges[1::2]] - upper_sums[edges[::2]]
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = counts[counts > 0] / size
    symbols = counts * _SYMBOL
    return [
        np.log1p(len(raw)),
        np.log1p(len(known)),
        (len(raw) - counts[_SPACE].sum()) / n,
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / size,
        counts[_STOP].sum() / size,
        symbols.sum() / size,
        counts[_SPACE].sum() / size,
        counts[128:].sum() / size,
        symbols.max() / size,
        _SYMBOL[last].sum() / n,
        _STOP[last].sum() / n,
        (in_word == 0).sum() / n,
        _UPPER[first].sum() / n,
        ((in_word > 1) & (upper_in_word == in_word)).sum() / n,
        len(times) / n,
        len(np.unique(pairs)) / n,
        (known[1:] == known[:-1]).sum() / n,
        times.max(initial=0) / n,
        len(known) / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)),
        float(-(share * np.log2(share)).sum()),
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(text) for text in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, level by level in arrays: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # values above it go right
    value: np.ndarray  # trees x leaves
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees walked down at once."""
        inner = self.feature.shape[1]
        tree = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(rows), len(self.feature)), dtype=np.int64)
        at = np.arange(len(rows))[:, None]
        while inner and node.size and node[0, 0] < inner:
            node = 2 * node + 1 + (rows[at, self.feature[tree, node]] > self.threshold[tree, node])
        total = self.start + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15
) -> Trees:
    """Boosted trees by histograms of gradients, for labels 0 and 1; without both labels a constant."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not 0 < labels.sum() < len(labels):
        empty = np.zeros((0, inner))
        return Trees(empty.astype(np.int64), empty, np.zeros((0, leaves)), start)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T)], axis=1)
    total = np.full(len(labels), start)
    out_feature, out_threshold, out_value = [], [], []
    ridge = 1.0
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = labels - p, p * (1 - p)
        node = np.zeros(len(labels), dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, base = 1 << level, (1 << level) - 1
            best = np.zeros(width)
            cut = np.full(width, -1)
            for f in range(rows.shape[1]):
                key = (node - base) * bins + binned[:, f]
                g = np.bincount(key, slope, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(key, bend, width * bins).reshape(width, bins).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + ridge)
                    + (whole_g - g) ** 2 / (whole_h - h + ridge)
                    - whole_g**2 / (whole_h + ridge)
                )
                gain[(h < 1) | (whole_h - h < 1)] = 0  # too little evidence on one side
                where = gain.argmax(axis=1)
                top = gain[np.arange(width), where]
                better = top > best
                best[better] = top[better]
                cut[better] = where[better]
                feature[base : base + width][better] = f
            for i in np.flatnonzero(cut >= 0):
                own = cuts[feature[base + i]]
                threshold[base + i] = own[cut[i]] if cut[i] < len(own) else np.inf
            values = rows[np.arange(len(rows)), feature[node]]
            node = 2 * node + 1 + (values > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, bend, leaves)
        value = rate * g / (h + ridge)
        total = total + value[leaf]
        out_feature.append(feature)
        out_threshold.append(threshold)
        out_value.append(value)
    return Trees(np.array(out_feature), np.array(out_threshold), np.array(out_value), start)


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text"
) -> Trees:
    """Fit on ``max_rows`` labelled rows at most, those with the smallest hash of their id.

    The bound makes the sample small enough to broadcast its ids and to bring its statistics, never its texts, to the
    driver.  Held-out ids and NULL ids or labels are left out; an id with several labels or texts counts once, with
    the smallest of each.
    """
    sample = (
        labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("long").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chosen = texts.join(F.broadcast(sample.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = matrix(utf8(batch.column(1)))
            columns = dict(zip(FEATURES, rows.T))
            yield {"doc_id": batch.column(0), "label": batch.column(2), **columns}

    schema = "doc_id long, label long, " + ", ".join(f"{name} double" for name in FEATURES)
    rows = map_batches(chosen.select("doc_id", "text", "label"), run, schema)
    once = rows.groupBy("doc_id").agg(F.min(F.struct("label", *FEATURES)).alias("r")).select("doc_id", "r.*")
    found = once.orderBy("doc_id").toPandas()
    return fit(found[FEATURES].to_numpy(dtype=np.float64), found["label"].to_numpy(dtype=np.float64))


def quality_scores(
    docs: DataFrame, model: Trees, keep_from: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 from ``keep_from`` on).

    A score depends on the text alone; NULL counts as empty, and empty texts have a score like any other.  Rows that
    repeat an id have a row each.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            score = model.score(matrix(utf8(batch.column(1))))
            yield {
                "doc_id": batch.column(0),
                "held_out": batch.column(2),
                "score": score,
                "predicted": (score >= keep_from).astype(np.int32),
            }

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        held_out(id_col).alias("held_out"),
    )
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Trees, keep_from: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_from``, with all their columns; no row is moved."""
    at = docs.columns.index(text_col)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(matrix(utf8(batch.column(at))))
            yield batch.filter(pa.array(score >= keep_from))

    return docs.mapInArrow(run, docs.schema)
