"""Toxicity classifier: averaged embeddings of words and their character n-grams into a linear softmax."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.anchors import scramble
from lakeloom.llm.arrow import map_batches

# Lengths of the character n-grams of a word, its marked ends included; the whole word is one more subword.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
SIZE = 4  # numbers of an embedding
# Words of a usual text: its sum over words is divided by as many.
USUAL = 300
# An average is multiplied by this before the softmax, so that a word among hundreds can decide.
GAIN = 128.0
# Subwords in fewer documents of the sample are not learned from: a document could be told from all others by them.
LEAST = 10
# One document in so many is kept from the fit, to learn what its scores are worth.
ASIDE = 5
# Characters of a text whose words are counted at a time, and words whose margins a task remembers.
STRETCH = 1 << 20
REMEMBERED = 1 << 19
# Words whose subwords are hashed at a time.
HASHED = 1 << 14
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def count_words(text: str) -> Counter:
    """Words between white space, lower-cased, without punctuation at their ends, with their numbers."""
    found: Counter = Counter()
    begin = 0
    while begin < len(text):
        end = begin + STRETCH
        while end < len(text) and not text[end].isspace():
            end += 1
        found.update(text[begin:end].lower().split())
        begin = end
    words: Counter = Counter()
    for token, n in found.items():
        word = token if token.isalpha() else EDGE.sub("", token)
        if word:
            words[word] += n
    return words


def divisor(words: int) -> float:
    """What a sum over so many words is divided by.

    A word that a text has n times weighs as the root of n, since repetitions tell little more.  The squares of all weights
    add up to the number of words, whose root makes of the sum an average in units of its error: chance weighs less
    in long texts.
    """
    return max(1, words) ** 0.5 * USUAL**0.5


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, buckets): the buckets of word i are ``buckets[starts[i]:starts[i + 1]]``."""
    marked = [f"<{word}>" for word in words]
    sizes = np.array([len(word) for word in marked], dtype=np.int64)
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    letters = scramble(points + np.uint64(1))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(points))  # letters from here to the end of the word
    rows, hashes = [], []
    rolled = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolled = rolled[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + letters[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(left[: len(rolled)] >= n)
            rows.append(owner[at])
            hashes.append(scramble(rolled[at] + np.uint64(n)))
    # The whole word: a sum of its letters, each told by its place.
    place = (np.arange(len(points)) - (ends - sizes)[owner]).astype(np.uint64)
    whole = np.add.reduceat(scramble(letters + place * np.uint64(0xC2B2AE3D27D4EB4F)), ends - sizes) if len(words) else rolled
    rows.append(np.arange(len(words)))
    hashes.append(scramble(whole))
    row, order = np.concatenate(rows), np.argsort(np.concatenate(rows), kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))])
    return starts, (np.concatenate(hashes)[order] % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """What scoring needs of the trained embeddings and softmax: a bucket's margin of label 1 over label 0."""

    margins: np.ndarray
    slope: float
    offset: float

    def word_margins(self, words: list[str]) -> np.ndarray:
        """The mean margin of each word's subwords."""
        out = [np.empty(0)]
        for begin in range(0, len(words), HASHED):
            starts, buckets = subwords(words[begin : begin + HASHED])
            out.append(np.add.reduceat(self.margins[buckets], starts[:-1]) / np.diff(starts))
        return np.concatenate(out)

    def probability(self, mean: np.ndarray) -> np.ndarray:
        """Softmax of averaged embeddings, given their margins."""
        return 1 / (1 + np.exp(-np.clip(self.slope * mean + self.offset, -50, 50)))


class Scorer:
    """Scores texts; words met before are looked up."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def mean_margin(self, text: str) -> float:
        words = count_words(text)
        new = [word for word in words if word not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        self.known.update(zip(new, self.model.word_margins(new).tolist()))
        total = sum(self.known[word] * n**0.5 for word, n in words.items())
        return total / divisor(words.total())

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.model.probability(np.array([self.mean_margin(text) for text in texts], dtype=np.float64))


class Bags:
    """Documents as words, and words as buckets of subwords, in arrays."""

    def __init__(self, docs: list[tuple[list[str], list[int]]]) -> None:
        known = {word: n for n, word in enumerate(dict.fromkeys(word for words, _ in docs for word in words))}
        names, starts, buckets, before = list(known), [np.zeros(1, dtype=np.int64)], [np.empty(0, dtype=np.int64)], 0
        for begin in range(0, len(names), HASHED):
            own, found = subwords(names[begin : begin + HASHED])
            starts.append(own[1:] + before)
            buckets.append(found)
            before += len(found)
        self.starts, self.buckets = np.concatenate(starts), np.concatenate(buckets)
        self.words = [np.array([known[word] for word in words], dtype=np.int64) for words, _ in docs]
        self.weights = [np.sqrt(np.array(n, dtype=np.float64)) / divisor(sum(n)) for _, n in docs]

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many subwords each of the words has, and the buckets of all in a row."""
        sizes = self.starts[words + 1] - self.starts[words]
        at = np.repeat(self.starts[words] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return sizes, self.buckets[at]

    def rare(self, least: int) -> np.ndarray:
        """Buckets that fewer than ``least`` documents hold."""
        held = np.zeros(BUCKETS, dtype=np.int64)
        for words in self.words:
            held[np.unique(self.grams(words)[1])] += 1
        return held < least

    def mean_margins(self, margins: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(margins[self.buckets], self.starts[:-1]) if len(self.buckets) else np.empty(0)
        by_word = sums / np.diff(self.starts)
        return np.array([by_word[w] @ n for w, n in zip(self.words, self.weights)])


def train_table(bags: Bags, labels: np.ndarray, steps: int, batch: int, rate: float, seed: int, least: int) -> np.ndarray:
    """Embeddings and softmax trained together; returns each bucket's margin.

    Gradients of the cross entropy in shuffled batches, scaled per bucket by what came before (Adagrad); the two labels
    weigh alike in total.
    """
    random = np.random.default_rng(seed)
    rare = bags.rare(least)
    table = random.normal(0, 0.1, (BUCKETS, SIZE))
    table[rare] = 0
    soft, bias = random.normal(0, 0.5, (SIZE, 2)), np.zeros(2)
    table_seen, soft_seen, bias_seen = np.full(BUCKETS, 1e-6), np.full((SIZE, 2), 1e-6), np.full(2, 1e-6)
    fair = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum())) * len(labels)
    with_words = np.array([n for n, words in enumerate(bags.words) if len(words)], dtype=np.int64)
    epochs = -(-steps * batch // max(1, len(with_words)))
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        rows = random.permutation(with_words)
        for begin in range(0, len(rows), batch):
            own = rows[begin : begin + batch]
            word, inside = np.unique(np.concatenate([bags.words[n] for n in own]), return_inverse=True)
            weight = np.concatenate([bags.weights[n] for n in own])[:, None]
            sizes = np.array([len(bags.words[n]) for n in own])
            # Forward: subwords to words, words to documents, documents to the softmax.
            grams, buckets = bags.grams(word)
            bucket, among = np.unique(buckets, return_inverse=True)
            words = np.add.reduceat(table[bucket][among], np.cumsum(grams) - grams) / grams[:, None]
            mean = GAIN * np.add.reduceat(words[inside] * weight, np.cumsum(sizes) - sizes)
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            slope = (p - np.eye(2)[labels[own]]) * fair[own][:, None] / len(own)
            # Backward, the same way.
            to_word = np.repeat(slope @ soft.T * GAIN, sizes, axis=0) * weight
            to_word = np.stack([np.bincount(inside, column, len(word)) for column in to_word.T], axis=1)
            to_gram = np.repeat(to_word / grams[:, None], grams, axis=0)
            to_bucket = np.stack([np.bincount(among, column, len(bucket)) for column in to_gram.T], axis=1)
            to_bucket[rare[bucket]] = 0
            to_soft, to_bias = mean.T @ slope, slope.sum(axis=0)
            table_seen[bucket] += (to_bucket**2).mean(axis=1)
            soft_seen += to_soft**2
            bias_seen += to_bias**2
            table[bucket] -= pace * to_bucket / np.sqrt(table_seen[bucket])[:, None]
            soft -= pace * 0.1 * to_soft / np.sqrt(soft_seen)
            bias -= pace * 0.1 * to_bias / np.sqrt(bias_seen)
    return table @ (soft[:, 1] - soft[:, 0])


def calibrated(means: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the logistic curve from mean margins to label 1, where ``share`` of all documents have it."""
    weight = np.where(labels == 1, share / labels.sum(), (1 - share) / (len(labels) - labels.sum())) * len(labels)
    scale = max(float(means.std()), 1e-9)
    x = np.stack([means / scale, np.ones(len(means))], axis=1)
    curve = np.zeros(2)
    for _ in range(50):  # Newton's method, with a weak pull to zero
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        down = x.T @ (weight * (p - labels)) + 1e-2 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(bend, down)
        curve -= step / max(1.0, float(np.abs(step).max()))
    return max(float(curve[0]), 0.0) / scale, float(curve[1])


def fit(
    docs: list[tuple[list[str], list[int]]],
    labels: np.ndarray,
    share: float,
    steps: int = 720,
    batch: int = 48,
    rate: float = 0.3,
    seed: int = 7,
    least: int = LEAST,
) -> Model:
    """Train on documents given as words and their numbers, in about ``steps`` batches.

    ``share`` of all documents to be scored have label 1.

    One document in ASIDE is not trained on: by these the averaged margins become probabilities.  Without both labels
    in both parts the score is constant.
    """
    share = min(max(share, 1e-3), 1 - 1e-3)
    aside = np.arange(len(docs)) % ASIDE == ASIDE - 1
    parts = [(Bags([docs[n] for n in np.flatnonzero(own)]), labels[own]) for own in (~aside, aside)]
    if any(not 0 < own.sum() < len(own) for _, own in parts):
        return Model(np.zeros(BUCKETS), 0.0, float(np.log(share / (1 - share))))
    margins = train_table(*parts[0], steps, batch, rate, seed, least)
    return Model(margins, *calibrated(parts[1][0].mean_margins(margins), parts[1][1], share))


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    most: int = 2000,
    max_bytes: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit on a bounded sample of labelled rows: ``most`` with label 1 and twice as many with label 0 at most.

    Those with the smallest hash of their id are taken, and of these the ones whose text has ``max_bytes`` at most, whole.
    So the sample's word counts, never its texts, fit the driver.  Held-out ids and NULL ids or labels are left out; an
    id with several labels or texts counts once, with the smallest of each.  The share of label 1 is that of all labels
    that are not held out.
    """
    allowed = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    once = allowed.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").cast("long").alias("label"))
    share = once.agg(F.avg("label")).first()[0] or 0.0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = once.where("label = 1").orderBy(*order).limit(most)
    sample = sample.unionByName(once.where("label = 0").orderBy(*order).limit(2 * most))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    chosen = texts.where(F.octet_length("text") <= max_bytes).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            counts = [count_words(text) for text in _texts(batch.column(2))]
            yield {
                "doc_id": batch.column(0), "label": batch.column(1),
                "words": [list(c) for c in counts], "times": [list(c.values()) for c in counts],
            }

    rows = map_batches(
        chosen.select("doc_id", "label", "text"), run, "doc_id long, label long, words array<string>, times array<long>"
    )
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("label", "words", "times")).alias("r")).select("doc_id", "r.*")
    found = rows.orderBy(F.xxhash64("doc_id", F.lit("order")), "doc_id").toArrow()
    bags = list(zip(found["words"].to_pylist(), found["times"].to_pylist()))
    return fit(bags, found["label"].to_numpy().astype(np.int64), share)


def _texts(column: pa.Array) -> list[str]:
    return [(raw or b"").decode("utf-8", "replace") for raw in column.cast(pa.binary()).to_pylist()]


def toxicity_scores(
    docs: DataFrame, model: Model, toxic_from: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 from ``toxic_from`` on).

    A score depends on the text alone: its lower-cased words, each the mean of the trained vectors of its character
    n-grams and of itself, averaged, into the softmax.  A word never seen in training, as a misspelt one, has the
    vectors of the n-grams that it shares with others.  NULL counts as empty; texts without words have a score like any other.  Rows
    that repeat an id have a row each.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scorer = Scorer(model)
        for batch in batches:
            score = scorer.scores(_texts(batch.column(1)))
            yield {
                "doc_id": batch.column(0),
                "held_out": batch.column(2),
                "score": score,
                "predicted": (score >= toxic_from).astype(np.int32),
            }

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        held_out(id_col).alias("held_out"),
    )
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")
