"""Alignment of two tokenizers' tokens by products of sparse incidence matrices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches
from lakeloom.llm.packing import ByteBpe
from lakeloom.session import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Rows of a matrix that are multiplied at a time.
ROWS = 1 << 16
# Characters that the second tokenizer takes at a time, up to the next word.
STRETCH = 1 << 20
# Most frequent links that every task holds; the others are joined.
HELD_LINKS = 1 << 18
MARK = "▁"  # stands for a space in pieces


@dataclass(frozen=True)
class Csr:
    """A sparse matrix of zeros and ones: row i has ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @classmethod
    def of_spans(cls, sizes: np.ndarray) -> Csr:
        """Rows that take the columns one after another, so many each: tokens and their parts."""
        starts = np.concatenate([[0], np.cumsum(sizes)])
        return cls(starts, np.arange(starts[-1]), int(starts[-1]))

    @classmethod
    def of_one_each(cls, columns: np.ndarray, width: int) -> Csr:
        """Rows of one column each: tokens and their groups."""
        return cls(np.arange(len(columns) + 1), columns, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        if (self.columns[1:] < self.columns[:-1]).any():
            rows = rows[np.argsort(self.columns, kind="stable")]
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), rows, len(self.starts) - 1)

    def entries_of_product(self, other: Csr) -> int:
        """The first pass of a product: its entries, met more than once or not, counted without forming them."""
        return int((other.starts[self.columns + 1] - other.starts[self.columns]).sum())

    def times(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of the product, row by row, for blocks of rows.

        Each row of the product is the sum of those rows of ``other`` that the row of this matrix names.
        """
        for begin in range(0, len(self.starts) - 1, ROWS):
            end = min(begin + ROWS, len(self.starts) - 1)
            named = self.columns[self.starts[begin] : self.starts[end]]
            row = np.repeat(np.arange(begin, end), np.diff(self.starts[begin : end + 1]))
            first, sizes = other.starts[named], other.starts[named + 1] - other.starts[named]
            if sizes.min(initial=1) == sizes.max(initial=1) == 1:
                column = other.columns[first]
            else:
                ends = np.cumsum(sizes)
                column = other.columns[np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)]
                row = np.repeat(row, sizes)
            key = row * other.width + column
            if (key[1:] < key[:-1]).any():
                key.sort()
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
            yield key[at] // other.width, key[at] % other.width, np.diff(np.append(at, len(key)))


class SecondTokenizer:
    """A sentencepiece model: ids of a text, and the bytes that each id stands for."""

    def __init__(self, model: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.pieces.get_piece_size()
        texts = [self.pieces.id_to_piece(i) for i in range(n)]
        self.known = [
            bytes([int(text[3:5], 16)]) if self.pieces.is_byte(i) else text.replace(MARK, " ").encode()
            for i, text in enumerate(texts)
        ]
        # Where no piece goes on with a space after another character, texts may be cut before such a space.
        self.words = not any(MARK in text.lstrip(MARK) for text in texts)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text, before which the model puts a space; very long texts go in parts that end with a word."""
        parts, begin = [], 0
        while True:
            end = begin + STRETCH
            while self.words and 0 < end < len(text) - 1 and not (text[end] == " " and text[end - 1] not in (" ", MARK)):
                end = text.find(" ", end + 1)
            if not self.words or not 0 < end < len(text) - 1:
                parts.append(np.array(self.pieces.encode(text[begin:]), dtype=np.int64))
                return np.concatenate(parts)
            parts.append(np.array(self.pieces.encode(text[begin:end]), dtype=np.int64))
            begin = end + 1  # the space is put there again


@dataclass(frozen=True)
class Alignment:
    """Tokens of one text by two tokenizers, whose bytes are the same, as matrices."""

    a: np.ndarray
    b: np.ndarray
    a_parts: Csr  # tokens x parts: bytes that no token's end divides, all of them in the same two tokens
    b_parts: Csr
    a_groups: Csr  # tokens x groups
    b_groups: Csr

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Alignment:
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        every = np.concatenate([a_ends, b_ends])
        every.sort(kind="stable")  # two runs in order
        again = every[1:] == every[:-1]
        ends, cuts = every[1:][again], every[np.concatenate([[True], ~again])] if len(every) else every
        a_parts = Csr.of_spans(np.diff(np.searchsorted(cuts, a_ends), prepend=-1))
        b_parts = Csr.of_spans(np.diff(np.searchsorted(cuts, b_ends), prepend=-1))
        a_groups = Csr.of_one_each(np.searchsorted(ends, a_ends), len(ends))
        b_groups = Csr.of_one_each(np.searchsorted(ends, b_ends), len(ends))
        return cls(a, b, a_parts, b_parts, a_groups, b_groups)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links (token of a, token of b, parts in common)."""
        return self.a_parts.times(self.b_parts.transposed())

    def together(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links (token of a, token of b, 1) of tokens in one group."""
        return self.a_groups.times(self.b_groups.transposed())

    def links_together(self) -> int:
        return self.a_groups.entries_of_product(self.b_groups.transposed())

    def group_text(self) -> bytes:
        """Ids by group, as ``a1,a2|b1;a3|b2,b3``."""
        a_group, b_group, n = self.a_groups.columns, self.b_groups.columns, self.a_groups.width
        a_upto = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=n))])
        b_upto = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=n))])
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int32)
        ids[np.arange(len(self.a)) + b_upto[a_group]] = self.a
        ids[np.arange(len(self.b)) + a_upto[b_group + 1]] = self.b
        after = np.full(len(ids), ord(","), dtype=np.uint8)
        after[a_upto[1:] + b_upto[:-1] - 1] = ord("|")
        after[a_upto[1:] + b_upto[1:] - 1] = ord(";")
        digits = np.ones(len(ids), dtype=np.int32)
        places = len(str(ids.max(initial=0)))
        for place in range(1, places):
            digits += ids >= 10**place
        ends = np.cumsum(digits + 1, dtype=np.int64)
        text = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
        text[ends - 1] = after
        for place in range(places):
            own = np.flatnonzero(digits > place) if place else slice(None)
            text[ends[own] - 2 - place] = ids[own] // 10**place % 10 + ord("0")
        return text[:-1].tobytes()


def _sizes(known: list[bytes]) -> np.ndarray:
    return np.array([len(token) for token in known], dtype=np.int64)


def aligned_rows(docs: DataFrame, first: str, second: str, width: int, id_col: str, text_col: str) -> DataFrame:
    """Per document its counts, the digest of its groups, and its links as ``pairs`` and ``times``; written once.

    A pair of ids is one number, a * ``width`` + b.  ``row`` tells rows of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        one, two = ByteBpe(first, added=False), SecondTokenizer(second)
        b_known = two.known
        a_sizes, b_sizes = _sizes(one.token_bytes()), _sizes(b_known)
        for batch in batches:
            out: dict = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "n_together", "groups_sha256")}
            pairs, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            sizes = [0]
            for raw in batch.column(2).cast(pa.binary()).to_pylist():
                counts, digest, found = (0, 0, 0, 0, 0), "", 0
                text = (raw or b"").decode("utf-8", "replace")
                a, b = (one.ids(" " + text).astype(np.int64), two.ids(text)) if text else ([], [])
                # A byte-level BPE gives back every text that is one; an invalid one was changed before it was encoded.
                if text and b"".join(map(b_known.__getitem__, b.tolist())) == b" " + raw and a_sizes[a].sum() == len(raw) + 1:
                    both = Alignment.of(a, b, a_sizes[a], b_sizes[b])
                    n_links, parts = 0, []
                    for i, j, _ in both.overlaps():
                        n_links += len(i)
                        parts.append(np.unique(a[i] * width + b[j], return_counts=True))
                    own, many = parts[0]
                    if len(parts) > 1:
                        own, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
                        many = np.bincount(at, np.concatenate([t for _, t in parts])).astype(np.int64)
                    pairs.append(own)
                    times.append(many)
                    found = len(own)
                    counts = len(a), len(b), both.a_groups.width, n_links, both.links_together()
                    digest = hashlib.sha256(both.group_text()).hexdigest()
                for name, value in zip(out, (*counts, digest)):
                    out[name].append(value)
                sizes.append(found)
            ends = pa.array(np.cumsum(sizes), pa.int32())
            out["pairs"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pairs)))
            out["times"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times)))
            yield {"row": batch.column(0), "doc_id": batch.column(1), **out}

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_together long, "
        "groups_sha256 string, pairs array<long>, times array<long>"
    )
    return materialize(map_batches(rows, run, schema), "aligned")


def link_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many documents hold each pair of ids linked, and whether no pair of its first id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("a", F.floor(F.col("pair") / width)), "links")
    tops = materialize(counts.groupBy("a").agg(F.max("n").alias("top")), "tops")  # a row per id
    return materialize(counts.join(tops, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "counts")


def most_frequent(counts: DataFrame, most: int) -> tuple[pa.Table, bool]:
    """The pairs of the highest counts, ``most`` or fewer, and whether these are all.

    Pairs are counted by the size of their count, eight steps for each doubling, which gives the step from which on all
    fit.  So no task sends more than it has to the driver, which gets ``most`` rows at most.
    """
    step = F.floor(F.log2("n") * 8)
    sizes = {row["step"]: row["count"] for row in counts.groupBy(step.alias("step")).count().collect()}
    least, left = None, most
    for own in sorted(sizes, reverse=True):
        if sizes[own] > left:
            break
        least, left = own, left - sizes[own]
    top = counts.where(F.lit(False) if least is None else step >= least)
    return top.toArrow(), least == min(sizes, default=None)


def align_tokens(
    docs: DataFrame,
    first: str = BYTE_BPE,
    second: str = PIECES,
    held: int = HELD_LINKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_together, n_best, count_sum, groups_sha256.

    The text with a space before it is encoded by a byte-level BPE (``first``, ids A) and by a sentencepiece model
    (``second``, ids B), strings of special tokens as plain text.  Tokens whose byte ranges overlap are linked: the
    product of the token-part matrices, A times B transposed, where the ends of all tokens cut the bytes into parts.  Offsets where tokens of both end cut the tokens into
    groups; ``n_together`` counts the links of tokens in one group, the product of the token-group matrices.  The count
    of a pair of ids is the number of documents that hold it linked; ``n_best`` counts the links whose count is the
    highest of their A id, ties included, and ``count_sum`` adds up the counts of all links.

    A text that is NULL, empty, or not given back byte by byte by both (one with U+2581) has no tokens: zeros, and ""
    as digest.  Rows that repeat an id are documents of their own; a NULL id stays NULL.  Other columns are ignored,
    whatever their names; an empty table gives no rows.

    Documents are encoded once and written with their distinct links, which grow with the text.  Counting combines on
    the map side.  The ``held`` most frequent pairs, a bounded table, go to every task; only the other links, none of
    them frequent, are shuffled to meet their counts.
    """
    width = sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()
    aligned = aligned_rows(docs, first, second, width, id_col, text_col)
    counts = link_counts(aligned, width)
    top, whole = most_frequent(counts, held)
    order = np.argsort(top["pair"].to_numpy())
    known = top["pair"].to_numpy()[order]
    # A link's count, and its count as a best one.
    n = top["n"].to_numpy()[order]
    best = top["best"].to_numpy()[order].astype(np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            pairs, times = columns.pop("pairs"), columns.pop("times")
            sizes = pairs.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            pair, many = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            found = known[at] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            own, at = row[found], at[found]
            total, firsts = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
            np.add.at(total, own, n[at] * many[found])
            np.add.at(firsts, own, best[at] * many[found])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=len(sizes)))]), pa.int32())
            yield {
                **columns, "n_best": firsts, "count_sum": total,
                "pairs": pa.ListArray.from_arrays(ends, pa.array(pair[~found])),
                "times": pa.ListArray.from_arrays(ends, pa.array(many[~found])),
            }

    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_together long, "
        "groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<long>"
    )
    names = "doc_id n_a n_b n_groups n_links n_together n_best count_sum groups_sha256".split()
    weighed = map_batches(aligned, weigh, schema)
    if whole:
        return weighed.select(names)
    weighed = materialize(weighed, "weighed")
    others = weighed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    others = materialize(others.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("t")), "others")
    sums = others.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("t")).alias("more_sum"),
    )
    joined = weighed.join(materialize(sums, "sums"), "row", "left")
    for name, more in (("n_best", "more_best"), ("count_sum", "more_sum")):
        joined = joined.withColumn(name, F.col(name) + F.coalesce(more, F.lit(0)))
    return joined.select(names)
