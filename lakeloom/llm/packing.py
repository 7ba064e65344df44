"""Packing of token pieces into sequences by a configuration linear program."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.arrow import map_batches
from lakeloom.session import materialize

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END = 0  # the id that ends each document
# Texts with more white space in a row go through the slower library.
LONG_SPACE = 100_000
SPACE_RUN = re.compile(r"\s+")


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + n): byte for n, byte in enumerate(others)}


class ByteBpe:
    """The byte-level BPE of a tokenizers file, whose ids order its merges, run by the faster library.

    Tokens, ids and added tokens are those of the file.  ``ids`` gives what ``tokenizers`` gives with
    add_special_tokens=False (tested on all code points and tokens): by its defaults, which cut a text at added tokens
    first, or, without ``added``, as with encode_special_tokens=True, which takes their strings as plain text.  The
    faster library fails on a million characters of white space in a row; texts with long runs go through ``tokenizers``.
    """

    def __init__(self, vocabulary: str, added: bool = True) -> None:
        self.vocabulary, self.added, self.second = vocabulary, added, None
        with open(vocabulary, encoding="utf-8") as file:
            loaded = json.load(file)
        for token in loaded["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"added token {token['content']!r} is not matched as it stands")
        value = _byte_values()
        special = {token["content"]: token["id"] for token in loaded["added_tokens"]}
        vocab = loaded["model"]["vocab"].items()
        self.ranks = {bytes(value[c] for c in token): rank for token, rank in vocab if token not in special}
        self.first = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens=special if added else {}
        )

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id of the vocabulary, added tokens aside."""
        found = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            found[rank] = token
        return found

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_SPACE and any(m.end() - m.start() > LONG_SPACE for m in SPACE_RUN.finditer(text)):
            if self.second is None:
                self.second = Tokenizer.from_file(self.vocabulary)
                self.second.encode_special_tokens = not self.added
            return np.array(self.second.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.first.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def pieces(docs: DataFrame, capacity: int, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    """Token pieces of all documents, written once: doc_id, piece, start, length, ids_crc32, part, nth.

    ``part`` is the task that made the piece and ``nth`` its place among that task's pieces of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoding = ByteBpe(vocabulary)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows, out = [], defaultdict(list)
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoding.ids(text or ""), END).astype("<u4")
                start, length = 0, len(ids) % capacity or capacity  # the first piece takes what is left over
                number = 0
                while start < len(ids):
                    rows.append(row)
                    out["piece"].append(number)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[start : start + length].tobytes()))
                    out["nth"].append(seen[length])
                    seen[length] += 1
                    start, length, number = start + length, capacity, number + 1
            if rows:
                yield {"doc_id": batch.column(0).take(pa.array(rows)), **out, "part": [part] * len(rows)}

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
    return materialize(map_batches(texts, run, schema), "pieces")


@dataclass(frozen=True)
class Packing:
    """Configurations (lengths, longest first) with the number of sequences that follow each."""

    used: list[tuple[tuple[int, ...], int]]
    lower_bound: int  # no packing has fewer sequences

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.used)


def _knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room from 0 to ``capacity``, and the length to put in first (0: none)."""
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    lengths = np.flatnonzero(price)
    worth = price[lengths]
    for room in range(1, capacity + 1):
        fitting = np.searchsorted(lengths, room, side="right")
        if fitting:
            options = value[room - lengths[:fitting]] + worth[:fitting]
            best = options.argmax()
            value[room], choice[room] = options[best], lengths[best]
    return value, choice


def solve(counts: dict[int, int], capacity: int, phases: int = 240) -> Packing:
    """Pack ``counts[length]`` pieces of each length into few sequences of ``capacity``.

    The linear program has a variable per configuration of lengths that fits a sequence, and asks that every length is
    covered.  Multiplicative weights price the lengths; a knapsack by dynamic programming finds, for every length at
    once, the best configuration that holds it.  Those within a percent of the best share the phase's plan, and lengths
    that it covers little gain weight, by smaller and smaller steps.  The mean of the later plans is close to the
    program's optimum, and each phase's prices prove a lower bound.  Rounding down leaves few pieces, which go by best
    fit, longest first, into the gaps and into new sequences.  Work and memory depend on the capacity, not on the number
    of pieces.
    """
    need = np.zeros(capacity + 1)
    for length, count in counts.items():
        need[length] = count
    lengths = np.flatnonzero(need)
    if not len(lengths):
        return Packing([], 0)
    bound = int(-(-int((need * np.arange(capacity + 1)).sum()) // capacity))
    weight = need[lengths] * lengths / capacity
    plan: Counter = Counter()
    for phase in range(phases):
        if phase == phases // 2:
            plan.clear()  # the first plans come from prices that are still far off
        price = np.zeros(capacity + 1)
        price[lengths] = weight / need[lengths]
        value, choice = _knapsack(price, capacity)
        worth = price[lengths] + value[capacity - lengths]
        total = float(weight.sum() / worth.max())
        bound = max(bound, int(np.ceil(total - 1e-6)))
        near = np.flatnonzero(worth >= 0.99 * worth.max())
        share = need[lengths[near]] / need[lengths[near]].sum()
        room = capacity - lengths[near]
        held = [[int(length)] for length in lengths[near]]
        while True:
            nxt = choice[room]
            live = np.flatnonzero(nxt)
            if not len(live):
                break
            for i, length in zip(live.tolist(), nxt[live].tolist()):
                held[i].append(length)
            room = room - nxt
        cover = np.zeros(capacity + 1)
        for config, part in zip(held, share.tolist()):
            plan[tuple(sorted(config, reverse=True))] += part * total
            for length in config:
                cover[length] += part * total
        # How often each length is covered; lengths met twice over gain nothing more.
        met = np.minimum(cover[lengths] / need[lengths], 2.0)
        weight = weight * np.exp(-3.0 / (phase + 3) * met)
        weight = np.maximum(weight / weight.sum(), 1e-12)
    return Packing(_rounded(plan, phases - phases // 2, need.astype(np.int64), capacity), bound)


def _rounded(plan: Counter, phases: int, left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    used: Counter = Counter()

    def take(config: tuple[int, ...], times: int) -> None:
        own = Counter(config)
        times = min(times, *(int(left[length]) // n for length, n in own.items()))
        if times > 0:
            used[config] += times
            for length, n in own.items():
                left[length] -= times * n

    ranked = sorted(plan.items(), key=lambda item: (-item[1], item[0]))
    for config, times in ranked:
        take(config, int(times / phases))
    # Full configurations of the plan whose pieces are still there: fractions rounded up.
    for config, _ in ranked:
        if sum(config) >= capacity * 0.99:
            take(config, 1)
    # Best fit, longest first, over groups of equal sequences: room -> configuration -> times.
    gaps: dict[int, Counter] = defaultdict(Counter)
    for config, times in used.items():
        gaps[capacity - sum(config)][config] += times
    rooms = np.array([sum(gaps[room].values()) if room in gaps else 0 for room in range(capacity + 1)])
    for length in range(capacity, 0, -1):
        todo = int(left[length])
        while todo:
            fitting = np.flatnonzero(rooms[length:])
            if not len(fitting):
                # New sequences, each as full of this length as it goes.
                each = min(capacity // length, todo)
                config, times, room = (length,) * each, todo // each, capacity - each * length
                todo -= times * each
                gaps[room][config] += times
                rooms[room] += times
                continue
            room = length + int(fitting[0])
            config, there = next(iter(gaps[room].items()))
            times = min(there, todo)
            todo -= times
            gaps[room][config] -= times
            if not gaps[room][config]:
                del gaps[room][config]
            grown = tuple(sorted((*config, length), reverse=True))
            gaps[room - length][grown] += times
            rooms[room] -= times
            rooms[room - length] += times
    return [(config, times) for room in sorted(gaps) for config, times in sorted(gaps[room].items()) if times]


def slots(packing: Packing) -> dict[str, np.ndarray]:
    """Where the pieces of a length go: those of rank ``rank`` on into sequences ``sequence`` on, at ``offset``."""
    rows, used, sequence = [], Counter(), 0
    for config, times in packing.used:
        offset = 0
        for length in config:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T))


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and END; NULL counts as empty, and an added token of the vocabulary that a text holds has
    its own id.  Documents longer than ``capacity`` are cut into
    pieces of that length, of which the first may be shorter.  Rows that repeat an id are packed like others.  Other
    columns are ignored; an empty table gives no rows.

    The histogram of piece lengths, ``capacity`` numbers at most, goes to the driver, where ``solve`` packs it; the
    slots it gives depend on the capacity, too.  Each piece then finds its slot by its rank among the pieces of its
    length: its place in its task plus the count of all tasks before, so that no length is gathered anywhere.
    """
    found = pieces(docs, capacity, vocabulary, id_col, text_col)
    counts = materialize(found.groupBy("length", "part").count(), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = slots(solve(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = found.join(materialize(starts, "starts"), ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # Lengths and ranks as one ascending key: a length's ranks lie between it and the next.
        first = np.searchsorted(places["length"], np.arange(capacity + 2))
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            length, rank = columns["length"].to_numpy(), columns.pop("rank").to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for value in np.unique(length):
                own = np.flatnonzero(length == value)
                ranks = places["rank"][first[value] : first[value + 1]]
                at[own] = first[value] + np.searchsorted(ranks, rank[own], side="right") - 1
            columns["sequence_id"] = places["sequence"][at] + rank - places["rank"][at]
            columns["offset"] = places["offset"][at]
            yield columns

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_batches(ranked, run, schema)
