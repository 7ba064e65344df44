"""Exact top-k search by inner product, block by block, with bounds that let blocks be skipped."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches
from lakeloom.session import materialize

# Vectors of a block, vectors of a shelf of blocks, and queries that visit a shelf together.
BLOCK = 512
SHELF = 8 * BLOCK
BUNDLE = 2048
# Shelves that a query visits first, to learn how good its k best are at least.
FIRST = 2
# Queries whose best a task holds at a time.
HELD_QUERIES = 1 << 16
# Products and sums of whole numbers below this are exact in doubles.
EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, x) with x = floor(scale * component); vectors that are, or hold, NULL or no number are left out."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(~bad, whole).alias("x"))
    return rows.where("vec_id is not null and x is not null")


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Rows of up to ``size`` vectors of consecutive ids: part, number, dims, ids and matrix (64-bit numbers)."""
    ordered = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        rows: list[list[int]] = []

        def close() -> dict:
            matrix = np.array(rows, dtype="<i8").tobytes()
            return {
                "part": [part],
                "number": [number],
                "dims": [len(rows[0])],
                "ids": [np.array(ids, dtype="<i8").tobytes()],
                "matrix": [matrix],
            }

        for batch in batches:
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (len(ids) == size or len(row) != len(rows[0])):
                    yield close()
                    ids, rows, number = [], [], number + 1
                ids.append(key)
                rows.append(row)
        if ids:
            yield close()

    return map_batches(ordered, run, "part long, number long, dims long, ids binary, matrix binary")


class Shelf:
    """A forward index of blocks: their vectors, and the largest and smallest value of each component per block."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        starts = range(0, len(ids), BLOCK)
        self.ids = [ids[at : at + BLOCK] for at in starts]
        self.whole = [matrix[at : at + BLOCK] for at in starts]
        self.exact = [block.astype(np.float64) for block in self.whole]
        self.most = np.array([np.abs(block).max(initial=0) for block in self.exact])
        self.high = np.array([block.max(axis=0) for block in self.exact])
        self.low = np.array([block.min(axis=0) for block in self.exact])
        self.looked = 0  # blocks scored

    def top(
        self,
        key: int,
        query: np.ndarray,
        k: int,
        known: tuple[np.ndarray, np.ndarray] = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)),
        least: float = -np.inf,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) of the shelf and of those ``known``, ties to smaller ids; fewer if there are fewer.

        Scores below ``least`` need not be found.  No vector of a block scores above the block's bound, the sum of its
        best values per component.  Blocks are taken in the order of their bounds until these fall below the k-th
        score; a block that could tie is scored.
        """
        ask = query.astype(np.float64)
        bounds = np.maximum(self.high * ask, self.low * ask).sum(axis=1)
        exact = np.abs(ask).sum() * self.most < EXACT
        bounds[~exact] = np.inf  # rounded sums prove nothing
        ids, scores = known
        for at in np.argsort(-bounds, kind="stable"):
            full = len(scores) == k
            if bounds[at] < (max(least, scores[-1]) if full else least):
                break
            self.looked += 1
            score = (self.exact[at] @ ask).astype(np.int64) if exact[at] else self.whole[at] @ query
            own = self.ids[at]
            keep = own != key
            if full:
                keep &= score >= scores[-1]
            ids, scores = np.r_[ids, own[keep]], np.r_[scores, score[keep]]
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
        return ids, scores


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i8")


def shelf_edges(shelves: DataFrame) -> DataFrame:
    """(dims, part, numbers, highs, lows): the largest and smallest value of each component, for all shelves of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {name: batch.column(name) for name in ("dims", "part", "number")}
            matrices = [
                _numbers(raw).reshape(-1, dims) if dims else np.zeros((1, 0), dtype="<i8")
                for raw, dims in zip(batch.column("matrix").to_pylist(), columns["dims"].to_pylist())
            ]
            high, low = [m.max(axis=0).tobytes() for m in matrices], [m.min(axis=0).tobytes() for m in matrices]
            yield {**columns, "high": high, "low": low}

    rows = shelves.select("dims", "part", "number", "matrix")
    edges = map_batches(rows, run, "dims long, part long, number long, high binary, low binary")
    shelf = F.collect_list(F.struct("number", "high", "low")).alias("shelves")
    edges = edges.groupBy("dims", "part").agg(shelf)
    return materialize(edges, "edges")


def bounds(asked: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What no product of each query with a vector between the edges exceeds; rounding is allowed for."""
    ask = asked.astype(np.float64)
    up, down = high.astype(np.float64), low.astype(np.float64)
    sums = np.maximum(ask, 0) @ up + np.minimum(ask, 0) @ down
    scale = np.abs(ask) @ np.maximum(np.abs(up), np.abs(down))
    # Sums of whole numbers up to EXACT are exact; larger ones are off by a small share of their scale.
    return np.where(scale < EXACT, sums, sums + scale * 1e-9)


def _bounded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, vectors and least scores of a bundle, and the bounds of its queries (rows) on the shelves of a part."""
    keys, least = _numbers(row["keys"]), np.frombuffer(row["least"], dtype="<f8")
    asked = _numbers(row["asked"]).reshape(len(keys), row["dims"])
    columns = [bounds(asked, _numbers(s["high"]), _numbers(s["low"])) for s in row["shelves"]]
    return keys, asked, least, np.stack(columns, axis=1)


def _meetings(bundles: DataFrame, edges: DataFrame) -> DataFrame:
    """Bundles beside the edges of each part of their dimension; the numbers of parts are all that is broadcast."""
    parts = edges.select("dims", "part")
    return bundles.join(F.broadcast(parts), "dims").join(edges, ["dims", "part"])


def first_visits(bundles: DataFrame, edges: DataFrame) -> DataFrame:
    """VISIT rows of each query on the FIRST shelves of its highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, asked, _, bound = _bounded(row)
                order = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
                n, each = order.shape
                number = np.array([s["number"] for s in row["shelves"]])[order].ravel()
                yield {
                    "bundle": [row["bundle"]] * n * each, "dims": [row["dims"]] * n * each, "part": [row["part"]] * n * each,
                    "number": number, "key": np.repeat(keys, each),
                    "bound": np.take_along_axis(bound, order, axis=1).ravel(),
                }

    schema = "bundle long, dims long, part long, number long, key long, bound double"
    found = map_batches(_meetings(bundles, edges), run, schema)
    place = F.row_number().over(Window.partitionBy("bundle", "key").orderBy(F.col("bound").desc(), "part", "number"))
    chosen = found.withColumn("place", place).where(F.col("place") <= FIRST)
    # A bundle's queries on one shelf, a bounded number.
    chosen = chosen.groupBy("bundle", "dims", "part", "number").agg(F.collect_list("key").alias("some"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _numbers(row["keys"])
                own = np.flatnonzero(np.isin(keys, row["some"]))
                yield _visit(row, row["number"], keys, _numbers(row["asked"]).reshape(len(keys), row["dims"]), None, own)

    return map_batches(chosen.join(bundles, ["bundle", "dims"]), cut_out, VISIT)


VISIT = "bundle long, dims long, part long, number long, some binary, vectors binary, least binary"


def _visit(
    row: dict, number: int, keys: np.ndarray, asked: np.ndarray, least: np.ndarray | None, own: np.ndarray
) -> dict:
    least = np.full(len(keys), -np.inf) if least is None else least
    return {
        "bundle": [row["bundle"]], "dims": [row["dims"]], "part": [row["part"]], "number": [number],
        "some": [keys[own].tobytes()], "vectors": [asked[own].tobytes()], "least": [least[own].astype("<f8").tobytes()],
    }


def needed_visits(bundles: DataFrame, edges: DataFrame) -> DataFrame:
    """VISIT rows of the shelves whose bound reaches ``least``, the score that a query's k-th best has at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, asked, least, bound = _bounded(row)
                for shelf, own in zip(row["shelves"], (bound >= least[:, None]).T):
                    if own.any():
                        yield _visit(row, shelf["number"], keys, asked, least, np.flatnonzero(own))

    return map_batches(_meetings(bundles, edges), run, VISIT)


def best_found(visits: DataFrame, shelves: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, looked, skipped): the k best per query of what a task sees, merged before they are written.

    ``looked`` and ``skipped`` count, on one row of those written together, blocks that were scored and blocks that were not.
    """
    pairs = visits.join(shelves, ["dims", "part", "number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        nothing = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        looked = skipped = 0

        def close() -> Iterator[dict]:
            sizes = [len(ids) for ids, _ in best.values()]
            if n := sum(sizes):
                yield {
                    "query_id": np.repeat(np.array(list(best)), sizes),
                    "vec_id": np.concatenate([ids for ids, _ in best.values()]),
                    "score": np.concatenate([scores for _, scores in best.values()]),
                    "looked": [looked] + [0] * (n - 1), "skipped": [skipped] + [0] * (n - 1),
                }

        for batch in batches:
            for row in batch.to_pylist():
                shelf = Shelf(_numbers(row["ids"]), _numbers(row["matrix"]).reshape(len(row["ids"]) // 8, row["dims"]))
                keys, least = _numbers(row["some"]).tolist(), np.frombuffer(row["least"], dtype="<f8").tolist()
                if len(best) + len(keys) > HELD_QUERIES:
                    yield from close()
                    best, looked, skipped = {}, 0, 0
                for key, floor, query in zip(keys, least, _numbers(row["vectors"]).reshape(len(keys), row["dims"])):
                    best[key] = shelf.top(key, query, k, best.get(key, nothing), floor)
                looked += shelf.looked
                skipped += len(keys) * len(shelf.ids) - shelf.looked
        yield from close()

    return map_batches(pairs, run, "query_id long, vec_id long, score long, looked long, skipped long")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k best vectors of each query: query_id, rank (from 1), vec_id, score.

    Vectors and queries are made whole numbers, floor(scale * component); the score is their inner product, which has
    to fit 64 bits, and ties go to the smaller id.  A query meets all rows but those of its own id, and only vectors
    of as many components.  Vectors that are NULL or hold NULL or a component that is not finite take no part, nor do
    NULL ids.  Rows that repeat an id are candidates of their own; a repeated query asks once, with its smallest
    vector.  Other columns are ignored; empty tables give no rows.

    Blocks of consecutive ids stand on shelves of bounded size, and queries go in bundles.  A first pass lets each query
    visit the FIRST shelves of its highest bounds, which gives a score that its k-th best has at least.  With this score
    the bundles meet the edges of all shelves, and only queries whose bound on a shelf reaches it are joined to that
    shelf.  A task merges what it finds before it writes, so that a query has at most k rows per task.
    """
    return ranked(search(vectors, queries, k, scale, id_col, vector_col), k)


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Candidates of both passes, the k best of each query among them; see ``best_found`` for the columns."""
    shelves = materialize(packed(whole_vectors(vectors, id_col, vector_col, scale), SHELF), "shelves")
    asked = whole_vectors(queries, id_col, vector_col, scale).groupBy("vec_id").agg(F.min("x").alias("x"))
    bundles = packed(asked, BUNDLE).select(
        F.shiftleft("part", 32).bitwiseOR(F.col("number")).alias("bundle"), "dims", F.col("ids").alias("keys"),
        F.col("matrix").alias("asked"),
    )
    bundles = materialize(bundles, "bundles")
    edges = shelf_edges(shelves)
    nothing = _with_least(bundles, None)
    first = materialize(best_found(first_visits(nothing, edges), shelves, k), "first")
    # The k-th of the best found so far; a task brought at most k of them.
    scores = first.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False).alias("scores"))
    least = scores.select("query_id", F.get("scores", F.lit(k - 1)).alias("least")).where("least is not null")
    known = _with_least(bundles, materialize(least, "least"))
    return best_found(needed_visits(materialize(known, "known"), edges), shelves, k)


def _with_least(bundles: DataFrame, least: DataFrame | None) -> DataFrame:
    """Bundles with the score that each query's k-th best has at least, minus infinity if none is known."""
    none = F.array().cast("array<long>")
    if least is None:
        rows = bundles.select("bundle", "dims", "keys", "asked", none.alias("ids"), none.alias("scores"))
    else:

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for bundle, keys in zip(*(column.to_pylist() for column in batch.columns)):
                    keys = _numbers(keys)
                    yield {"bundle": np.full(len(keys), bundle), "query_id": keys}

        own = map_batches(bundles.select("bundle", "keys"), members, "bundle long, query_id long").join(least, "query_id")
        own = own.groupBy("bundle").agg(F.collect_list("query_id").alias("ids"), F.collect_list("least").alias("scores"))
        columns = [F.coalesce(name, none).alias(name) for name in ("ids", "scores")]
        rows = bundles.join(own, "bundle", "left").select("bundle", "dims", "keys", "asked", *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {name: batch.column(name) for name in ("bundle", "dims", "keys", "asked")}
            out = []
            for keys, ids, scores in zip(*(batch.column(n).to_pylist() for n in ("keys", "ids", "scores"))):
                known = dict(zip(ids, scores))
                out.append(np.array([known.get(key, -np.inf) for key in _numbers(keys).tolist()], dtype="<f8").tobytes())
            yield {**columns, "least": out}

    return map_batches(rows, run, "bundle long, dims long, keys binary, asked binary, least binary")


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def skipped_share(found: DataFrame) -> float:
    """The share of a query's blocks on the shelves it visited that were not scored; see ``search``."""
    row = found.agg(F.sum("looked"), F.sum("skipped")).first()
    return row[1] / max(1, row[0] + row[1]) if row[0] is not None else 0.0
