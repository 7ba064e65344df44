"""Near duplicates by 64-bit SimHash, found through an index of the bytes at each position."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches, utf8
from lakeloom.llm.bitmap import maybe_in, without
from lakeloom.llm.components import components
from lakeloom.session import materialize

POSITIONS = 8
# Postings of at most this many fingerprints have their pairs tallied one by one.
FEW = 32
# Shingles of a text that are hashed at a time.
SHINGLES = 1 << 16
LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    counts = np.zeros(64, dtype=np.int64)
    pad = -len(hashes) % 255
    rows = np.concatenate([hashes, np.zeros(pad, dtype=np.uint64)]).reshape(-1, 255)
    for bit in range(8):
        # Eight counters of one byte in each word, which 255 summands cannot overflow.
        lanes = ((rows >> np.uint64(bit)) & LANES).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0)
    return counts


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the word shingles: XXH64 with seed 42 of each, A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    shingle = min(shingle, len(words))
    n = len(words) - shingle + 1
    del words
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES):
        stop = min(n, at + SHINGLES)
        spans = zip(starts[at:stop].tolist(), ends[at + shingle - 1 : stop + shingle - 1].tolist())
        counts += bit_counts(np.array([digest(joined[start:end], 42) for start, end in spans], dtype=np.uint64))
    return sum(1 << int(bit) for bit in np.flatnonzero(counts * 2 > n))


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str, digest: bool = False) -> DataFrame:
    """doc_id and fp of each row, and the digest of its text (NULL of NULL) if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = np.array([fingerprint(text, shingle) for text in utf8(batch.column(1))], dtype=np.uint64)
            found = {"doc_id": batch.column(0), "fp": values.view(np.int64)}
            yield found | {"digest": batch.column(2)} if digest else found

    text = F.col(f"`{text_col}`")
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), text]
    columns += [_digest(text).alias("digest")] if digest else []
    schema = "doc_id long, fp long" + (", digest binary" if digest else "")
    return map_batches(docs.select(*columns), run, schema)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _tallied(fps: np.ndarray, lengths: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs inside the postings of at most FEW fingerprints, which lie one after the other."""
    group = np.repeat(np.arange(len(lengths)), lengths)
    for step in range(1, min(FEW, int(lengths.max(initial=1)))):
        near = np.flatnonzero(group[step:] == group[:-step])
        if not len(near):
            return
        a, b = fps[near], fps[near + step]
        apart = a ^ b
        shared = (apart.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
        linked = (shared >= POSITIONS - distance) & (np.bitwise_count(apart) <= distance)
        yield a[linked], b[linked]


def _hung(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what pairs within the distance connect, for a posting with many fingerprints.

    All of them agree outside a few bytes, so each finds its neighbours by flipping up to ``distance`` of those bits.
    """
    fps = np.sort(fps)
    varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [1 << i for i in range(64) if varying >> i & 1]
    label = np.arange(len(fps))
    neighbours = []
    for n in range(1, distance + 1):
        for flips in combinations(bits, n):
            other = fps ^ np.uint64(sum(flips))
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            found = np.flatnonzero(fps[at] == other)
            if len(found):
                neighbours.append((found, at[found]))
    changed = True
    while changed:
        before = label.copy()
        for a, b in neighbours:
            np.minimum.at(label, a, label[b])
        label = label[label]
        changed = not np.array_equal(before, label)
    moved = label != np.arange(len(fps))
    yield fps[moved], fps[label[moved]]


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect all pairs of at most ``distance`` differing bits.

    Pairs that close share at least 8 - distance positional bytes.  The index holds each fingerprint under every
    choice of that many positions and their bytes, so two of them meet in a posting exactly when their tally of shared
    bytes reaches that minimum.  The members of a posting differ in ``distance`` bytes only: 65,536 at most for two,
    however hot it is.  Small postings have their pairs tallied and verified; in larger ones each member looks its
    neighbours up, and only links that connect are given, not all pairs.
    """
    choices = []
    for number, left_out in enumerate(combinations(range(POSITIONS), distance)):
        mask = sum(255 << 8 * p for p in range(POSITIONS) if p not in left_out)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        choices.append(F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bytes")))
    posted = prints.select("fp", F.explode(F.array(*choices)).alias("p")).select("p.choice", "p.bytes", "fp")
    posted = posted.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[np.ndarray] = []  # the last posting, which may go on in the next batch
        for batch in chain(batches_of(batches), [None]):
            if batch is not None:
                held.append(batch)
            if not held:
                return
            rows = np.concatenate(held)
            new = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])) + 1
            bounds = np.concatenate([[0], new, [len(rows)]])
            closed = len(bounds) - 1 if batch is None else len(bounds) - 2
            held = [rows[bounds[closed] :]] if batch is not None else []
            lengths = np.diff(bounds[: closed + 1])
            fps = np.ascontiguousarray(rows[: bounds[closed], 2]).view(np.uint64)
            small = np.repeat((lengths > 1) & (lengths <= FEW), lengths)
            pairs = list(_tallied(fps[small], lengths[(lengths > 1) & (lengths <= FEW)], distance))
            for i in np.flatnonzero(lengths > FEW):
                pairs.extend(_hung(fps[bounds[i] : bounds[i + 1]], distance))
            for u, v in pairs:
                yield {"u": u.view(np.int64), "v": v.view(np.int64)}

    return map_batches(posted, run, "u long, v long").distinct()


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield np.stack([column.to_numpy(zero_copy_only=False).astype(np.int64) for column in batch.columns], axis=1)


def _named(prints: DataFrame, distance: int, least: Column) -> DataFrame:
    """(fp, component_id): the minimum ``least`` of all rows that links connect to a fingerprint."""
    nodes = materialize(prints.groupBy("fp").agg(least.alias("least")), "nodes")
    roots = materialize(components(links(nodes.select("fp"), distance)), "roots")
    rooted = materialize(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    names = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return materialize(rooted.join(names, "root").select("fp", "component_id"), "named")


def _check_distance(distance: int) -> None:
    if not 1 <= distance <= 3:
        raise ValueError("distance has to be 1, 2 or 3: postings leave that many bytes open")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable).

    A text's words are cut at white space and A-Z lower-cased; a text of fewer words than a shingle is one shingle;
    NULL and empty texts have fingerprint zero, linked like any other.  Fingerprints link at ``distance`` or fewer
    differing bits.  Equal fingerprints are one node, so copies are never paired; links are followed to the end.
    Rows that repeat an id have a row each; a NULL id has a component but names none.  Other columns are ignored; an
    empty table gives no rows.
    """
    _check_distance(distance)
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    named = _named(prints, distance, F.min("doc_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component that ``simhash_groups`` finds, with all its columns.

    The row of the smallest id stays, of a component without ids one that has none; of several texts of that id, the
    one of the smallest digest.  Rows are looked up by id and digest, so a row goes for its own text only, whatever
    other rows have its id; of rows that are equal in both, any one stays.
    """
    _check_distance(distance)
    prints = materialize(fingerprints(docs, shingle, id_col, text_col, digest=True), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    named = _named(prints, distance, F.min(key))
    # A key has one text, and so one fingerprint and component.
    kept = key.eqNullSafe(F.col("component_id")).alias("kept")
    keys = prints.join(named, "fp").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), kept)
    keys = keys.groupBy("__id", "__digest", "kept").count().where("not kept or count > 1")
    keys = materialize(keys, "keys")
    own = docs.withColumn("__own", _digest(F.col(f"`{text_col}`")))
    names = {"__digest": "__own", "__id": id_col}
    rest = without(own, keys.select("__id", "__digest"), **names).select(*[F.col(f"`{c}`") for c in docs.columns])
    again = keys.where("kept").select("__id", "__digest")
    if again.isEmpty():
        return rest
    # Grouped before they are joined, so that no task gets all rows of a key.
    whole = F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row")
    once = maybe_in(own.withColumn("__digest", F.col("__own")), again, "__digest")
    once = once.groupBy(F.col(f"`{id_col}`").alias("__same"), "__own").agg(whole)
    same = F.col("__same").eqNullSafe(F.col("__id")) & F.col("__own").eqNullSafe(F.col("__digest"))
    return rest.unionByName(once.join(again, same, "left_semi").select("__row.*"))
