"""Repeated stretches of texts: seeds that documents share, and what is found around them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.anchors import Winnower
from lakeloom.llm.arrow import map_batches, utf8
from lakeloom.llm.bitmap import marked_in, maybe_in
from lakeloom.session import discard, materialize

# Stands for a NULL id: it orders before all others.
NO_ID = -(1 << 63)
# No text has so many tokens.
PLACES = 1 << 40
# Surroundings of one anchor that a task looks into at a time.
CROWD = 384
# Pieces of one middle that stay together, and those of a larger middle that a part gets.
TOGETHER, PART = 256, 128
# Groups of windows, by their start before the anchor, into which larger crowds are split.
STARTS = 8


@dataclass(frozen=True)
class Units:
    """What counts as a repeat: ``length`` consecutive tokens that also start earlier.

    ``tokens`` is "words" or "bytes".  Earlier means in a document of a smaller id or, if ``inside``, further up in
    the same document.  Anchors are grams of ``gram`` tokens.
    """

    tokens: str
    length: int
    gram: int
    inside: bool

    def winnower(self) -> tuple[Winnower, object]:
        winnower = Winnower(self.length, self.gram)
        return winnower, getattr(winnower, self.tokens)

    def place(self) -> Column:
        """Number by which occurrences (doc, at) are ordered, the earlier the smaller."""
        if not self.inside:
            return F.col("doc")
        return F.col("doc").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(14,0)") + F.col("at")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text): rows are known by their id and a hash of their text, so that repeated ids do no harm."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def anchors(texts: DataFrame, units: Units) -> DataFrame:
    """Every anchor: (hash, sig, doc, th, at, back, ahead).

    The windows that chose the anchor at token ``at`` start from ``back`` tokens before it up to ``ahead`` after it;
    ``sig`` is a hash of all their tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        winnower, cut = units.winnower()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(6)]
            for row, text in enumerate(utf8(batch.column(2))):
                for runs in winnower.runs(cut(text)[0]):
                    own = (
                        runs.hash.view(np.int64), runs.sig.view(np.int64), np.full(len(runs.hash), row),
                        runs.at, runs.at - runs.lo, runs.hi - runs.at,
                    )
                    for part, values in zip(parts, own):
                        part.append(values)
            hashes, sigs, rows, at, back, ahead = (np.concatenate(part) for part in parts)
            taken = pa.array(rows)
            yield {
                "hash": hashes, "sig": sigs, "doc": batch.column(0).take(taken), "th": batch.column(1).take(taken),
                "at": at, "back": back.astype(np.int32), "ahead": ahead.astype(np.int32),
            }

    return map_batches(texts, run, "hash long, sig long, doc long, th long, at long, back int, ahead int")


def judged_runs(texts: DataFrame, units: Units) -> DataFrame:
    """Runs of windows around repeated anchors: (hash, doc, th, at, back, ahead, later), written to the shared folder.

    Runs with the same anchor and the same tokens are one class, known by its hashes.  All but its first occurrence are
    ``later``: each of their windows starts further up as well.  The first is listed only if its anchor has other
    classes, with which single windows may be shared.  So copies cost one comparison each, in any number.
    """
    found = materialize(anchors(texts, units), "anchors")
    groups = found.groupBy("hash").agg(
        F.count("*").alias("n"),
        (F.min("doc") < F.max("doc")).alias("shared"),
        (F.min("sig") < F.max("sig")).alias("varied"),
    )
    repeated = materialize(groups.where("n > 1" if units.inside else "shared").select("hash", "varied"), "repeated")
    runs = materialize(maybe_in(found, repeated, "hash").join(repeated, "hash"), "runs")
    classes = runs.groupBy("hash", "sig").agg(F.min(units.place()).alias("first"))
    judged = runs.join(materialize(classes, "classes"), ["hash", "sig"])
    judged = judged.withColumn("later", units.place() > F.col("first")).where("later or varied")
    judged = materialize(judged.select("hash", "doc", "th", "at", "back", "ahead", "later"), "judged")
    discard(found, repeated, runs)
    return judged


def later_spans(judged: DataFrame, units: Units) -> DataFrame:
    """Spans (doc, th, start, end) of the runs that lie further up as a whole."""
    start, end = F.col("at") - F.col("back"), F.col("at") + F.col("ahead") + units.length
    return judged.where("later").select("doc", "th", start.alias("start"), end.alias("end"))


def surroundings(texts: DataFrame, judged: DataFrame, units: Units) -> DataFrame:
    """What is left to look into: (hash, part, crowded, doc, th, lo, back, body), written to the shared folder.

    ``body`` is the text of the run of windows that starts at ``lo``, with the anchor ``back`` tokens further.  Each run is
    there once, however often its row is repeated.  Only bodies of one anchor and part can share a window, except for
    ``crowded`` ones, whose anchor has other parts with which they can.
    """
    own = judged.where("not later")
    crowds = own.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    crowds = materialize(crowds.select("hash", F.lit(True).alias("crowd")), "crowds")
    own = own.join(crowds, "hash", "left")
    run = F.struct(
        "hash", F.lit(0).cast("long").alias("part"), F.col("crowd").isNotNull().alias("crowded"),
        (F.col("at") - F.col("back")).alias("lo"), (F.col("at") + F.col("ahead")).alias("hi"), "back",
    )
    lists = own.groupBy("doc", "th").agg(F.collect_set(run).alias("runs"), F.count("*").alias("n"))
    lists = materialize(lists.withColumn("repeated", F.col("n") > F.size("runs")).drop("n"), "lists")

    used = [lists]

    def marked(which: str, combined: bool) -> DataFrame:
        wanted = materialize(lists.where(which).drop("repeated"), "wanted")
        used.append(wanted)
        found = maybe_in(texts, wanted, "doc", "th")
        if combined:  # one text for all rows that repeat it, before any of them is joined
            found = found.groupBy("doc", "th").agg(F.first("text").alias("text"))
        return found.join(wanted, ["doc", "th"]).select("doc", "th", "text", "runs")

    whole = marked("not repeated", False)
    if not lists.where("repeated").isEmpty():
        whole = whole.unionByName(marked("repeated", True))
    names = ("hash", "part", "crowded", "back")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        _, cut = units.winnower()
        for batch in batches:
            runs = batch.column("runs")
            fields = runs.flatten()
            sizes = runs.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            lows, highs = (fields.field(name).to_numpy(zero_copy_only=False) for name in ("lo", "hi"))
            begins = np.cumsum(sizes) - sizes
            bodies: list[bytes] = []
            for text, at, n in zip(utf8(batch.column("text")), begins.tolist(), sizes.tolist()):
                _, starts, ends = cut(text)
                first, last = lows[at : at + n], highs[at : at + n] + units.length
                if starts is not None:
                    first, last = starts[first], ends[last - 1]
                bodies += [text[a:b] for a, b in zip(first.tolist(), last.tolist())]
            yield {
                **{name: fields.field(name) for name in names}, "lo": lows, "body": bodies,
                "doc": batch.column("doc").take(pa.array(row)), "th": batch.column("th").take(pa.array(row)),
            }

    bodies = materialize(map_batches(whole, cut_out, BODIES), "left")
    discard(*used)
    if crowds.isEmpty():
        return bodies
    return bodies.where("not crowded").unionByName(dispersed(bodies.where("crowded"), units))


BODIES = "hash long, part long, crowded boolean, back int, lo long, doc long, th long, body binary"


def dispersed(bodies: DataFrame, units: Units) -> DataFrame:
    """The bodies of crowded anchors by what their windows have in common.

    Windows that start at nearly the same place before the anchor share the tokens in the middle of them all; so a body is
    split by the starts of its windows, and each piece goes with those of equal middles.  Pieces whose middle nobody
    has are done with.  Middles that are still crowded are dealt over several parts.
    """
    reach = units.length - units.gram
    edges = np.linspace(0, reach + 1, STARTS + 1).astype(int).tolist()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        _, cut = units.winnower()
        names = ("hash", "middle", "back", "lo", "doc", "th", "body")
        for batch in batches:
            rows = []
            columns = [batch.column(name).to_pylist() for name in ("hash", "back", "lo", "doc", "th")]
            for anchor, back, lo, doc, th, text in zip(*columns, utf8(batch.column("body"))):
                tokens, starts, ends = cut(text)
                raw = memoryview(np.ascontiguousarray(tokens)).cast("B")
                width = len(raw) // len(tokens)
                least = back - (len(tokens) - units.length)  # the last window starts so far before the anchor
                for low, high in zip(edges, edges[1:]):
                    low, high = max(low, least), min(high - 1, back)  # windows that start so far before the anchor
                    if low > high:
                        continue
                    bucket = next(n for n, edge in enumerate(edges[1:]) if low < edge)
                    near, far = edges[bucket], edges[bucket + 1] - 1
                    middle = raw[(back - near) * width : (back + units.length - far) * width]
                    begin, end = back - high, back - low + units.length
                    first, last = (begin, end) if starts is None else (int(starts[begin]), int(ends[end - 1]))
                    key = xxhash.xxh3_64_intdigest(middle, seed=bucket) - (1 << 63)
                    rows.append((anchor, key, high, lo + begin, doc, th, text[first:last]))
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    schema = "hash long, middle long, back int, lo long, doc long, th long, body binary"
    pieces = materialize(map_batches(bodies, split, schema), "pieces")
    middles = pieces.groupBy("hash", "middle").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.when(F.col("n") > min(TOGETHER, CROWD), F.ceil(F.col("n") / min(PART, CROWD))).otherwise(F.lit(1).cast("long"))
    middles = materialize(middles.select("hash", "middle", parts.alias("parts")), "middles")
    dealt = F.xxhash64("middle", F.pmod(F.xxhash64("doc", "th", "lo"), "parts"))
    found = pieces.join(middles, ["hash", "middle"]).select(
        "hash", F.when(F.col("parts") > 1, dealt).otherwise(F.col("middle")).alias("part"),
        (F.col("parts") > 1).alias("crowded"), "back", "lo", "doc", "th", "body",
    )
    return materialize(found, "dispersed")


@dataclass(frozen=True)
class Body:
    """A run of windows around an anchor, as ``surroundings`` gives it."""

    hash: int
    part: int
    crowded: bool
    doc: int
    th: int
    lo: int
    back: int
    text: bytes


# Spans (doc, th, start, end); with an end of NULL a window that another part may know to start further up.
FOUND = "doc long, th long, start long, end long, one long, two long"


def spans_around_anchors(
    bodies: DataFrame, units: Units, find: Callable[[list[Body], object], tuple[np.ndarray, ...]], held: int
) -> DataFrame:
    """Spans (doc, th, start, end) of repeats between the surroundings of each anchor, without repeats of one part only.

    Bodies are dealt by anchor and part, and ``find`` (bodies, winnower) gives (body, start, end) of all that starts
    further up in another of them, for the bodies of several anchors, of about ``held`` bytes.  A part hands on
    the earliest start of each of its windows, by a 128-bit hash, to be compared with that of the anchor's other parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        winnower, cut = units.winnower()

        def found(rows: list[Body]) -> Iterator[dict]:
            docs, ths = (np.array([getattr(r, name) for r in rows], dtype=np.int64) for name in ("doc", "th"))
            body, start, end = find(rows, winnower)
            if len(body):
                none = pa.nulls(len(body), pa.int64())
                yield {"doc": docs[body], "th": ths[body], "start": start, "end": end, "one": none, "two": none}
            crowd = [n for n, r in enumerate(rows) if r.crowded]
            if crowd:
                body, start, one, two = _first_windows(rows, crowd, docs, winnower, cut, units.inside)
                none = pa.nulls(len(body), pa.int64())
                yield {"doc": docs[body], "th": ths[body], "start": start, "end": none, "one": one, "two": two}

        rows: list[Body] = []
        size = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for row in zip(*columns, utf8(batch.column(7))):
                row = Body(*row)
                if size > held and (row.hash, row.part) != (rows[-1].hash, rows[-1].part):
                    yield from found(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row.text)
        if rows:
            yield from found(rows)

    rows = bodies.select("hash", "part", "crowded", "doc", "th", "lo", "back", "body")
    dealt = rows.repartition("hash", "part").sortWithinPartitions("hash", "part")
    found = materialize(map_batches(dealt, run, FOUND), "found")
    handed = found.where("end is null").withColumnRenamed("start", "at")
    firsts = handed.groupBy("one", "two").agg(F.min(units.place()).alias("first"), F.max(units.place()).alias("last"))
    firsts = materialize(firsts.where("first < last").drop("last"), "firsts")
    more = handed.join(firsts, ["one", "two"]).where(units.place() > F.col("first"))
    more = more.select("doc", "th", F.col("at").alias("start"), (F.col("at") + units.length).alias("end"))
    return found.where("end is not null").select("doc", "th", "start", "end").unionByName(more)


def _first_windows(
    rows: list[Body], crowd: list[int], docs: np.ndarray, winnower: Winnower, cut: Callable, inside: bool
) -> tuple[np.ndarray, ...]:
    """(body, start, one, two) of the earliest starts of every window of the crowded bodies."""
    hashes = [winnower.windows(cut(rows[n].text)[0]) for n in crowd]
    counts = np.array([len(one) for one, _ in hashes])
    body = np.repeat(np.array(crowd), counts)
    within = np.arange(len(body)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.array([r.lo for r in rows], dtype=np.int64)[body] + within
    one, two = (np.concatenate([pair[i] for pair in hashes]).view(np.int64) for i in (0, 1))
    order = np.lexsort((start, docs[body], two, one))
    body, start, one, two = body[order], start[order], one[order], two[order]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    if not inside:  # all starts in the smallest document
        group = np.cumsum(new) - 1
        new = docs[body] == docs[body][np.flatnonzero(new)][group]
    return body[new], start[new], one[new], two[new]


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id, text and lists of span starts and ends (NULL: none); texts without spans are not moved."""
    lists = spans.groupBy("doc", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    lists = materialize(
        lists.select("doc", "th", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")), "spans"
    )
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    texts = marked_in(keyed(docs, id_col, text_col), lists, "doc", "th")
    found = texts.where("__maybe").join(lists, ["doc", "th"], "left").select(doc_id, "text", "starts", "ends")
    none = F.lit(None).cast("array<long>")
    others = texts.where("not __maybe").select(doc_id, "text", none.alias("starts"), none.alias("ends"))
    return found.unionByName(others)


def covered(n: int, starts: pa.Scalar, ends: pa.Scalar) -> np.ndarray:
    """Which of ``n`` tokens lie in a span."""
    edges = np.zeros(n + 1, dtype=np.int32)
    if starts.is_valid:
        np.add.at(edges, starts.values.to_numpy(zero_copy_only=False), 1)
        np.add.at(edges, ends.values.to_numpy(zero_copy_only=False), -1)
    return np.cumsum(edges[:-1], out=edges[:-1]) > 0
