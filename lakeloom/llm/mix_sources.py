"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
# monotonically_increasing_id() holds the partition above bit 33 and the row's position below it.
POSITION_BITS = 33


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Target size of each source: ``share`` of the whole by weight, none above ``most`` times its source's size.

    ``sizes`` has one row per source (source, source_size, n).  The weights repeat over the sources by code point, NULL
    last.  What a source cannot take goes to the others by weight, round by round, until no target is above its
    limit: each round is one aggregate over the sources, and caps at least one more of them.
    """
    order = [F.col("source").isNull(), F.col("source")]
    # One row per source, of two numbers: the only place where sources are looked at in one sequence.
    placed = materialize(sizes.withColumn("place", F.row_number().over(Window.orderBy(*order)) - 1), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.select("source", "source_size", "n", weight.cast("double").alias("weight"))
    limit = (F.col("source_size") * most).cast("double")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("weight") * level > limit
        row = placed.agg(
            F.sum(F.when(full, limit).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        nxt = (total * share - row["full"]) / row["open"]
        if nxt == level:
            break
        level = nxt
    return placed.select("source", "source_size", "n", F.least(F.col("weight") * level, limit).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken, and ``row_col`` if named.

    ``size`` counts words; a NULL text has none.  Within a source every document is expected as often,
    target / source_size times.  The prefix sums of these expectations, plus one offset per source drawn from the
    seed, cross an integer boundary once for each copy.  Documents stand in order of size, then id, so that a
    source's taken words differ from its target by about its longest document at most.  A source without words has
    target 0 and gives no copies.  Rows that repeat an id count as documents of their own; a NULL source is a source.
    Other columns are ignored, an empty table gives no rows, and reruns agree.

    The rows are range-partitioned by source, size and id, so that a source of any size spreads over many tasks, and
    written once with partition and position; counts per source and partition then give each row its place.
    """
    size = F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("bigint")
    row = [row_col] if row_col else []
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"), *row
    )
    # The sizes are computed once, before the ranges are sampled.
    rows = materialize(rows, "sizes")
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id")]
    spot = F.monotonically_increasing_id()
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "*",
            F.shiftright(spot, POSITION_BITS).alias("part"),
            spot.bitwiseAND((1 << POSITION_BITS) - 1).alias("position"),
        ),
        "placed",
    )
    stretches = placed.groupBy("source", "part").agg(
        F.count("*").alias("n"), F.sum("size").alias("words"), F.min("position").alias("first")
    )
    stretches = materialize(stretches, "stretches")
    sizes = stretches.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    targets = source_targets(sizes, weights, share, most)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(
        F.col("source").alias("s"), F.col("part").alias("p"), (F.col("before") - F.col("first")).alias("shift")
    )
    goals = targets.select(F.col("source").alias("g"), "source_size", "target")
    starts = starts.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g")
    # 32 random bits of a digest as the source's offset in [0, 1).
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = F.col("position") + F.col("shift") + 1
    numbered = placed.join(
        materialize(starts, "starts"), (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    ).select(
        "doc_id", "source", "size", "source_size", "target", *row, upto.alias("i"), offset.alias("u"), rate.alias("r")
    )
    crossed = F.floor(F.col("i") * F.col("r") + F.col("u")) - F.floor((F.col("i") - 1) * F.col("r") + F.col("u"))
    copies = F.least(crossed, F.lit(most).cast("bigint")).alias("copies")
    return numbered.select("doc_id", "source", "size", "source_size", "target", copies, *row).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as ``mix_sources`` takes it.

    Rows are written once with a number, by which their copies find them, so rows that share an id have their own
    copies, and no task gets all rows of an id.
    """
    numbered = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    report = mix_sources(numbered, row_col="__row", **options)
    copies = materialize(report.where("copies > 0").select("__row", F.col("copies").alias("__copies")), "copies")
    # Nearly all documents have copies, so their texts move once to meet them, at any size.
    rows = numbered.join(copies.hint("merge"), "__row")
    copied = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    return copied.select(*[F.col(f"`{name}`") for name in docs.columns])
