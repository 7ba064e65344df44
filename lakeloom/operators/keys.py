"""Surrogate keys without a single-partition window, and the unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import BROADCAST_BYTES, measured_bytes, remember_bytes, stored
from lakeloom.session import materialize

# A frame of so many rows at most is numbered in one task.
FEW_ROWS = 100_000
# monotonically_increasing_id() holds the partition above bit 33 and the row's
# position within the partition below it.
_POSITION_BITS = 33


def dense_key(df: DataFrame, order: Sequence[Column | str] = (), name: str = "id") -> DataFrame:
    """Number rows 1..n; the key comes first in the result.

    The frame is written once with each row's partition and position.  The row
    counts per partition, one small row each, give every partition the offset
    it adds to its positions.  Without ``order`` rows are numbered as they lie
    and none is moved.  With it the frame is range-partitioned and sorted
    first; ``order`` should then identify a row, as a table's grain does: no
    range can be hot, and the numbering is the same on every run.  Frames of
    few rows, as dimensions are, are counted while they are written and then
    numbered in one task, without sampling for ranges.
    """
    if order:
        df, n_rows = stored(df, "unnumbered")
        if n_rows <= FEW_ROWS:
            one = df.coalesce(1).sortWithinPartitions(*order)
            key = (F.monotonically_increasing_id() + 1).alias(name)
            few = one.select(key, *[F.col(f"`{c}`") for c in df.columns])
            return remember_bytes(few, measured_bytes(df) + 8 * n_rows)
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spot = df.withColumn("__spot", F.monotonically_increasing_id())
    placed = materialize(spot, "numbered")
    part = F.shiftright("__spot", _POSITION_BITS)
    position = F.col("__spot").bitwiseAND((1 << _POSITION_BITS) - 1)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())
    starts = accumulate((row["count"] for row in counts), initial=0)
    offsets = [(row["part"], start) for row, start in zip(counts, starts)]
    numbered = placed.withColumn("__part", part)
    if len(offsets) <= 1:
        key = position + 1
    else:
        # One row per partition written: small unless partitions go into millions.
        starts_df = df.sparkSession.createDataFrame(offsets, "__part bigint, __start bigint")
        if len(offsets) * 32 <= BROADCAST_BYTES:
            starts_df = F.broadcast(starts_df)
        numbered = numbered.join(starts_df, "__part")
        key = F.col("__start") + position + 1
    return numbered.select(key.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def unique_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Number rows uniquely without moving any: ids have gaps and no order.

    The ids belong to one evaluation of the frame; store the result before
    joining or grouping by them.
    """
    return df.select(
        (F.monotonically_increasing_id() + 1).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def with_unknown_member(df: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """Add one constant row unless an equal row is there; columns missing in ``member`` are NULL."""
    one = df.sparkSession.range(1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema]
    )
    return df.unionByName(one).distinct()
