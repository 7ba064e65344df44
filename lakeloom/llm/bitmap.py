"""Which rows may have a key of another table, told by a bitmap that is sized by the number of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each key, if they fit: one row in 16 whose key is not there is taken for one that is, at most.  With fewer than
# two bits a key four rows in ten are, and a bitmap does not pay.
SPARE, SCARCE = 16, 2
# The smallest bitmap, and the largest one that is broadcast: 32 KiB and 32 MiB.
LEAST, MOST = 1 << 18, 1 << 28


def bits_for(keys: int) -> int | None:
    """The size of the bitmap for so many keys; None if even the largest is too full, and rows are joined without one."""
    bits = 1 << max(0, SPARE * keys - 1).bit_length()
    return min(max(LEAST, bits), MOST) if SCARCE * keys <= MOST else None


def marked_in(rows: DataFrame, keys: DataFrame, *key: str) -> DataFrame:
    """``rows`` with a column ``__maybe``: true if the key is in ``keys``, and for a few others.

    Keys, a written table, are counted and marked in a bitmap, which is all that is broadcast.  Where even the largest
    would be too full to keep rows apart, all rows may be there.
    """
    bits = bits_for(keys.count())
    if bits is None:
        return rows.withColumn("__maybe", F.lit(True))
    spot = F.pmod(F.xxhash64(*key), F.lit(bits)) + 1
    bitmap = keys.select(spot.alias("__spot")).groupBy(F.bitmap_bucket_number("__spot").alias("__bucket"))
    bitmap = bitmap.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__spot")).alias("__bits"))
    found = rows.withColumn("__spot", spot).withColumn("__bucket", F.bitmap_bucket_number("__spot"))
    found = found.join(F.broadcast(bitmap), "__bucket", "left")
    at = F.bitmap_bit_position("__spot")
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(__byte, cast(bitmap_bit_position(__spot) % 8 as int)) & 1")
    marked = found.withColumn("__byte", byte).withColumn("__maybe", F.coalesce(bit == 1, F.lit(False)))
    return marked.select(*[F.col(f"`{c}`") for c in rows.columns], "__maybe")


def maybe_in(rows: DataFrame, keys: DataFrame, *key: str) -> DataFrame:
    """The rows of ``rows`` whose key may be in ``keys``."""
    return marked_in(rows, keys, *key).where("__maybe").drop("__maybe")


def without(rows: DataFrame, keys: DataFrame, **names: str) -> DataFrame:
    """The rows whose columns ``names[k]`` do not equal the columns ``k`` of any row of ``keys``; NULL equals NULL.

    Only rows that the bitmap of the first key may hold are moved to be compared.
    """
    first, column = next(iter(names.items()))
    marked = marked_in(rows.withColumn(first, F.col(f"`{column}`")), keys, first).drop(first)
    same = [F.col(f"`{column}`").eqNullSafe(F.col(name)) for name, column in names.items()]
    doubtful = marked.where("__maybe").join(keys.hint("merge"), same, "left_anti")
    return marked.where("not __maybe").unionByName(doubtful).drop("__maybe")
