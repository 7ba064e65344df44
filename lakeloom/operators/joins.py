"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import materialize

# A side measured at no more than this is sent to every task.
BROADCAST_BYTES = 32 * 1024 * 1024
# A key is hot when its rows would fill this many average shuffle partitions.
HOT_FACTOR = 2
# Share of the rows looked at to find hot keys.
JUDGED_SHARE = 0.1
# Parts over which the rows of hot keys are dealt if the registry repeats those keys.
SALTS = 16

# Types whose values take one word of a row in memory.
_ONE_WORD = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


# Sizes that were measured while a frame was written.
_KNOWN_BYTES: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def _size_aggregates(df: DataFrame) -> tuple[int, list[Column]]:
    """Bytes that every row takes, and aggregates of the number of rows and of the bytes of their texts."""
    fixed, texts = 16, F.lit(0)
    for field in df.schema:
        fixed += 8
        if not isinstance(field.dataType, _ONE_WORD):
            length = F.octet_length(F.col(f"`{field.name}`").cast("string"))
            texts = texts + 8 + F.coalesce(length, F.lit(0))
    return fixed, [F.count("*").alias("n"), F.coalesce(F.sum(texts.cast("bigint")), F.lit(0)).alias("texts")]


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's rows in memory: known from when it was stored, or from one aggregate over it."""
    if df not in _KNOWN_BYTES:
        fixed, sizes = _size_aggregates(df)
        row = df.agg(*sizes).first()
        _KNOWN_BYTES[df] = row["n"] * fixed + row["texts"]
    return _KNOWN_BYTES[df]


def remember_bytes(df: DataFrame, size: int) -> DataFrame:
    _KNOWN_BYTES[df] = size
    return df


def same_size(df: DataFrame, of: DataFrame) -> DataFrame:
    """``df``, with rows that take no more than those of ``of`` if its size is known."""
    return remember_bytes(df, _KNOWN_BYTES[of]) if of in _KNOWN_BYTES else df


def stored(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``materialize`` that also tells the number of rows and remembers their size, both measured by the write."""
    fixed, sizes = _size_aggregates(df)
    seen = Observation()
    back = materialize(df.observe(seen, *sizes), label)
    return remember_bytes(back, seen.get["n"] * fixed + seen.get["texts"]), seen.get["n"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(df: DataFrame, key: str, factor: int = HOT_FACTOR) -> list:
    """Values of ``key`` (NULL among them) too frequent for one shuffle partition.

    At most ``partitions / factor`` values can hold that large a share, so that
    many of the most frequent ones are all that has to come back.  One pass
    over a fixed share of the rows counts both the rows and the keys; such
    frequent values show in any sample.  The answer decides how rows are
    joined, never whether.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at_most = max(1, math.ceil(partitions / factor))
    seen = Observation()
    judged = df.select(key).sample(JUDGED_SHARE, seed=17)
    counts = judged.observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(key).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n")).limit(at_most).collect()
    threshold = factor * seen.get["rows"] / partitions if top else 0
    return [row[key] for row in top if row["n"] > threshold]


def left_lookup(fact: DataFrame, registry: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left outer join of a large fact to a registry, whatever the skew.

    A registry measured as small goes to every task and the fact is not
    shuffled.  Otherwise both sides shuffle on the key, except the fact rows of
    hot and NULL keys: those stay where they are and meet only the registry
    rows of the hot keys, whose size is measured too.  If these are many, as
    when the registry repeats a hot key, the hot rows of the fact are dealt
    over SALTS parts and each part meets all of them; NULLs still stay.  All
    rows are kept; a registry that repeats a key multiplies fact rows, as any
    join does.
    """
    if fits_broadcast(registry, limit):
        return fact.join(F.broadcast(registry), key, "left")
    hot = hot_keys(fact, key)
    if not hot:
        return fact.join(registry, key, "left")
    named = [value for value in hot if value is not None]
    column = F.col(key)
    is_hot = column.isin(named) if named else F.lit(False)
    hot_registry = registry.where(is_hot)
    cold = fact.where(column.isNotNull() & ~is_hot).join(registry, key, "left")
    if fits_broadcast(hot_registry, limit):
        held = fact.where(column.isNull() | is_hot).join(F.broadcast(hot_registry), key, "left")
        return cold.unionByName(held)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = fact.where(is_hot).withColumn("__salt", F.floor(F.rand(17) * SALTS).cast("int"))
    split = dealt.join(hot_registry.withColumn("__salt", salts), [key, "__salt"], "left").drop("__salt")
    unknown = fact.where(column.isNull()).join(F.broadcast(registry.where(F.lit(False))), key, "left")
    return cold.unionByName(split).unionByName(unknown)


def lookup_key(
    fact: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    key: str,
    alias: str,
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Replace natural key columns of ``fact`` by the dimension's surrogate key.

    Columns listed in ``null_safe`` match NULL with NULL.  The join is outer, so
    no fact row is lost.  Meant to run on aggregated facts and on dimensions
    that are stored; a dimension measured as small goes to every task, so that
    few natural keys do not mean few busy tasks.
    """
    dim = dimension.select(F.col(key).alias(alias), *[F.col(c).alias(f"__dim_{c}") for c in on])
    if fits_broadcast(dimension if dimension in _KNOWN_BYTES else dim):
        dim = F.broadcast(dim)
    condition: Column | None = None
    for c in on:
        left, right = F.col(c), F.col(f"__dim_{c}")
        term = left.eqNullSafe(right) if c in null_safe else left == right
        condition = term if condition is None else condition & term
    rest = [c for c in fact.columns if c not in on]
    return fact.join(dim, condition, "left").select(alias, *rest)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str, rows: str = "n_rows") -> DataFrame:
    """Non-NULL keys of ``child`` that ``parent`` lacks, with their row counts.

    The child is reduced to one row per key before it meets the parent.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(rows))
    known = parent.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull())
    return keys.join(known, key, "left_anti")


def key_usage(child: DataFrame, parent: DataFrame, key: str, parent_key: str, scope: Column | None = None) -> DataFrame:
    """Every key of either side: child rows, child rows in ``scope``, and whether the parent knows it.

    Both sides go through one grouping instead of a join.  Rows are combined on
    the map side, so a key that owns most of the rows costs no more than any.
    """
    scope = F.lit(True) if scope is None else scope
    used = child.select(
        F.col(key).alias("key"), F.lit(1).alias("n_rows"), scope.cast("int").alias("used"), F.lit(False).alias("known")
    )
    known = parent.select(
        F.col(parent_key).alias("key"), F.lit(0).alias("n_rows"), F.lit(0).alias("used"), F.lit(True).alias("known")
    )
    return (
        used.unionByName(known)
        .groupBy("key")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("used").alias("used"), F.bool_or("known").alias("known"))
    )
