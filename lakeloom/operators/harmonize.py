"""Vintages with differing headers and formats to one typed schema, and their union."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.cleaning import Step, constant
from lakeloom.operators.joins import fits_broadcast, hot_keys, measured_bytes
from lakeloom.session import materialize


@dataclass(frozen=True)
class Field:
    """One target column: the source header, ``None`` if absent, and the steps."""

    source: str | None
    steps: tuple[Step, ...] = ()

    def column(self) -> Column:
        column = F.lit(None) if self.source is None else F.col("`" + self.source.replace("`", "``") + "`")
        for step in self.steps:
            column = step(column)
        return column


def take(source: str, *steps: Step) -> Field:
    return Field(source, steps)


def literal(value, to: str) -> Field:
    return Field(None, (constant(value, to),))


def harmonize(df: DataFrame, fields: Mapping[str, Field]) -> DataFrame:
    """One narrow projection to the target columns; headers not named are dropped."""
    return df.select(*[field.column().alias(name) for name, field in fields.items()])


def union_vintages(vintages: Sequence[DataFrame]) -> DataFrame:
    """All rows of all vintages, columns matched by name."""
    return reduce(DataFrame.unionByName, vintages)


# One key of so many is looked at to judge how many rows share theirs, and beyond this share of such rows a plain
# distinct is the better plan.
JUDGED_KEYS = 64
REPEATED_SHARE = 0.05
# Up to this many repeated keys go into the plan as values, which the Parquet
# scan can use to skip row groups.
LISTED_KEYS = 1000
# Bytes in memory of the rows that one task of a distinct in parts has to hold.
PART_BYTES = 64 << 20


def repeated_share(df: DataFrame, key: str) -> float:
    """The share of rows whose key is repeated, among the rows of every JUDGED_KEYS-th key."""
    judged = df.where(F.pmod(F.xxhash64(key), F.lit(JUDGED_KEYS)) == 0).groupBy(key).count()
    row = judged.agg(F.sum("count").alias("n"), F.sum(F.when(F.col("count") > 1, F.col("count"))).alias("m")).first()
    return (row["m"] or 0) / row["n"] if row["n"] else 0.0


def distinct_in_parts(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows; rows that agree agree in ``key``, whose parts are small enough to be held in memory.

    A plain distinct combines rows before it shuffles them: a task holds all the rows of its share of the files, many
    times their stored size, and spills.  Here rows are shuffled as they are, by their key, to a part for each
    ``PART_BYTES``.  Only a hot key needs rows combined first: then the plain distinct runs.
    """
    parts = math.ceil(measured_bytes(df) / PART_BYTES)
    if parts <= 1 or hot_keys(df, key):
        return df.distinct()
    return df.repartition(parts, key).distinct()


def drop_copies(df: DataFrame, key: str | None = None) -> DataFrame:
    """Keep one of each group of rows that agree in every column.

    Without ``key`` this is a plain distinct, which shuffles whole rows.  With
    a ``key`` that is nearly always unique only the keys are shuffled: rows
    whose key occurs once cannot have a copy and pass through untouched, and
    the distinct runs over the rest.  Rows that share the key but differ
    elsewhere all stay; NULL counts as a key.  A small share of the keys is
    counted first: where many rows share theirs, a distinct in parts of bounded
    size runs at once.  The repeated keys are listed in the plan if they are few and sent to
    all tasks if their measured size allows it; otherwise the distinct in parts
    runs.  The rows that result are the same by any of these ways.
    """
    if key is None:
        return df.distinct()
    if repeated_share(df, key) > REPEATED_SHARE:
        return distinct_in_parts(df, key)
    repeated = materialize(df.groupBy(key).count().where(F.col("count") > 1).select(key), "repeated-keys")
    n_repeated = repeated.count()
    if n_repeated == 0:
        return df
    column = F.col(key)
    if n_repeated <= LISTED_KEYS:
        values = [row[0] for row in repeated.collect()]
        named = [value for value in values if value is not None]
        suspect = column.isin(named) if named else F.lit(False)
        if len(named) < len(values):
            suspect = column.isNull() | suspect
        once = df.where(~F.coalesce(suspect, F.lit(False)))
        doubtful = df.where(suspect)
    elif fits_broadcast(repeated):
        marks = F.broadcast(repeated.where(column.isNotNull()).withColumn("__repeated", F.lit(True)))
        once = df.join(marks, key, "left_anti").where(column.isNotNull())
        doubtful = df.join(marks, key, "left").where(column.isNull() | F.col("__repeated"))
    else:
        return distinct_in_parts(df, key)
    return once.select(*df.columns).unionByName(doubtful.select(*df.columns).distinct())
