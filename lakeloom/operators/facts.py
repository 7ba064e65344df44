"""Aggregated facts over trips joined to a registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import derive
from lakeloom.operators.joins import left_lookup, lookup_key, measured_bytes, same_size
from lakeloom.operators.keys import dense_key, unique_key


@dataclass(frozen=True)
class Lookup:
    """Natural key columns of a fact that a dimension's key replaces."""

    dimension: DataFrame
    on: tuple[str, ...]
    alias: str
    null_safe: tuple[str, ...] = ()
    key: str = "id"


def enrich(
    trips: DataFrame,
    registry: DataFrame,
    key: str,
    attributes: Mapping[str, Column],
    defaults: Mapping[str, object],
) -> DataFrame:
    """Give every trip the registry's derived attributes, or the defaults if unregistered.

    The attributes are computed per registry row, before the join, so that the
    side that may be broadcast carries only what the facts need.  Attributes
    without a default stay NULL for unregistered trips.
    """
    side = same_size(registry.select(key, *[column.alias(name) for name, column in attributes.items()]), registry)
    joined = left_lookup(trips, side, key)
    filled = {
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
        for name, value in defaults.items()
        if value is not None
    }
    return joined.withColumns(filled) if filled else joined


def enrich_with_key(
    trips: DataFrame,
    registry: DataFrame,
    key: str,
    attributes: Mapping[str, Column],
    lookup: Lookup,
    unknown: Mapping[str, object],
) -> DataFrame:
    """Give every trip the key of its registry row's dimension member.

    The natural key is looked up once per registry row, so trips carry and
    group by one number.  Unregistered trips get the key of the ``unknown``
    member, NULL in the columns not listed.
    """
    side = registry.select(key, *[column.alias(name) for name, column in attributes.items()])
    keyed = lookup_key(side, lookup.dimension, lookup.on, lookup.key, lookup.alias, lookup.null_safe)
    # One number takes the place of the natural key: no row of the registry gets larger.
    measured_bytes(side)
    keyed = same_size(keyed, side)
    is_unknown = reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(unknown.get(c))) for c in lookup.on])
    member = lookup.dimension.where(is_unknown).select(lookup.key).scalar()
    return enrich(trips, keyed, key, {lookup.alias: F.col(lookup.alias)}, {lookup.alias: member})


def activity(enriched: DataFrame, grain: Sequence[str], duration: str) -> DataFrame:
    """Counts and duration totals per grain: additive, so coarser facts can be summed from it."""
    return enriched.groupBy(*grain).agg(
        F.count("*").alias("n_trips"),
        F.sum(F.col(duration).cast("bigint")).alias("total_duration"),
        F.count(duration).alias("n_durations"),
    )


def coarsen(totals: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Sum additive totals to a coarser grain."""
    return totals.groupBy(*grain).agg(
        *[F.sum(c).alias(c) for c in ("n_trips", "total_duration", "n_durations")]
    )


def build_fact(
    totals: DataFrame,
    lookups: Sequence[Lookup],
    keys: Sequence[str],
    count_name: str,
    minutes_name: str | None = None,
    rounding: str = "half_even",
    id_name: str | None = "id",
    complete: bool = False,
    numbering: str = "dense",
) -> DataFrame:
    """Finish an aggregated fact: surrogate foreign keys, measures, own key.

    ``totals`` has been grouped on the natural keys, so the lookups see
    aggregated rows instead of trips.  Rows that end up with the same foreign
    keys are merged, unless ``complete`` promises dimensions that map the
    natural keys one to one, as dimensions derived from the same rows do.
    ``numbering`` is "dense" for keys 1..n in no order, "ordered" for keys 1..n
    in the order of ``keys``, at the price of a range shuffle, or "unique" for
    keys with gaps, which cost no extra pass.  ``id_name=None`` leaves the own
    key out.
    """
    fact = totals
    for lookup in lookups:
        fact = lookup_key(fact, lookup.dimension, lookup.on, lookup.key, lookup.alias, lookup.null_safe)
    if lookups and not complete:
        fact = coarsen(fact, keys)
    measures = [F.col("n_trips").alias(count_name)]
    if minutes_name:
        minutes = derive.whole_mean(F.col("total_duration"), F.col("n_durations"), per=60, rounding=rounding)
        measures.append(minutes.alias(minutes_name))
    fact = fact.select(*keys, *measures)
    if id_name is None:
        return fact
    if numbering == "unique":
        return unique_key(fact, id_name)
    if numbering not in ("dense", "ordered"):
        raise ValueError(f"unknown numbering {numbering!r}")
    order = [F.col(k).asc_nulls_last() for k in keys] if numbering == "ordered" else ()
    return dense_key(fact, order, id_name)
