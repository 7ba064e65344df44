"""Reports over a star schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Join:
    """A dimension joined to the fact's column ``fk`` on ``key``, ``attributes`` renamed as given.

    The same dimension may be joined several times in different roles.
    """

    dimension: DataFrame
    fk: str
    attributes: dict[str, str]
    key: str = "id"


@dataclass(frozen=True)
class Measures:
    """Output names of a rollup's measures and the fact columns they come from."""

    count: str
    total: str
    minutes: str | None = None
    plain_mean: str | None = None
    weighted_mean: str | None = None


def rollup(fact: DataFrame, joins: Sequence[Join], by: Sequence[str], measures: Measures) -> DataFrame:
    """Totals and means of a fact by dimension attributes.

    The fact is summed per combination of its foreign keys first, so the inner
    joins run on the few rows left and a hot key is one row.  ``plain_mean`` is
    the mean of the fact rows' minutes; ``weighted_mean`` weighs them by the
    number of trips behind each row.
    """
    m, w = F.col(measures.minutes) if measures.minutes else None, F.col(measures.count)
    partial = [F.sum(w).alias("__count")]
    if m is not None:
        partial += [
            F.sum(m.cast("bigint")).alias("__minutes"),
            F.count(m).alias("__rows"),
            F.sum(m.cast("bigint") * w).alias("__weighted"),
            F.sum(F.when(m.isNotNull(), w)).alias("__weight"),
        ]
    foreign = list(dict.fromkeys(join.fk for join in joins))
    df = fact.groupBy(*foreign).agg(*partial)
    for i, join in enumerate(joins):
        side = join.dimension.select(
            F.col(join.key).alias(f"__key_{i}"), *[F.col(a).alias(name) for a, name in join.attributes.items()]
        )
        df = df.join(side, F.col(join.fk) == F.col(f"__key_{i}"), "inner")
    result = [F.sum("__count").alias(measures.total)]
    if measures.plain_mean:
        result.append(
            F.try_divide(F.sum("__minutes").cast("double"), F.sum("__rows").cast("double")).alias(measures.plain_mean)
        )
    if measures.weighted_mean:
        result.append(
            F.try_divide(F.sum("__weighted").cast("double"), F.sum("__weight").cast("double")).alias(
                measures.weighted_mean
            )
        )
    return df.groupBy(*by).agg(*result)


def ordered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sort ascending, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in by])


def top(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the greatest measure, ties in the order of ``tie_break``.

    Each task keeps its best ``k`` rows; there is no full sort.
    """
    return df.orderBy(F.desc_nulls_last(measure), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)
