"""Compare the tables of two pipelines that should agree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import key_usage


def side_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both sides and how often each side has them, ``n_a`` and ``n_b``.

    One grouping serves both directions.  Copies are combined on the map side
    and never replicated.
    """

    def tagged(df: DataFrame, n_a: int, n_b: int) -> DataFrame:
        return df.select(*a.columns, F.lit(n_a).alias("n_a"), F.lit(n_b).alias("n_b"))

    both = tagged(a, 1, 0).unionByName(tagged(b, 0, 1))
    return both.groupBy(*a.columns).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with their counts."""
    return side_counts(a, b).where(F.col("n_a") != F.col("n_b"))


def table_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows on each side, rows only in ``a``, rows only in ``b``, copies counted."""
    surplus = F.col("n_a") - F.col("n_b")
    zero = F.lit(0).cast("bigint")
    return side_counts(a, b).agg(
        F.coalesce(F.sum("n_a"), zero).alias("rows_a"),
        F.coalesce(F.sum("n_b"), zero).alias("rows_b"),
        F.coalesce(F.sum(F.greatest(surplus, zero)), zero).alias("only_a"),
        F.coalesce(F.sum(F.greatest(-surplus, zero)), zero).alias("only_b"),
    )


def metric_differences(
    a: DataFrame,
    b: DataFrame,
    metrics: Mapping[str, Column],
    by: Sequence[str] = (),
    tolerance: float = 1e-9,
) -> DataFrame:
    """Metrics of both sides next to each other, one row per group: ``<metric>_a``, ``_b`` and ``_agrees``.

    ``metrics`` are aggregate expressions.  Each side is aggregated first; what meets are the groups, not the rows.
    A group one side lacks shows NULL.  Every metric keeps its type: whole numbers, decimals, texts and times agree if
    they are equal, however large.  Floating-point numbers, whose sums depend on the order of rows, agree if they
    differ by at most ``tolerance`` of the larger one.
    """
    aggregates = [column.alias(name) for name, column in metrics.items()]

    def values(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(*aggregates).select(F.lit(name).alias("side"), *by, *metrics)

    both = values(a, "a").unionByName(values(b, "b"))
    sides = [
        F.max(F.when(F.col("side") == side, F.col(name))).alias(f"{name}_{side}") for name in metrics for side in "ab"
    ]
    paired = both.groupBy(*by).agg(*sides)
    types = dict(paired.dtypes)

    def agrees(name: str) -> Column:
        left, right = F.col(f"{name}_a"), F.col(f"{name}_b")
        if types[f"{name}_a"] not in ("float", "double"):
            return left.eqNullSafe(right)
        close = F.abs(left - right) <= tolerance * F.greatest(F.abs(left), F.abs(right))
        return left.eqNullSafe(right) | F.coalesce(close, F.lit(False))

    return paired.select(
        *by, *[c for n in metrics for c in (F.col(f"{n}_a"), F.col(f"{n}_b"), agrees(n).alias(f"{n}_agrees"))]
    )


def orphan_summary(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """One row: distinct keys and rows of ``child``, and how many of each ``parent`` does not know."""
    keys = key_usage(child, parent, key, parent_key).where(F.col("key").isNotNull() & (F.col("n_rows") > 0))
    zero = F.lit(0).cast("bigint")
    sums = keys.agg(
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum("n_rows"), zero).alias("n_rows"),
        F.count_if(~F.col("known")).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("n_rows"))), zero).alias("orphan_rows"),
    )
    return sums.select(
        "*",
        F.try_divide(F.col("orphan_keys").cast("double"), F.col("n_keys").cast("double")).alias("orphan_key_share"),
        F.try_divide(F.col("orphan_rows").cast("double"), F.col("n_rows").cast("double")).alias("orphan_row_share"),
    )
