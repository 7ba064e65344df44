"""Dimensions derived from the facts and registries themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import derive
from lakeloom.operators.keys import dense_key, with_unknown_member


def _hashed_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows, to go under a ``max`` of a text.

    Such a maximum sorts its input by the grouping key.  A hashed grouping
    below it, combined on the map side, leaves only the few rows there are to
    be sorted.  A plain distinct would be optimized away, since a maximum does
    not mind repeats; the condition on the count, always true, keeps it.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("__n")).where(F.col("__n") > 0).select(*df.columns)


def pair_names(df: DataFrame, a: str, b: str, name_a: str, name_b: str) -> DataFrame:
    """Every pair of the two ids, NULLs among them, with the greatest name seen per side.

    One pass over the trips from which both the node and the pair dimension
    follow: the greatest name per id is the greatest of the greatest per pair.
    """
    seen = _hashed_distinct(df.select(a, b, name_a, name_b))
    return seen.groupBy(a, b).agg(F.max(name_a).alias(name_a), F.max(name_b).alias(name_b))


def node_dim(
    df: DataFrame, roles: Sequence[tuple[str, str]], id_name: str = "id", label_name: str = "name"
) -> DataFrame:
    """One row per id seen in any of the ``(id, name)`` roles, with its greatest name.

    All roles come from one scan; ids that are NULL are left out.
    """
    members = F.array(*[F.struct(F.col(i).alias("id"), F.col(n).alias("name")) for i, n in roles])
    nodes = _hashed_distinct(df.select(F.inline(members)).where(F.col("id").isNotNull()))
    return nodes.groupBy(F.col("id").alias(id_name)).agg(F.max("name").alias(label_name))


# Calendar parts a date dimension can have.  The week is the ISO week of the
# year, next to the calendar year.
CALENDAR_PARTS = {
    "id": derive.date_key,
    "day": F.dayofmonth,
    "month": F.month,
    "week": F.weekofyear,
    "year": F.year,
}


def calendar_dim(df: DataFrame, stamp: str, names: dict[str, str] | None = None, date_name: str = "date") -> DataFrame:
    """One row per day on which ``df`` has a row; ``names`` renames the parts."""
    names = names or {}
    days = df.where(F.col(stamp).isNotNull()).select(F.to_date(stamp).alias(date_name)).distinct()
    parts = [
        build(F.col(date_name)).cast("int").alias(names.get(part, part)) for part, build in CALENDAR_PARTS.items()
    ]
    return days.select(*parts, date_name)


def segments(df: DataFrame, group: Column, banded: Column, group_name: str, band_name: str, default: str) -> DataFrame:
    """Distinct (group, band) combinations and the (NULL, ``default``) member for rows without attributes."""
    seen = df.select(group.alias(group_name), banded.alias(band_name)).distinct()
    return with_unknown_member(seen, {group_name: None, band_name: default})


def segment_dim(
    df: DataFrame, group: Column, banded: Column, group_name: str, band_name: str, default: str, id_name: str = "id"
) -> DataFrame:
    """``segments`` numbered 1..n by group, NULLs last, then band."""
    members = segments(df, group, banded, group_name, band_name, default)
    return dense_key(members, [F.col(group_name).asc_nulls_last(), F.col(band_name).asc_nulls_last()], id_name)


def pair_dim(
    df: DataFrame,
    a: str,
    b: str,
    name_a: str,
    name_b: str,
    label_name: str,
    separator: str,
    id_name: str = "id",
) -> DataFrame:
    """One row per pair with both ids known, labelled by the two names and numbered in id order."""
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = pair_names(known, a, b, name_a, name_b).select(
        a, b, derive.joined_label(F.col(name_a), F.col(name_b), separator).alias(label_name)
    )
    return dense_key(pairs, [a, b], id_name)
