"""Derived columns: bands, calendar parts, distances, rounded means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def band(value: Column, lower_edges: Sequence[int], labels: Sequence[str], default: str) -> Column:
    """Label of the band ``value`` falls in; ``labels[i]`` starts at ``lower_edges[i]``.

    The last band is open.  NULL and values under the first edge get ``default``.
    """
    if len(lower_edges) != len(labels) or list(lower_edges) != sorted(lower_edges):
        raise ValueError("one label per edge, edges ascending")
    result = F.lit(default)
    for edge, label in zip(lower_edges, labels):
        result = F.when(value >= edge, F.lit(label)).otherwise(result)
    return result


def date_key(day: Column) -> Column:
    """Date or timestamp -> integer YYYYMMDD, by arithmetic rather than text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(stamp: Column) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(stamp) + 1


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km radius.

    The half-chord is clamped at 1, where rounding could push antipodes out of
    the domain of asin.
    """
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    # least() skips NULLs, so a NULL coordinate has to be kept NULL by hand.
    clamped = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(clamped))


def whole_mean(total: Column, count: Column, per: int = 1, rounding: str = "half_even") -> Column:
    """``total / count / per`` as an integer; NULL where ``count`` is 0.

    ``half_even`` rounds ties to the even neighbour, ``trunc`` cuts.
    """
    mean = F.try_divide(total.cast("double"), count.cast("double")) / float(per)
    if rounding == "half_even":
        return F.rint(mean).cast("int")
    if rounding == "trunc":
        return mean.cast("int")
    raise ValueError(f"unknown rounding {rounding!r}")


def joined_label(left: Column, right: Column, separator: str) -> Column:
    """``left + separator + right``; NULL if either side is NULL."""
    return F.concat(left, F.lit(separator), right)
