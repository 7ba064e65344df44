"""Feature table for a supervised model of trip durations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import derive

# Fixed bounds of a plausible trip, both excluded, in seconds.
SHORTEST = 60
LONGEST = 7200


@dataclass(frozen=True)
class TripColumns:
    """Names of the columns a feature table is computed from."""

    id: str
    duration: str
    start: str
    start_lat: str
    start_lon: str
    end_lat: str
    end_lon: str
    category: str


@dataclass(frozen=True)
class FeatureNames:
    """Names of the columns of the feature table; id, target and category keep theirs."""

    distance: str = "distance_km"
    hour: str = "start_hour"
    weekday: str = "weekday"
    weekend: str = "is_weekend"
    month: str = "month"


def plausible(duration: Column) -> Column:
    return (duration > SHORTEST) & (duration < LONGEST)


def feature_table(trips: DataFrame, cols: TripColumns, names: FeatureNames = FeatureNames()) -> DataFrame:
    """One row per plausible trip with known ends: id, target, distance, calendar features, category.

    A single narrow stage: the filters reach the scan and nothing is shuffled.
    """
    ends = [cols.start_lat, cols.start_lon, cols.end_lat, cols.end_lon]
    start = F.col(cols.start)
    weekday = derive.iso_weekday(start)
    # One condition per column, which the Parquet scan can use; dropna() it could not.
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in ends])
    return (
        trips.where(plausible(F.col(cols.duration)) & known)
        .select(
            cols.id,
            cols.duration,
            derive.haversine_km(*[F.col(c) for c in ends]).alias(names.distance),
            F.hour(start).cast("bigint").alias(names.hour),
            weekday.cast("bigint").alias(names.weekday),
            derive.flag(weekday.isin(6, 7)).alias(names.weekend),
            F.month(start).cast("bigint").alias(names.month),
            cols.category,
        )
    )
