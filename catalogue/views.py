"""Trips, users and stations read out of the supplied tables, in Spark and in SQL.

Orders serve as trips and customers as users: the order is the trip, its
customer the user, its total the duration, and two of the nations are the
stations.  Pending orders are trips without an end.  All customers are
registered users; three in ten trips name a user that no registry knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.functions import derive
from lakeloom.functions.cleaning import null_outside


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


BAND_EDGES = (16, 26, 36, 51, 66)
BAND_LABELS = ("16-25", "26-35", "36-50", "51-65", "66+")
UNKNOWN = "unknown"


def age_band(age: str = "age") -> Column:
    return derive.band(F.col(age), BAND_EDGES, BAND_LABELS, UNKNOWN)


# Added to the user of every trip that is to have an unregistered one.
STRANGER = 1_000_000_000


def trip_user() -> Column:
    return F.col("o_custkey") + F.when(F.col("o_orderkey") % 10 < 3, STRANGER).otherwise(0)


def trip_duration() -> Column:
    seconds = (F.floor("o_totalprice") % 9000).cast("int")
    return F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_totalprice") >= 5000, seconds)


def trip_destination() -> Column:
    node = ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 25).cast("int")
    return F.when(F.col("o_totalprice") < 490000, node)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        trip_user().alias("user_id"),
        trip_duration().alias("duration_s"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderkey") % 25).cast("int").alias("origin_id"),
        trip_destination().alias("dest_id"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("gender"),
            null_outside(16, 100)(10 + F.col("c_custkey") % 95).cast("int").alias("age"),
        )
    )


def named_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their stations' names, which is how trip files carry them."""
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("origin_id"), F.col("n_name").alias("origin_name"))
    dest = nation.select(F.col("n_nationkey").alias("dest_id"), F.col("n_name").alias("dest_name"))
    return trips(spark, sf_dir).join(origin, "origin_id", "left").join(dest, "dest_id", "left")


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rides with coordinates, a time of day and some unknown ends."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.floor(F.col("value") * 20).cast("int").alias("duration_s"),
        "ts",
        (F.lit(-34.5) - (event % 97) / 1000.0).alias("start_lat"),
        (F.lit(-58.3) - (event % 89) / 1000.0).alias("start_lon"),
        (F.lit(-34.5) - (user % 97) / 1000.0).alias("end_lat"),
        F.when(F.col("value") < 480, F.lit(-58.3) - (user % 83) / 1000.0).alias("end_lon"),
        "event_type",
    )


# ---- The same in SQL --------------------------------------------------------

SQL_USER = f"case when o_orderkey % 10 < 3 then {STRANGER} + o_custkey else o_custkey end"

SQL_TRIPS = f"""
trips as (
  select o_orderkey as trip_id, {SQL_USER} as user_id,
         case when o_orderstatus = 'P' then 0
              when o_totalprice < 5000 then null
              else cast(cast(floor(o_totalprice) as bigint) % 9000 as integer) end as duration_s,
         o_orderdate as started_at,
         cast(o_orderkey % 25 as integer) as origin_id,
         case when o_totalprice >= 490000 then null
              else cast((o_orderkey * 7 + o_custkey) % 25 as integer) end as dest_id
  from orders)"""

SQL_USERS = """
users as (
  select c_custkey as user_id,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as gender,
         case when c_custkey % 95 >= 6 and c_custkey % 95 <= 90 then cast(10 + c_custkey % 95 as integer) end as age
  from customer)"""

# Bands by a lookup table of their bounds rather than by nested conditions.
SQL_BANDS = """
bands(lo, hi, label) as (
  values (16, 25, '16-25'), (26, 35, '26-35'), (36, 50, '36-50'), (51, 65, '51-65'), (66, 1000, '66+'))"""

SQL_BANDED = """
banded as (
  select u.user_id, u.gender, coalesce(b.label, 'unknown') as band
  from users u left join bands b on u.age >= b.lo and u.age <= b.hi)"""

SQL_SEGMENTS = """
segments as (
  select row_number() over (order by gender nulls last, band) as id, gender, band
  from (select gender, band from banded union select null, 'unknown'))"""

SQL_NAMED = """
named as (
  select t.*, o.n_name as origin_name, d.n_name as dest_name
  from trips t left join nation o on o.n_nationkey = t.origin_id left join nation d on d.n_nationkey = t.dest_id)"""

SQL_ROUTES = """
routes as (
  select row_number() over (order by origin_id, dest_id) as id, origin_id, dest_id,
         max(origin_name) || ' → ' || max(dest_name) as route
  from named where origin_id is not null and dest_id is not null group by origin_id, dest_id)"""

SQL_CLOSED = """
closed as (
  select cast(strftime(started_at, '%Y%m%d') as integer) as day_id, t.*,
         b.gender, coalesce(b.band, 'unknown') as band
  from trips t left join banded b on b.user_id = t.user_id
  where t.duration_s > 0 and t.origin_id is not null)"""

SQL_FACT_ROUTE = """
fact_route as (
  select c.day_id, s.id as segment_id, r.id as route_id, count(*) as n_trips,
         cast(round_even(sum(c.duration_s) / 1e0 / count(*) / 60, 0) as integer) as minutes
  from closed c
  join segments s on s.gender is not distinct from c.gender and s.band = c.band
  join routes r on r.origin_id = c.origin_id and r.dest_id = c.dest_id
  group by all)"""

SQL_FACT_NODE = """
fact_node as (
  select c.day_id, s.id as segment_id, c.origin_id as node_id, count(*) as n_trips
  from closed c join segments s on s.gender is not distinct from c.gender and s.band = c.band
  group by all)"""

SQL_CALENDAR = """
calendar as (
  select distinct year(d) * 10000 + month(d) * 100 + day(d) as id, day(d) as day, month(d) as month,
         weekofyear(d) as week, year(d) as year, d as date
  from (select cast(started_at as date) as d from trips))"""

SQL_RIDES = """
rides as (
  select event_id, cast(floor(value * 20) as integer) as duration_s, ts,
         -34.5e0 - (event_id % 97) / 1000e0 as start_lat, -58.3e0 - (event_id % 89) / 1000e0 as start_lon,
         -34.5e0 - (user_id % 97) / 1000e0 as end_lat,
         case when value < 480 then -58.3e0 - (user_id % 83) / 1000e0 end as end_lon, event_type
  from events)"""

STAR = (SQL_TRIPS, SQL_USERS, SQL_BANDS, SQL_BANDED, SQL_SEGMENTS, SQL_NAMED, SQL_ROUTES, SQL_CLOSED)


def sql(body: str, *parts: str) -> str:
    """A query with the given views in front."""
    return "with " + ",".join(parts) + "\n" + body.strip()
