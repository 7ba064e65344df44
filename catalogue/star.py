"""Joins, keys, dimensions, facts, features and reports over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.views import (
    SQL_BANDED,
    SQL_BANDS,
    SQL_CALENDAR,
    SQL_FACT_NODE,
    SQL_FACT_ROUTE,
    SQL_NAMED,
    SQL_RIDES,
    SQL_ROUTES,
    SQL_SEGMENTS,
    SQL_TRIPS,
    SQL_USERS,
    STAR,
    UNKNOWN,
    age_band,
    named_trips,
    rides,
    sql,
    table,
    trips,
    users,
)
from lakeloom.functions import derive
from lakeloom.operators import dims, facts, joins, keys, report
from lakeloom.operators.training import FeatureNames, TripColumns, feature_table

# ---- joins ------------------------------------------------------------------


@query(sql("""
select t.trip_id, t.user_id, u.gender, coalesce(u.band, 'unknown') as band
from trips t left join banded u on u.user_id = t.user_id""", SQL_TRIPS, SQL_USERS, SQL_BANDS, SQL_BANDED))
def registry_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with its user's attributes, unregistered users included."""
    attributes = {"gender": F.col("gender"), "band": age_band()}
    enriched = facts.enrich(trips(spark, sf_dir), users(spark, sf_dir), "user_id", attributes, {"band": UNKNOWN})
    return enriched.select("trip_id", "user_id", "gender", "band")


@query("""
with keyed as (
  select *, case when l_returnflag = 'R' then 7 when l_linestatus = 'O' and l_returnflag = 'A' then null
                 else l_partkey end as p_partkey from lineitem)
select k.p_partkey, p.p_brand, count(*) as n_lines, cast(sum(cast(k.l_quantity as bigint)) as bigint) as quantity
from keyed k left join part p on p.p_partkey = k.p_partkey group by all""")
def hot_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows on one key and many on NULL, joined to a registry too large to broadcast.

    The limit is set below the registry's size so that the split for hot keys runs.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    key = F.when(flag == "R", 7).when((flag != "A") | (status != "O"), F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select(key.alias("p_partkey"), "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = joins.left_lookup(lines, part, "p_partkey", limit=1024)
    return joined.groupBy("p_partkey", "p_brand").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query(sql("""
select s.id as segment_id, c.gender, c.band, count(*) as n_trips from closed c
join segments s on s.gender is not distinct from c.gender and s.band = c.band
group by all""", *STAR))
def segment_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys of an aggregated table replaced by the segment's key, NULL genders matched too."""
    attributes = {"gender": F.col("gender"), "band": age_band()}
    enriched = facts.enrich(
        closed_trips(spark, sf_dir), users(spark, sf_dir), "user_id", attributes, {"band": UNKNOWN}
    )
    per_segment = facts.activity(enriched, ["gender", "band"], "duration_s")
    kept = per_segment.select("*", F.col("gender").alias("g"), F.col("band").alias("b"))
    found = joins.lookup_key(
        kept, segment_dimension(spark, sf_dir), ["gender", "band"], "id", "segment_id", null_safe=["gender"]
    )
    return found.select("segment_id", F.col("g").alias("gender"), F.col("b").alias("band"), "n_trips")


@query(sql("""
select t.user_id, count(*) as n_trips from trips t
where not exists (select 1 from users u where u.user_id = t.user_id) group by all""", SQL_TRIPS, SQL_USERS))
def orphan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of trips the registry does not know, with their trips."""
    return joins.orphans(trips(spark, sf_dir), users(spark, sf_dir), "user_id", "user_id", "n_trips")


# ---- dimensions and keys ----------------------------------------------------


def segment_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.segment_dim(users(spark, sf_dir), F.col("gender"), age_band(), "gender", "band", UNKNOWN)


def route_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.pair_dim(named_trips(spark, sf_dir), "origin_id", "dest_id", "origin_name", "dest_name", "route", " → ")


@query(sql("""
select id, max(name) as name
from (select origin_id as id, origin_name as name from named union select dest_id, dest_name from named)
where id is not null group by id""", SQL_TRIPS, SQL_NAMED))
def dim_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of either role with their greatest name."""
    return dims.node_dim(named_trips(spark, sf_dir), [("origin_id", "origin_name"), ("dest_id", "dest_name")])


@query(sql("""
select cast(id as integer) as id, cast(day as integer) as day, cast(month as integer) as month,
       cast(week as integer) as week, cast(year as integer) as year, date from calendar""", SQL_TRIPS, SQL_CALENDAR))
def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with trips and their calendar parts."""
    return dims.calendar_dim(trips(spark, sf_dir), "started_at")


@query(sql("select * from segments", SQL_USERS, SQL_BANDS, SQL_BANDED, SQL_SEGMENTS))
def dim_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered segments with the unknown member."""
    return segment_dimension(spark, sf_dir)


@query(sql("select * from routes", SQL_TRIPS, SQL_NAMED, SQL_ROUTES))
def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered station pairs with their label."""
    return route_dimension(spark, sf_dir)


@query("""
select cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as integer) as day_id,
       count(*) as n_orders from orders group by all""")
def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer day keys."""
    day = derive.date_key(F.col("o_orderdate")).alias("day_id")
    return table(spark, sf_dir, "orders").groupBy(day).agg(F.count("*").alias("n_orders"))


@query("""
select l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       row_number() over (order by l_shipdate nulls last, l_orderkey, l_partkey, l_suppkey, l_linenumber,
                          l_extendedprice) as id
from (select distinct l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from lineitem)""")
def fact_key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ordered keys for a large table, without sorting it in one task."""
    grain = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    distinct = table(spark, sf_dir, "lineitem").select(*grain).distinct()
    return keys.dense_key(distinct, [F.col("l_shipdate").asc_nulls_last(), *grain[1:]])


@query("select count(*) as n_rows, cast(1 as bigint) as first_id, count(*) as last_id, count(*) as n_ids from lineitem")
def fact_key_as_it_lies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys in no order, without moving a row: 1..n, each once."""
    per_id = keys.dense_key(table(spark, sf_dir, "lineitem")).groupBy("id").agg(F.count("*").alias("rows"))
    return per_id.agg(
        F.sum("rows").alias("n_rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count("*").alias("n_ids"),
    )


@query("select count(*) as n_rows, count(*) as n_ids, cast(0 as bigint) as n_null from lineitem")
def fact_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique keys without moving a row: as many ids as rows, none NULL."""
    numbered = keys.unique_key(table(spark, sf_dir, "lineitem"))
    # Each id occurs once if grouping by it leaves as many groups as rows.
    return (
        numbered.groupBy("id")
        .agg(F.count("*").alias("rows"))
        .agg(
            F.sum("rows").alias("n_rows"),
            F.count("*").alias("n_ids"),
            F.count_if(F.col("id").isNull()).alias("n_null"),
        )
    )


# ---- facts ------------------------------------------------------------------


def closed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = trips(spark, sf_dir).where((F.col("duration_s") > 0) & F.col("origin_id").isNotNull())
    return closed.withColumn("day_id", derive.date_key(F.col("started_at")))


def closed_activity(spark: SparkSession, sf_dir: str, grain: list[str], segments: DataFrame) -> DataFrame:
    """Closed trips summed per grain, with the segment's key looked up per user."""
    lookup = facts.Lookup(segments, ("gender", "band"), "segment_id", null_safe=("gender",))
    attributes = {"gender": F.col("gender"), "band": age_band()}
    keyed = facts.enrich_with_key(
        closed_trips(spark, sf_dir), users(spark, sf_dir), "user_id", attributes, lookup, {"band": UNKNOWN}
    )
    return facts.activity(keyed, grain, "duration_s")


def route_fact(spark: SparkSession, sf_dir: str, segments: DataFrame, routes: DataFrame) -> DataFrame:
    totals = closed_activity(spark, sf_dir, ["day_id", "segment_id", "origin_id", "dest_id"], segments)
    return facts.build_fact(
        totals.where(F.col("dest_id").isNotNull()),
        [facts.Lookup(routes, ("origin_id", "dest_id"), "route_id")],
        ["day_id", "segment_id", "route_id"],
        "n_trips",
        "minutes",
        id_name=None,
        complete=True,
    )


def node_fact(spark: SparkSession, sf_dir: str, id_name: str | None = None) -> DataFrame:
    segments = segment_dimension(spark, sf_dir)
    totals = closed_activity(spark, sf_dir, ["day_id", "segment_id", "origin_id"], segments)
    keys_of_fact = ["day_id", "segment_id", "node_id"]
    return facts.build_fact(
        totals.withColumnRenamed("origin_id", "node_id"), [], keys_of_fact, "n_trips", id_name=id_name,
        numbering="ordered",
    )


@query(sql("select * from fact_route", *STAR, SQL_FACT_ROUTE))
def fact_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and mean minutes per day, segment and route."""
    return route_fact(spark, sf_dir, segment_dimension(spark, sf_dir), route_dimension(spark, sf_dir))


@query(sql("select * from fact_node", *STAR, SQL_FACT_NODE))
def fact_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per day, segment and origin station."""
    return node_fact(spark, sf_dir)


@query(sql("""
select row_number() over (order by day_id, segment_id, node_id) as id, * from fact_node""", *STAR, SQL_FACT_NODE))
def fact_node_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node fact with its own dense key."""
    return node_fact(spark, sf_dir, "id")


@query(sql("""
select user_id, count(*) as n_trips,
       cast(round_even(avg(duration_s) / 60, 0) as integer) as minutes,
       cast(trunc(avg(duration_s) / 60) as integer) as whole_minutes
from trips where duration_s is not null group by user_id""", SQL_TRIPS))
def mean_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean minutes as integers, rounded half to even and cut."""
    total, n = F.sum(F.col("duration_s").cast("bigint")), F.count("duration_s")
    per_user = (
        trips(spark, sf_dir)
        .where(F.col("duration_s").isNotNull())
        .groupBy("user_id")
        .agg(F.count("*").alias("n_trips"), total.alias("t"), n.alias("n"))
    )
    return per_user.select(
        "user_id",
        "n_trips",
        derive.whole_mean(F.col("t"), F.col("n"), 60).alias("minutes"),
        derive.whole_mean(F.col("t"), F.col("n"), 60, "trunc").alias("whole_minutes"),
    )


# ---- features ---------------------------------------------------------------

# The half-angle form with atan2 as an independent way to the same distance.
SQL_KM = """
round(2 * 6371e0 * atan2(sqrt(h), sqrt(1e0 - h)), 6)"""
SQL_H = """
haversines as (
  select *, pow(sin(radians(end_lat - start_lat) / 2), 2)
            + cos(radians(start_lat)) * cos(radians(end_lat)) * pow(sin(radians(end_lon - start_lon) / 2), 2) as h
  from rides)"""


@query(sql(f"""
select event_id, duration_s, {SQL_KM.strip()} as distance_km, hour(ts) as start_hour, isodow(ts) as weekday,
       cast(isodow(ts) > 5 as integer) as is_weekend, month(ts) as month, event_type
from haversines where duration_s > 60 and duration_s < 7200 and end_lon is not null""", SQL_RIDES, SQL_H))
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table: plausible rides, distance and calendar features."""
    columns = TripColumns(
        "event_id", "duration_s", "ts", "start_lat", "start_lon", "end_lat", "end_lon", "event_type"
    )
    features = feature_table(rides(spark, sf_dir), columns, FeatureNames())
    return features.withColumn("distance_km", F.round("distance_km", 6))


@query(sql(f"select event_id, {SQL_KM.strip()} as km from haversines", SQL_RIDES, SQL_H))
def great_circle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle distances, NULL where an end is unknown."""
    km = derive.haversine_km(*[F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")])
    return rides(spark, sf_dir).select("event_id", F.round(km, 6).alias("km"))


# ---- reports ----------------------------------------------------------------


@query(sql("""
select cast(c.year as integer) as year, cast(c.month as integer) as month,
       cast(sum(f.n_trips) as bigint) as total_trips, round(avg(f.minutes), 6) as mean_minutes,
       round(sum(f.minutes * f.n_trips) / cast(sum(f.n_trips) as double), 6) as weighted_minutes
from fact_route f join calendar c on c.id = f.day_id
group by all""", *STAR, SQL_FACT_ROUTE, SQL_CALENDAR))
def report_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and mean minutes per month, plain and weighted by trips."""
    calendar = dims.calendar_dim(trips(spark, sf_dir), "started_at")
    fact = route_fact(spark, sf_dir, segment_dimension(spark, sf_dir), route_dimension(spark, sf_dir))
    measures = report.Measures("n_trips", "total_trips", "minutes", "mean_minutes", "weighted_minutes")
    by_month = report.rollup(
        fact,
        [report.Join(calendar, "day_id", {"year": "year", "month": "month"})],
        ["year", "month"],
        measures,
    )
    rounded = by_month.withColumns({c: F.round(c, 6) for c in ("mean_minutes", "weighted_minutes")})
    return report.ordered(rounded, ["year", "month"])


@query(sql("""
select n.n_name as node, cast(sum(f.n_trips) as bigint) as total_trips
from fact_node f join nation n on n.n_nationkey = f.node_id
group by all order by total_trips desc, node limit 10""", *STAR, SQL_FACT_NODE))
def report_top_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten busiest origin stations."""
    nodes = dim_node(spark, sf_dir)
    totals = report.rollup(
        node_fact(spark, sf_dir),
        [report.Join(nodes, "node_id", {"name": "node"})],
        ["node"],
        report.Measures("n_trips", "total_trips"),
    )
    return report.top(totals, "total_trips", 10, ["node"])


@query(sql("""
select s.band, cast(sum(f.n_trips) as bigint) as total_trips
from fact_route f join segments s on s.id = f.segment_id group by all""", *STAR, SQL_FACT_ROUTE))
def report_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per age band, most first."""
    segments = segment_dimension(spark, sf_dir)
    totals = report.rollup(
        route_fact(spark, sf_dir, segments, route_dimension(spark, sf_dir)),
        [report.Join(segments, "segment_id", {"band": "band"})],
        ["band"],
        report.Measures("n_trips", "total_trips"),
    )
    return totals.orderBy(F.desc("total_trips"))


@query(sql("""
select o.n_name as origin, d.n_name as destination, cast(sum(f.n_trips) as bigint) as total_trips
from fact_route f join routes r on r.id = f.route_id
join nation o on o.n_nationkey = r.origin_id join nation d on d.n_nationkey = r.dest_id
group by all""", *STAR, SQL_FACT_ROUTE))
def report_origin_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per pair of station names: one station dimension in two roles."""
    routes = route_dimension(spark, sf_dir)
    per_route = report.rollup(
        route_fact(spark, sf_dir, segment_dimension(spark, sf_dir), routes),
        [report.Join(routes, "route_id", {"origin_id": "origin_id", "dest_id": "dest_id"})],
        ["origin_id", "dest_id"],
        report.Measures("n_trips", "n_trips"),
    )
    nodes = dim_node(spark, sf_dir)
    roles = [
        report.Join(nodes, "origin_id", {"name": "origin"}),
        report.Join(nodes, "dest_id", {"name": "destination"}),
    ]
    return report.rollup(per_route, roles, ["origin", "destination"], report.Measures("n_trips", "total_trips"))
