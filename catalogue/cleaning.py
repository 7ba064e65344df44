"""Cleaning steps over whole tables: typed values are dirtied as text, then cleaned.

Each oracle reads the clean values, so the query passes only if cleaning
restores them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.views import SQL_TRIPS, SQL_USERS, age_band, sql, table, trips, users
from lakeloom.functions import cleaning, derive
from lakeloom.operators.harmonize import drop_copies, harmonize, literal, take, union_vintages


@query("select o_orderkey, o_custkey as user_id, cast(o_orderkey % 25 as smallint) as node_id from orders")
def clean_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with a token stuck to them."""
    token = F.lit("TOK")
    dirty = table(spark, sf_dir, "orders").select(
        F.concat(F.col("o_orderkey").cast("string"), token).alias("k"),
        F.concat(F.col("o_custkey").cast("string"), token).alias("u"),
        F.concat((F.col("o_orderkey") % 25).cast("string"), token).alias("n"),
    )
    strip = cleaning.strip_text("TOK")
    return harmonize(
        dirty,
        {
            "o_orderkey": take("k", strip, cleaning.strict("bigint")),
            "user_id": take("u", strip, cleaning.strict("bigint")),
            "node_id": take("n", strip, cleaning.strict("smallint")),
        },
    )


@query("select o_orderkey, o_custkey as user_id from orders")
def clean_float_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that went through a float on their way to text."""
    dirty = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").cast("decimal(20,1)").cast("string").alias("u")
    )
    return dirty.select(
        "o_orderkey", cleaning.strict("bigint")(cleaning.strip_text(".0")(F.col("u"))).alias("user_id")
    )


@query("select o_orderkey, cast(floor(o_totalprice) as integer) as amount from orders")
def clean_thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with a thousands separator."""
    dirty = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.format_number(F.floor("o_totalprice"), 0).alias("amount")
    )
    return dirty.select("o_orderkey", cleaning.grouped_int()(F.col("amount")).alias("amount"))


@query(
    "select c_custkey, case when c_custkey % 95 >= 6 and c_custkey % 95 <= 90 "
    "then cast(10 + c_custkey % 95 as integer) end as age from customer"
)
def clean_range_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages outside of [16, 100] become NULL, rows stay."""
    text = (10 + F.col("c_custkey") % 95).cast("string")
    dirty = table(spark, sf_dir, "customer").select("c_custkey", text.alias("age"))
    return harmonize(
        dirty,
        {"c_custkey": take("c_custkey"), "age": take("age", cleaning.grouped_int(), cleaning.null_outside(16, 100))},
    )


@query(
    "select o_orderkey, case when o_orderstatus = 'F' then true when o_orderstatus = 'O' then false end as finished, "
    "cast(null as boolean) as not_provided from orders"
)
def clean_bool_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code to a three-valued boolean, next to a column the source lacks."""
    finished = cleaning.map_values({"F": True, "O": False}, "boolean")
    return harmonize(
        table(spark, sf_dir, "orders"),
        {
            "o_orderkey": take("o_orderkey"),
            "finished": take("o_orderstatus", finished),
            "not_provided": literal(None, "boolean"),
        },
    )


@query("""
select event_id, cast(event_id as double) as id_number, cast(null as double) as type_number,
       cast(null as integer) as props_number, try_cast(round(value, 1) || '' as integer) as rounded,
       ts as stamp, cast(null as timestamp) as no_stamp
from events""")
def try_cast_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant casts of texts that do and do not parse; decimals round to integers."""
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        "event_type",
        "props",
        F.round("value", 1).cast("string").alias("value_text"),
        F.col("ts").cast("string").alias("ts_text"),
    )
    return harmonize(
        text,
        {
            "event_id": take("event_id"),
            "id_number": take("id_text", cleaning.tolerant("double")),
            "type_number": take("event_type", cleaning.tolerant("double")),
            "props_number": take("props", cleaning.tolerant("int")),
            "rounded": take("value_text", cleaning.tolerant("int")),
            "stamp": take("ts_text", cleaning.tolerant("timestamp_ntz")),
            "no_stamp": take("props", cleaning.tolerant("timestamp_ntz")),
        },
    )


@query("select event_id, strftime(ts, '%H:%M:%S') as time_text, cast(ts as date) as day from events")
def clean_time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day and dates out of text."""
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "H:mm:ss").alias("time_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    return harmonize(
        text,
        {
            "event_id": take("event_id"),
            "time_text": take("time_text", cleaning.time_of_day(native=False)),
            "day": take("day", cleaning.strict("date")),
        },
    )


def vintages(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Orders as three files of differing headers and formats, by order date."""
    orders = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey").cast("string"), F.year("o_orderdate")
    price, stamp = F.format_number(F.floor("o_totalprice"), 0), F.col("o_orderdate").cast("string")
    token = F.concat(key, F.lit("TOK")).alias("Key.With..Token")
    customer = F.col("o_custkey").cast("string")
    return {
        2022: orders.where(day <= 1996).select(
            F.lit("junk").alias("X"), token, customer.alias("User"), price.alias("Amount"), stamp.alias("At"),
            F.col("o_orderstatus").alias("Género"),
        ),
        2023: orders.where((day > 1996) & (day <= 1998)).select(
            token, customer.alias("user"), price.alias("amount"), stamp.alias("at"),
            F.col("o_orderstatus").alias("género"),
        ),
        2024: orders.where(day > 1998).select(
            key.alias("key"), F.concat(customer, F.lit(".0")).alias("user"),
            F.floor("o_totalprice").cast("string").alias("amount"), stamp.alias("at"),
        ),
    }


def vintage_fields(year: int) -> dict:
    strip, bigint = cleaning.strip_text("TOK"), cleaning.strict("bigint")
    old = year < 2024
    user_steps = (bigint,) if old else (cleaning.strip_text(".0"), bigint)
    return {
        "trip_id": take("Key.With..Token", strip, bigint) if old else take("key", bigint),
        "user_id": take("User", *user_steps),
        "amount": take("Amount", cleaning.grouped_int() if old else cleaning.tolerant("int")),
        "started_at": take("At", cleaning.strict("timestamp_ntz")),
        "gender": take("género") if old else literal(None, "string"),
        "file_year": literal(year, "smallint"),
    }


@query("""
select o_orderkey as trip_id, o_custkey as user_id, cast(floor(o_totalprice) as integer) as amount,
       o_orderdate as started_at, case when year(o_orderdate) <= 1998 then o_orderstatus end as gender,
       cast(case when year(o_orderdate) <= 1996 then 2022 when year(o_orderdate) <= 1998 then 2023 else 2024 end
            as smallint) as file_year
from orders""")
def harmonize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three vintages of differing headers and formats in one typed table."""
    files = vintages(spark, sf_dir)
    return union_vintages([harmonize(df, vintage_fields(year)) for year, df in files.items()])


SQL_REPEATED = "select * from (select * from orders union all select * from orders where o_orderstatus = 'F')"


@query(SQL_REPEATED.replace("select *", "select distinct *", 1))
def union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union with exact copies, distinct over whole rows."""
    orders = table(spark, sf_dir, "orders")
    return drop_copies(union_vintages([orders, orders.where("o_orderstatus = 'F'")]))


@query(SQL_REPEATED.replace("select *", "select distinct *", 1))
def union_dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows; only keys and the rows of repeated keys are shuffled."""
    orders = table(spark, sf_dir, "orders")
    return drop_copies(union_vintages([orders, orders.where("o_orderstatus = 'F'")]), key="o_orderkey")


@query("select distinct * from lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table united with itself and reduced to distinct rows."""
    lineitem = table(spark, sf_dir, "lineitem")
    return drop_copies(union_vintages([lineitem, lineitem]))


@query(sql("""
select count(*) as n_rows, count(dest_id) as n_dest,
       count(*) filter (where dest_id is not null and duration_s is not null) as both_known,
       count(*) filter (where duration_s > 0) as closed,
       count(*) filter (where duration_s > 60 and duration_s < 7200) as open_range,
       count(*) filter (where duration_s >= 1 and duration_s <= 86400) as closed_range,
       count(*) filter (where isodow(started_at) >= 6) as weekend,
       count(*) filter (where dest_id is not distinct from origin_id) as same_or_both_null,
       count(duration_s) / cast(count(*) as double) as known_share
from trips""", SQL_TRIPS))
def predicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of row predicate, counted in one pass."""
    duration, dest = F.col("duration_s"), F.col("dest_id")
    return trips(spark, sf_dir).agg(
        F.count("*").alias("n_rows"),
        F.count("dest_id").alias("n_dest"),
        F.count_if(dest.isNotNull() & duration.isNotNull()).alias("both_known"),
        F.count_if(duration > 0).alias("closed"),
        F.count_if((duration > 60) & (duration < 7200)).alias("open_range"),
        F.count_if(duration.between(1, 86400)).alias("closed_range"),
        F.count_if(derive.iso_weekday(F.col("started_at")).isin(6, 7)).alias("weekend"),
        F.count_if(dest.eqNullSafe(F.col("origin_id"))).alias("same_or_both_null"),
        F.try_divide(F.count("duration_s").cast("double"), F.count("*").cast("double")).alias("known_share"),
    )


@query(sql("""
select user_id, age, case when age is null then 'unknown'
       else (['16-25', '26-35', '36-50', '51-65', '66+'])[1 + (age >= 26)::int + (age >= 36)::int
            + (age >= 51)::int + (age >= 66)::int] end as band
from users""", SQL_USERS))
def age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of a number, with a default for NULL."""
    return users(spark, sf_dir).select("user_id", "age", age_band().alias("band"))
