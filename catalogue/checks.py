"""Data-quality checks and reconciliation over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.views import SQL_TRIPS, SQL_USERS, sql, table, trips, users
from lakeloom.operators import quality, reconcile
from lakeloom.operators.quality import Accepted, NotNull, Reference, RowCount, Share, Unique, run_checks


def result_sql(check: str, name: str, column: str | None, n_bad: str, n_rows: str, passed: str, source: str) -> str:
    col = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{check}' as check_name, '{name}' as table_name, {col} as column_name, "
        f"cast({n_bad} as bigint) as n_bad, cast({n_rows} as bigint) as n_rows, {passed} as passed from {source}"
    )


def null_sql(name: str, column: str, where: str = "true") -> str:
    bad = f"count(*) filter (where {column} is null and {where})"
    return result_sql("not_null", name, column, bad, "count(*)", f"{bad} = 0", name)


def accepted_sql(name: str, column: str, values: str, where: str = "true") -> str:
    bad = f"count(*) filter (where {column} not in ({values}) and {where})"
    return result_sql("accepted_values", name, column, bad, "count(*)", f"{bad} = 0", name)


def unique_sql(name: str, column: str) -> str:
    source = f"(select {column} as v, count(*) as n from {name} group by 1)"
    bad = "count(*) filter (where n > 1 and v is not null)"
    return result_sql("unique", name, column, bad, "coalesce(sum(n), 0)", f"{bad} = 0", source)


def reference_sql(name: str, column: str, parent: str, parent_column: str, label: str | None = None) -> str:
    bad = f"count(*) filter (where {column} is not null and {column} not in (select {parent_column} from {parent}))"
    return result_sql(f"references_{label or parent}", name, column, bad, "count(*)", f"{bad} = 0", name)


def row_count_sql(name: str, low: int, high: int) -> str:
    fits = f"count(*) between {low} and {high}"
    return result_sql("row_count", name, None, f"1 - cast({fits} as integer)", "count(*)", fits, name)


def share_sql(label: str, name: str, column: str, condition: str, threshold: float) -> str:
    good = f"count(*) filter (where {condition})"
    return result_sql(
        label, name, column, f"count(*) - {good}", "count(*)", f"{good} / cast(count(*) as double) >= {threshold}", name
    )


def union(*parts: str) -> str:
    return "\nunion all ".join(parts)


@query(union(
    null_sql("lineitem", "l_orderkey"), null_sql("lineitem", "l_shipdate"),
    null_sql("lineitem", "l_returnflag", "l_linestatus = 'O'"),
))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column, one of them in a scope, in one pass."""
    checks = [NotNull("l_orderkey"), NotNull("l_shipdate"), NotNull("l_returnflag", where="l_linestatus = 'O'")]
    return run_checks(table(spark, sf_dir, "lineitem"), "lineitem", checks)


@query(sql(null_sql("trips", "dest_id") + "\nunion all " + null_sql("trips", "duration_s"), SQL_TRIPS))
def dq_not_null_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that do have NULLs."""
    return run_checks(trips(spark, sf_dir), "trips", [NotNull("dest_id"), NotNull("duration_s")])


@query(union(unique_sql("lineitem", "l_orderkey"), unique_sql("lineitem", "l_shipdate")))
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that repeat values."""
    return run_checks(table(spark, sf_dir, "lineitem"), "lineitem", [Unique("l_orderkey"), Unique("l_shipdate")])


@query(union(
    accepted_sql("orders", "o_orderstatus", "'F', 'O', 'P'"), accepted_sql("orders", "o_orderstatus", "'F', 'O'"),
    accepted_sql("orders", "o_orderpriority", "'1-URGENT'", "o_orderstatus = 'F'"),
))
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values inside and outside of a list."""
    checks = [
        Accepted("o_orderstatus", ("F", "O", "P")),
        Accepted("o_orderstatus", ("F", "O")),
        Accepted("o_orderpriority", ("1-URGENT",), where="o_orderstatus = 'F'"),
    ]
    return run_checks(table(spark, sf_dir, "orders"), "orders", checks)


@query(sql(union(
    reference_sql("trips", "user_id", "customer", "c_custkey"),
    reference_sql("trips", "user_id", "users", "user_id"),
    reference_sql("trips", "dest_id", "nation", "n_nationkey"),
), SQL_TRIPS, SQL_USERS))
def dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that hold and one that does not."""
    checks = [
        Reference("user_id", "customer", "c_custkey"),
        Reference("user_id", "users", "user_id"),
        Reference("dest_id", "nation", "n_nationkey"),
    ]
    parents = {
        "customer": table(spark, sf_dir, "customer"),
        "users": users(spark, sf_dir),
        "nation": table(spark, sf_dir, "nation"),
    }
    return run_checks(trips(spark, sf_dir), "trips", checks, parents)


@query(union(row_count_sql("orders", 1, 10), row_count_sql("orders", 1000, 10**12)))
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts inside and outside of a range."""
    return run_checks(table(spark, sf_dir, "orders"), "orders", [RowCount(1, 10), RowCount(1000, 10**12)])


SHARES = (
    ("valid_duration", "duration_s >= 1 and duration_s <= 86400", 0.99, "duration_s"),
    ("known_destination", "dest_id is not null", 0.9, "dest_id"),
)


@query(sql(union(*[share_sql(n, "trips", col, cond, limit) for n, cond, limit, col in SHARES]), SQL_TRIPS))
def dq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of good rows against thresholds."""
    return run_checks(trips(spark, sf_dir), "trips", [Share(*declared) for declared in SHARES])


@query(sql("""
select count(*) filter (where duration_s >= 1 and duration_s <= 86400) / cast(count(*) as double) as share
from trips having share < 0.99""", SQL_TRIPS))
def dq_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A check as a query that returns a row if it fails."""
    return quality.failing_share(trips(spark, sf_dir), "duration_s between 1 and 86400", 0.99)


@query("""
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once."""
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return grouped.agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


@query(sql("""
select count(distinct t.user_id) as n_keys, count(*) as n_rows,
       count(distinct case when u.user_id is null then t.user_id end) as orphan_keys,
       count(*) - count(u.user_id) as orphan_rows,
       count(distinct case when u.user_id is null then t.user_id end) / cast(count(distinct t.user_id) as double)
         as orphan_key_share,
       (count(*) - count(u.user_id)) / cast(count(*) as double) as orphan_row_share
from trips t left join users u on u.user_id = t.user_id where t.user_id is not null""", SQL_TRIPS, SQL_USERS))
def reconcile_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users, and how many trips, have no registry row."""
    return reconcile.orphan_summary(trips(spark, sf_dir), users(spark, sf_dir), "user_id", "user_id")


# The second pipeline's lines: it lost the lines of one status and flag, and
# counted those of another twice.
SQL_OTHER = """
other as (
  select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem
  where not (l_returnflag = 'R' and l_linestatus = 'F')
  union all
  select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem
  where l_returnflag = 'A' and l_linestatus = 'O'),
mine as (select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem)"""


def other_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kept = lines.where(~((flag == "R") & (status == "F")))
    twice = lines.where((flag == "A") & (status == "O"))
    return lines.select(*cols), kept.unionByName(twice).select(*cols)


@query(sql("""
select coalesce(a.l_orderkey, b.l_orderkey) as l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) as l_linenumber,
       coalesce(a.l_quantity, b.l_quantity) as l_quantity, coalesce(a.l_returnflag, b.l_returnflag) as l_returnflag,
       coalesce(a.n, 0) as n_a, coalesce(b.n, 0) as n_b
from (select *, count(*) as n from mine group by all) a
full join (select *, count(*) as n from other group by all) b
  using (l_orderkey, l_linenumber, l_quantity, l_returnflag)
where coalesce(a.n, 0) <> coalesce(b.n, 0)""", SQL_OTHER))
def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows two pipelines do not have equally often."""
    mine, other = other_lines(spark, sf_dir)
    return reconcile.row_differences(mine, other)


@query(sql("""
select (select count(*) from mine) as rows_a, (select count(*) from other) as rows_b,
       (select count(*) from (select * from mine except all select * from other)) as only_a,
       (select count(*) from (select * from other except all select * from mine)) as only_b""", SQL_OTHER))
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on each side and rows only one side has."""
    mine, other = other_lines(spark, sf_dir)
    return reconcile.table_summary(mine, other)


# A mark of one side is one above the other's, too large for a double to tell.
MARK = 2**53

@query(sql(f"""
select coalesce(a.f, b.f) as l_returnflag, a.n as n_rows_a, b.n as n_rows_b, a.n is not distinct from b.n as n_rows_agrees,
       a.q as quantity_a, b.q as quantity_b, a.q is not distinct from b.q as quantity_agrees,
       a.m as mark_a, b.m as mark_b, a.m is not distinct from b.m as mark_agrees
from (select l_returnflag as f, count(*) as n, sum(l_quantity) as q,
             cast({MARK} + 1 + sum(l_linenumber * 0) as bigint) as m from mine group by all) a
full join (select l_returnflag as f, count(*) as n, sum(l_quantity) as q,
                  cast({MARK} + sum(l_linenumber * 0) as bigint) as m from other group by all) b on a.f = b.f""",
SQL_OTHER))
def reconcile_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and totals of two pipelines per group, whole numbers beyond 2**53 among them."""
    mine, other = other_lines(spark, sf_dir)
    mine = mine.withColumn("mark", F.lit(MARK + 1))
    other = other.withColumn("mark", F.lit(MARK))
    metrics = {"n_rows": F.count("*"), "quantity": F.sum("l_quantity"), "mark": F.max("mark")}
    return reconcile.metric_differences(mine, other, metrics, by=["l_returnflag"])
