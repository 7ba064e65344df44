"""Declarative data-quality checks.

A check is a small declaration; ``run_checks`` turns all checks of a table into
one result frame with a row per check.  All checks that look at single rows
share one aggregate over the table.  All unique and reference checks share one
grouping, of every checked key under the number of its check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("check_name", "table_name", "column_name", "n_bad", "n_rows", "passed")


@dataclass(frozen=True)
class NotNull:
    column: str
    where: str | None = None


@dataclass(frozen=True)
class Accepted:
    """Every value is one of ``values``; NULL passes."""

    column: str
    values: tuple
    where: str | None = None


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; NULLs are ignored.  Bad are the values, not their rows."""

    column: str
    where: str | None = None


@dataclass(frozen=True)
class Reference:
    """Every non-NULL value is a key of the table ``parent``."""

    column: str
    parent: str
    parent_column: str
    where: str | None = None


@dataclass(frozen=True)
class RowCount:
    """The number of rows lies in the closed range."""

    low: int | None = None
    high: int | None = None


@dataclass(frozen=True)
class Share:
    """At least ``threshold`` of the rows satisfy the SQL condition; an empty table passes."""

    name: str
    condition: str
    threshold: float
    column: str | None = None


Check = NotNull | Accepted | Unique | Reference | RowCount | Share


def _scope(where: str | None) -> Column:
    return F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))


def _label(check: Check) -> str:
    match check:
        case NotNull():
            return "not_null"
        case Accepted():
            return "accepted_values"
        case Unique():
            return "unique"
        case Reference():
            return f"references_{check.parent}"
        case RowCount():
            return "row_count"
        case Share():
            return check.name


def _row_condition(check: Check) -> Column:
    """What makes a row bad, for the checks that judge rows one by one."""
    match check:
        case NotNull():
            return _scope(check.where) & F.col(check.column).isNull()
        case Accepted():
            return _scope(check.where) & ~F.col(check.column).isin(*check.values)
        case Share():
            return ~F.coalesce(F.expr(check.condition), F.lit(False))


def _verdict(check: Check, n_bad: Column, n_rows: Column) -> Column:
    """Verdict as a struct of the result's number and flag columns."""
    match check:
        case RowCount():
            low_ok = F.lit(True) if check.low is None else n_rows >= check.low
            high_ok = F.lit(True) if check.high is None else n_rows <= check.high
            passed = low_ok & high_ok
            n_bad = F.when(passed, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
        case Share():
            good = F.try_divide((n_rows - n_bad).cast("double"), n_rows.cast("double"))
            passed = F.coalesce(good >= F.lit(check.threshold), F.lit(True))
        case _:
            passed = n_bad == 0
    return F.struct(
        F.lit(_label(check)).alias("check_name"),
        F.lit(getattr(check, "column", None)).cast("string").alias("column_name"),
        n_bad.alias("n_bad"),
        n_rows.alias("n_rows"),
        passed.alias("passed"),
    )


def _one_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = [F.count("*").alias("n_rows")]
    for i, check in enumerate(checks):
        condition = _row_condition(check)
        if condition is not None:
            counts.append(F.count_if(condition).alias(f"bad_{i}"))
    totals = df.agg(*counts)
    verdicts = [
        _verdict(check, F.col(f"bad_{i}") if f"bad_{i}" in totals.columns else F.lit(0), F.col("n_rows"))
        for i, check in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*verdicts)))


_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _keyed(df: DataFrame, checks: Sequence[Unique | Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """All unique and reference checks of a table from one scan of it.

    Every checked key becomes a row under the number of its check, the parents' keys next to them, and one grouping
    counts them all.  Rows are combined on the map side, so a key that owns most of the rows costs no more than any.
    """
    types = dict(df.dtypes)
    sides = [(parents[c.parent], c.parent_column) if isinstance(c, Reference) else None for c in checks]
    kinds = {types[c.column] for c in checks} | {dict(p.dtypes)[k] for p, k in filter(None, sides)}
    # Keys of all checks share a column: whole numbers as such, others as text in the checked column's type.
    common = "bigint" if kinds <= set(_WHOLE_NUMBERS) else "string"

    def entry(number: int, key: Column, n_rows: Column, used: Column, known: bool) -> Column:
        return F.struct(
            F.lit(number).alias("check"), key.cast(common).alias("key"), n_rows.cast("bigint").alias("n_rows"),
            used.cast("bigint").alias("used"), F.lit(known).alias("known"),
        )

    entries = [
        entry(i, F.col(c.column), F.lit(1), _scope(c.where) & F.col(c.column).isNotNull(), False)
        for i, c in enumerate(checks)
    ]
    rows = df.select(F.inline(F.array(*entries)))
    for i, (check, side) in enumerate(zip(checks, sides)):
        if side is not None:
            key = F.col(side[1]).cast(types[check.column])
            known = entry(i, key, F.lit(0), F.lit(False), True)
            rows = rows.unionByName(side[0].select(F.inline(F.array(known))))
    per_key = rows.groupBy("check", "key").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("used").alias("used"), F.bool_or("known").alias("known")
    )
    zero = F.lit(0).cast("bigint")
    sums = []
    for i, check in enumerate(checks):
        own = F.col("check") == i
        sums.append(F.coalesce(F.sum(F.when(own, F.col("n_rows"))), zero).alias(f"rows_{i}"))
        if isinstance(check, Unique):
            sums.append(F.count_if(own & (F.col("used") > 1)).alias(f"bad_{i}"))
        else:
            sums.append(F.coalesce(F.sum(F.when(own & ~F.col("known"), F.col("used"))), zero).alias(f"bad_{i}"))
    totals = per_key.agg(*sums)
    verdicts = [_verdict(c, F.col(f"bad_{i}"), F.col(f"rows_{i}")) for i, c in enumerate(checks)]
    return totals.select(F.inline(F.array(*verdicts)))


def run_checks(
    df: DataFrame, table: str, checks: Sequence[Check], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Evaluate ``checks`` on ``df``: one row per check, see ``RESULT_COLUMNS``; two scans at most."""
    keyed = [c for c in checks if isinstance(c, (Unique, Reference))]
    by_row = [c for c in checks if c not in keyed]
    parts = [_one_pass(df, by_row)] if by_row else []
    if keyed:
        parts.append(_keyed(df, keyed, parents or {}))
    return reduce(DataFrame.unionByName, parts).withColumn("table_name", F.lit(table)).select(*RESULT_COLUMNS)


def share(df: DataFrame, condition: str, name: str = "share") -> DataFrame:
    """The share of rows that satisfy a condition; NULL for an empty table."""
    good = F.count_if(F.expr(condition)).cast("double")
    return df.agg(F.try_divide(good, F.count("*").cast("double")).alias(name))


def failing_share(df: DataFrame, condition: str, threshold: float, name: str = "share") -> DataFrame:
    """A check as a query: the share if it is under the threshold, else no row."""
    return share(df, condition, name).where(F.col(name) < threshold)


class ChecksFailed(Exception):
    """Raised with the failed checks' names."""


def require_passed(results: DataFrame) -> None:
    """Fail if any check failed.  There is one row per declared check to fetch."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        raise ChecksFailed(
            ", ".join(f"{r.table_name}.{r.column_name or '*'} {r.check_name} ({r.n_bad} bad)" for r in failed)
        )
