import pytest
from pyspark.sql import functions as F

from lakeloom.operators import reconcile
from lakeloom.operators.quality import (
    RESULT_COLUMNS,
    Accepted,
    ChecksFailed,
    NotNull,
    Reference,
    RowCount,
    Share,
    Unique,
    failing_share,
    require_passed,
    run_checks,
    share,
)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", None), (2, "z", 99), (None, None, 10), (None, "z", 11)], "id int, code string, fk int"
    )


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(10,), (11,), (11,), (None,)], "key int")


def verdicts(df):
    return {(r.check_name, r.column_name): (r.n_bad, r.n_rows, r.passed) for r in df.collect()}


def test_every_kind_of_check(table, parent):
    checks = [
        NotNull("id"),
        NotNull("id", where="code = 'z'"),
        Accepted("code", ("a", "b")),
        Accepted("code", ("a", "b"), where="id is not null"),
        Unique("id"),
        Reference("fk", "parent", "key"),
        RowCount(1, 4),
        Share("known", "fk is not null", 0.8, "fk"),
    ]
    results = run_checks(table, "t", checks, {"parent": parent})
    assert results.columns == list(RESULT_COLUMNS)
    got = sorted((r.check_name, r.column_name or "", r.n_bad, r.n_rows, r.passed) for r in results.collect())
    assert got == [
        ("accepted_values", "code", 1, 5, False),
        ("accepted_values", "code", 2, 5, False),
        ("known", "fk", 1, 5, True),
        ("not_null", "id", 1, 5, False),
        ("not_null", "id", 2, 5, False),
        ("references_parent", "fk", 1, 5, False),
        ("row_count", "", 1, 5, False),
        ("unique", "id", 1, 5, False),
    ]


def test_scoped_unique_and_reference(table, parent):
    checks = [Unique("code", where="id is not null"), Reference("fk", "parent", "key", where="code <> 'z'")]
    assert verdicts(run_checks(table, "t", checks, {"parent": parent})) == {
        ("unique", "code"): (0, 5, True),
        ("references_parent", "fk"): (0, 5, True),
    }


def test_empty_table_passes_all_but_a_minimum(table, parent):
    empty = table.limit(0)
    checks = [
        NotNull("id"), Unique("id"), Accepted("code", ("a",)), Reference("fk", "parent", "key"),
        Share("known", "fk is not null", 0.99), RowCount(low=1),
    ]
    got = verdicts(run_checks(empty, "t", checks, {"parent": parent}))
    assert [k for k, (_, _, passed) in got.items() if not passed] == [("row_count", None)]
    assert {n for _, n, _ in got.values()} == {0}


def test_single_row_checks_share_one_scan(table):
    checks = [NotNull("id"), NotNull("code"), Accepted("code", ("a",)), Share("s", "fk > 0", 0.5), RowCount(1, 9)]
    plan = run_checks(table, "t", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_require_passed(table):
    require_passed(run_checks(table, "t", [RowCount(5, 5)]))
    with pytest.raises(ChecksFailed, match=r"t\.id not_null \(2 bad\)"):
        require_passed(run_checks(table, "t", [NotNull("id")]))


def test_share_as_a_query(table):
    assert share(table, "fk is not null").first()[0] == 0.8
    assert failing_share(table, "fk is not null", 0.8).count() == 0
    assert failing_share(table, "fk is not null", 0.81).count() == 1
    assert share(table.limit(0), "fk is not null").first()[0] is None
    assert failing_share(table.limit(0), "fk is not null", 0.99).count() == 0


# ---- reconciliation ---------------------------------------------------------


def test_row_differences(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "c")], "id int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("d", 3)], "v string, id int")
    assert rows(reconcile.row_differences(a, b)) == [(1, "x", 2, 1), (3, "c", 1, 0), (3, "d", 0, 1)]
    assert rows(reconcile.table_summary(a, b)) == [(4, 3, 2, 1)]
    assert rows(reconcile.table_summary(a, a)) == [(4, 4, 0, 0)]
    assert rows(reconcile.table_summary(a.limit(0), b.limit(0))) == [(0, 0, 0, 0)]


def test_metric_differences(spark, rows):
    a = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0)], "g int, v double")
    b = spark.createDataFrame([(1, 15.0), (1, 15.0), (3, 1.0)], "g int, v double")
    metrics = {"n": F.count("*"), "mean": F.avg("v"), "top": F.max("v")}
    got = reconcile.metric_differences(a, b, metrics, by=["g"])
    assert got.columns == ["g", "n_a", "n_b", "n_agrees", "mean_a", "mean_b", "mean_agrees", "top_a", "top_b", "top_agrees"]
    assert rows(got) == [
        (1, 2, 2, True, 15.0, 15.0, True, 20.0, 15.0, False),
        (2, 1, None, False, 5.0, None, False, 5.0, None, False),
        (3, None, 1, False, None, 1.0, False, None, 1.0, False),
    ]
    whole = reconcile.metric_differences(a, b, {"top": F.max("v")}, tolerance=0.5)
    assert rows(whole) == [(20.0, 15.0, True)]


def test_metrics_keep_their_types(spark, rows):
    a = spark.createDataFrame([(2**53 + 1, "x", None)], "n bigint, t string, d double")
    b = spark.createDataFrame([(2**53, "x", None)], "n bigint, t string, d double")
    metrics = {"n": F.sum("n"), "t": F.max("t"), "d": F.sum("d")}
    got = reconcile.metric_differences(a, b, metrics)
    assert rows(got) == [(2**53 + 1, 2**53, False, "x", "x", True, None, None, True)]


def test_sums_of_doubles_in_another_order(spark, rows):
    values = [(1e16,), (1.0,), (-1e16,), (0.1,), (0.2,), (3e5,)]
    a = spark.createDataFrame(values[3:], "v double").coalesce(1)
    b = spark.createDataFrame(values[3:][::-1], "v double").coalesce(1)
    assert rows(reconcile.metric_differences(a, b, {"s": F.sum("v")}).select("s_agrees")) == [(True,)]


def test_orphan_summary(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,)], "u int")
    parent = spark.createDataFrame([(1,), (1,), (5,), (None,)], "id int")
    assert rows(reconcile.orphan_summary(child, parent, "u", "id")) == [(3, 5, 2, 3, 2 / 3, 0.6)]
    assert rows(reconcile.orphan_summary(child.limit(0), parent, "u", "id")) == [(0, 0, 0, 0, None, None)]
