import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import derive
from lakeloom.operators import dims, facts, joins, keys, report
from lakeloom.operators.harmonize import drop_copies, harmonize, literal, take, union_vintages
from lakeloom.functions.cleaning import strict, strip_text


# ---- joins ------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """40% of the rows belong to key 7, 30% to NULL, the rest are spread."""
    i = F.col("id")
    key = F.when(i % 10 < 4, 7).when(i % 10 < 7, None).otherwise(i % 500).cast("bigint")
    return spark.range(20_000).select(i.alias("row"), key.alias("k"))


@pytest.fixture(scope="module")
def registry(spark):
    return spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("u"), "id").alias("name"))


def test_hot_keys(spark, skewed):
    assert set(joins.hot_keys(skewed, "k")) == {7, None}
    assert joins.hot_keys(spark.range(1000).withColumnRenamed("id", "k"), "k") == []
    assert joins.hot_keys(spark.range(0).withColumnRenamed("id", "k"), "k") == []


def test_hot_keys_of_a_sample(skewed, monkeypatch):
    monkeypatch.setattr(joins, "JUDGED_SHARE", 0.02)
    assert set(joins.hot_keys(skewed, "k")) == {7, None}


@pytest.mark.parametrize("judged", [0.0001, 1.0])
def test_rows_stay_whole_whatever_the_sample(skewed, registry, rows, monkeypatch, judged):
    monkeypatch.setattr(joins, "JUDGED_SHARE", judged)
    got = joins.left_lookup(skewed, registry, "k", 4000).select("row", "k", "name")
    assert rows(got) == rows(skewed.join(registry, "k", "left").select("row", "k", "name"))


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 4000])
def test_left_lookup_keeps_every_row(skewed, registry, rows, limit):
    # 4000 bytes hold the hot keys' registry rows but not the whole registry.
    got = joins.left_lookup(skewed, registry, "k", limit).select("row", "k", "name")
    assert rows(got) == rows(skewed.join(registry, "k", "left").select("row", "k", "name"))


def test_left_lookup_never_broadcasts_what_does_not_fit(spark, skewed, registry, rows):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = joins.left_lookup(skewed, registry, "k", 4000)
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        tiny = joins.left_lookup(skewed, registry, "k", 0)
        assert "BroadcastHashJoin" not in tiny._jdf.queryExecution().executedPlan().toString()
        assert tiny.count() == skewed.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_left_lookup_with_repeated_registry_keys(skewed, registry, rows):
    doubled = registry.union(registry)
    for limit in (joins.BROADCAST_BYTES, 4000, 0):
        got = joins.left_lookup(skewed, doubled, "k", limit).select("row", "k", "name")
        assert rows(got) == rows(skewed.join(doubled, "k", "left").select("row", "k", "name"))


def test_hot_keys_that_a_registry_repeats_are_dealt(spark, skewed, registry, rows):
    """NULL rows stay where they are, and the hot key's rows spread over parts."""
    repeated = registry.union(registry.where("k = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("n"))
    split = joins.left_lookup(skewed, repeated, "k", 100).select("row", "k", "name")
    assert "__salt" in split._jdf.queryExecution().optimizedPlan().toString()
    assert rows(split) == rows(skewed.join(repeated, "k", "left").select("row", "k", "name"))


def test_lookup_key_null_safe(spark, rows):
    dim = spark.createDataFrame([(1, "F", "a"), (2, None, "a"), (3, None, "none")], "id bigint, g string, b string")
    fact = spark.createDataFrame(
        [("F", "a", 1), (None, "a", 2), (None, "none", 3), ("X", "a", 4), ("F", None, 5)], "g string, b string, n int"
    )
    got = joins.lookup_key(fact, dim, ["g", "b"], "id", "seg", null_safe=["g"])
    assert rows(got) == [(None, 4), (None, 5), (1, 1), (2, 2), (3, 3)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(joins.orphans(child, parent, "fk", "id")) == [(2, 1), (9, 1)]


# ---- harmonize and union ----------------------------------------------------


def test_harmonize_drops_junk_and_renames(spark, rows):
    old = spark.createDataFrame([("1", "7TOK", "x")], "`_c0` string, `Key.With..Dots` string, `Género` string")
    got = harmonize(
        old,
        {
            "id": take("Key.With..Dots", strip_text("TOK"), strict("bigint")),
            "gender": take("género"),
            "extra": literal(None, "boolean"),
            "year": literal(2022, "smallint"),
        },
    )
    assert got.dtypes == [("id", "bigint"), ("gender", "string"), ("extra", "boolean"), ("year", "smallint")]
    assert rows(got) == [(7, "x", None, 2022)]


def test_harmonize_wants_its_headers(spark):
    with pytest.raises(Exception, match="missing"):
        harmonize(spark.range(1), {"x": take("missing")})


def test_union_matches_by_name(spark, rows):
    a = spark.createDataFrame([(1, "a")], "i int, s string")
    b = spark.createDataFrame([("b", 2)], "s string, i int")
    assert rows(union_vintages([a, b, a])) == [(1, "a"), (1, "a"), (2, "b")]


@pytest.mark.parametrize("way", ["listed", "broadcast", "distinct"])
@pytest.mark.parametrize("nulls", [0, 1, 3])
def test_drop_copies_by_key_is_distinct(spark, rows, monkeypatch, way, nulls):
    if way != "listed":
        monkeypatch.setattr("lakeloom.operators.harmonize.LISTED_KEYS", 0)
    if way == "distinct":
        monkeypatch.setattr("lakeloom.operators.harmonize.fits_broadcast", lambda df: False)
    data = [(1, "a")] * 400 + [(2, "b"), (2, "c"), (2, "c"), (3, None), (3, None), (4, "d")] + [(None, "x")] * nulls
    df = spark.createDataFrame(data, "id int, v string").repartition(5)
    assert rows(drop_copies(df, "id")) == rows(df.distinct()) == rows(drop_copies(df))
    only_nulls = df.where("id is null or id = 4")
    assert rows(drop_copies(only_nulls, "id")) == rows(only_nulls.distinct())


def test_drop_copies_without_any(spark, rows):
    df = spark.range(100).withColumn("v", F.lit("x"))
    assert rows(drop_copies(df, "id")) == rows(df)


@pytest.mark.parametrize("hot", [False, True])
def test_drop_copies_in_parts(spark, rows, monkeypatch, hot):
    monkeypatch.setattr("lakeloom.operators.harmonize.PART_BYTES", 20_000)
    data = [(i % 1500, f"v{i % 3000}", float(i % 2)) for i in range(4000)] + [(None, "x", None)] * 20
    if hot:
        data += [(7, "v7", 1.0)] * 4000
    df = spark.createDataFrame(data, "id int, v string, d double").repartition(5)
    got = drop_copies(df, "id")
    assert rows(got) == rows(df.distinct())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("RepartitionByExpression [id" in plan) != hot  # rows are not held before the shuffle, unless of a hot key


# ---- keys -------------------------------------------------------------------


def test_dense_key_equals_global_order(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("b"), (F.col("id") % 7).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in keys.dense_key(df, ["a", "b"]).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted((r.a, r.b) for r in df.collect())
    assert sorted(got) == [(i, b, a) for i, (a, b) in enumerate(want, 1)]


def test_dense_key_small_nulls_last_and_empty(spark, rows):
    df = spark.createDataFrame([(None, "n"), ("b", "x"), ("a", "y")], "g string, v string")
    got = keys.dense_key(df, [F.col("g").asc_nulls_last(), "v"])
    assert rows(got) == [(1, "a", "y"), (2, "b", "x"), (3, None, "n")]
    assert keys.dense_key(df.limit(0), ["g"]).count() == 0


def test_dense_key_without_order_moves_nothing(spark):
    df = spark.range(0, 50_000, 1, 7).withColumnRenamed("id", "v").where("v % 5 <> 0")
    numbered = keys.dense_key(df)
    ids = sorted(r.id for r in numbered.collect())
    assert ids == list(range(1, 40_001))


def test_unique_key(spark):
    got = keys.unique_key(spark.range(1000).repartition(5).withColumnRenamed("id", "v"))
    assert got.columns == ["id", "v"] and got.select("id").distinct().count() == 1000
    assert got.where("id is null").count() == 0


def test_unknown_member_is_added_once(spark, rows):
    df = spark.createDataFrame([("F", "a")], "g string, b string")
    once = keys.with_unknown_member(df, {"b": "none"})
    assert rows(once) == rows(keys.with_unknown_member(once, {"b": "none"})) == [(None, "none"), ("F", "a")]


# ---- dimensions -------------------------------------------------------------


@pytest.fixture(scope="module")
def trips(spark):
    day = dt.datetime(2022, 1, 1, 8, 30)
    data = [
        # trip, user, seconds, start, origin, its name, destination, its name
        (1, 10, 90, day, 1, "Alpha", 2, "Beta"),
        (2, 10, 150, day, 1, "Alpha", 2, "Beta 2"),
        (3, 11, 600, day, 2, "Beta", 1, "Zulu"),
        (4, 99, 600, day + dt.timedelta(days=1), 2, "Beta", 1, "Alpha"),
        (5, 12, 300, day, 1, "Alpha", None, None),
        (6, 12, 0, day, 3, "Gamma", 3, "Gamma"),
        (7, None, 120, day, 1, "Alpha", 2, "Beta"),
        (8, 13, None, day, 1, "Alpha", 2, "Beta"),
    ]
    return spark.createDataFrame(
        data,
        "trip bigint, user bigint, seconds int, start timestamp_ntz, o smallint, o_name string, d smallint, d_name string",
    )


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(10, "F", 25), (11, None, 26), (12, None, None), (13, "M", 70)], "user bigint, gender string, age int"
    )


def age_band():
    return derive.band(F.col("age"), (16, 26), ("16-25", "26+"), "none")


def test_node_dim(trips, rows):
    want = [(1, "Zulu"), (2, "Beta 2"), (3, "Gamma")]
    roles = [("o", "o_name"), ("d", "d_name")]
    assert rows(dims.node_dim(trips, roles)) == want
    assert rows(dims.node_dim(dims.pair_names(trips, "o", "d", "o_name", "d_name"), roles)) == want


def test_calendar_dim(trips, rows):
    got = dims.calendar_dim(trips, "start", {"day": "dia"})
    assert got.columns == ["id", "dia", "month", "week", "year", "date"]
    assert rows(got) == [(20220101, 1, 1, 52, 2022, dt.date(2022, 1, 1)), (20220102, 2, 1, 52, 2022, dt.date(2022, 1, 2))]


def test_segment_dim(users, rows):
    got = dims.segment_dim(users, F.col("gender"), age_band(), "gender", "band", "none")
    assert rows(got) == [(1, "F", "16-25"), (2, "M", "26+"), (3, None, "26+"), (4, None, "none")]


def test_pair_dim(trips, rows):
    want = [(1, 1, 2, "Alpha → Beta 2"), (2, 2, 1, "Beta → Zulu"), (3, 3, 3, "Gamma → Gamma")]
    args = ("o", "d", "o_name", "d_name", "route", " → ")
    assert rows(dims.pair_dim(trips, *args)) == want
    assert rows(dims.pair_dim(dims.pair_names(trips, "o", "d", "o_name", "d_name"), *args)) == want


# ---- facts ------------------------------------------------------------------

GRAIN = ["day", "gender", "band", "o", "d"]


def totals(trips, users):
    closed = trips.where("seconds > 0 and o is not null").withColumn("day", derive.date_key(F.col("start")))
    attributes = {"gender": F.col("gender"), "band": age_band()}
    return facts.activity(facts.enrich(closed, users, "user", attributes, {"band": "none"}), GRAIN, "seconds")


def test_facts(trips, users, rows):
    sums = totals(trips, users)
    segments = dims.segment_dim(users, F.col("gender"), age_band(), "gender", "band", "none")
    pairs = dims.pair_dim(trips, "o", "d", "o_name", "d_name", "route", " → ")
    look = facts.Lookup(segments, ("gender", "band"), "seg", null_safe=("gender",))
    routes = facts.Lookup(pairs, ("o", "d"), "route")
    keyed = ["day", "seg", "route"]
    by_route = facts.build_fact(sums.where("d is not null"), [look, routes], keyed, "n", "minutes", complete=True, numbering="ordered")
    # (90 + 150) / 2 = 2 minutes; the user without a registry row and the trip
    # without a user land in the unknown segment 4.
    assert rows(by_route) == [
        (1, 20220101, 1, 1, 2, 2), (2, 20220101, 3, 2, 1, 10), (3, 20220101, 4, 1, 1, 2), (4, 20220102, 4, 2, 1, 10),
    ]
    per_node = facts.coarsen(sums, ["day", "gender", "band", "o"]).withColumnRenamed("o", "node")
    by_node = facts.build_fact(per_node, [look], ["day", "seg", "node"], "n", id_name=None)
    assert rows(by_node) == [(20220101, 1, 1, 2), (20220101, 3, 2, 1), (20220101, 4, 1, 2), (20220102, 4, 2, 1)]
    gapped = facts.build_fact(per_node, [look], ["day", "seg", "node"], "n", numbering="unique")
    dense = facts.build_fact(per_node, [look], ["day", "seg", "node"], "n")
    assert [r[0] for r in rows(dense)] == [1, 2, 3, 4] and rows(dense.drop("id")) == rows(by_node)
    with pytest.raises(ValueError):
        facts.build_fact(per_node, [look], ["day", "seg", "node"], "n", numbering="random")
    assert gapped.columns == ["id", "day", "seg", "node", "n"] and gapped.select("id").distinct().count() == 4
    # Node totals exceed route totals by the closed trips without a destination.
    total = by_node.agg(F.sum("n")).first()[0]
    assert total == trips.where("seconds > 0").count() == by_route.agg(F.sum("n")).first()[0] + 1


def test_keys_looked_up_per_registry_row(spark, trips, users, rows):
    segments = dims.segment_dim(users, F.col("gender"), age_band(), "gender", "band", "none")
    look = facts.Lookup(segments, ("gender", "band"), "seg", null_safe=("gender",))
    attributes = {"gender": F.col("gender"), "band": age_band()}
    keyed = facts.enrich_with_key(trips, users, "user", attributes, look, {"band": "none"})
    assert rows(keyed.select("trip", "seg")) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 4), (7, 4), (8, 2)]
    without = facts.Lookup(segments.where("band <> 'none'"), ("gender", "band"), "seg", null_safe=("gender",))
    lost = facts.enrich_with_key(trips, users, "user", attributes, without, {"band": "none"})
    assert rows(lost.where("seg is null").select("trip")) == [(4,), (5,), (6,), (7,)]


def test_fact_rows_with_the_same_keys_are_merged(spark, trips, users, rows):
    sums = totals(trips, users)
    partial = spark.createDataFrame([(1, "F", "16-25")], "id bigint, gender string, band string")
    look = facts.Lookup(partial, ("gender", "band"), "seg", null_safe=("gender",))
    fact = facts.build_fact(sums, [look], ["day", "seg"], "n", id_name=None)
    assert rows(fact) == [(20220101, None, 3), (20220101, 1, 2), (20220102, None, 1)]


# ---- reports ----------------------------------------------------------------


def test_rollup_means_and_top(spark, rows):
    fact = spark.createDataFrame(
        [(1, 7, 1, 10), (1, 7, 3, 20), (2, 7, 2, 30), (3, 8, 5, 1), (9, 7, 99, 1)],
        "day int, seg int, n bigint, minutes int",
    )
    cal = spark.createDataFrame([(1, 2022, 1), (2, 2022, 1), (3, 2022, 2)], "id int, year int, month int")
    measures = report.Measures("n", "trips", "minutes", "plain", "weighted")
    by_month = report.rollup(fact, [report.Join(cal, "day", {"year": "year", "month": "month"})], ["year", "month"], measures)
    assert rows(by_month) == [(2022, 1, 6, 20.0, 130 / 6), (2022, 2, 5, 1.0, 1.0)]
    assert [r.month for r in report.ordered(by_month, ["year", "month"]).collect()] == [1, 2]
    best = report.top(by_month, "trips", 1, ["year", "month"])
    assert [(r.month, r.trips) for r in best.collect()] == [(1, 6)]


def test_rollup_with_a_dimension_in_two_roles(spark, rows):
    fact = spark.createDataFrame([(1, 2, 5), (2, 1, 7), (1, 2, 1)], "o int, d int, n bigint")
    node = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    both = [report.Join(node, "o", {"name": "from"}), report.Join(node, "d", {"name": "to"})]
    got = report.rollup(fact, both, ["from", "to"], report.Measures("n", "trips"))
    assert rows(got) == [("A", "B", 6), ("B", "A", 7)]
