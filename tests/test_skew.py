"""Operators against brute force in Python where one key, and one copy, holds a third of the rows."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import derive
from lakeloom.operators import dims, facts, joins, keys, quality, reconcile, report
from lakeloom.operators.harmonize import drop_copies

HOT_USER, HOT_NODE = 5, 3


@pytest.fixture(scope="module")
def trip_rows():
    """A third of the trips one user's, a third exact copies of one trip, some keys NULL."""
    rng = random.Random(11)
    first = dt.datetime(2024, 2, 27)
    copy = (0, HOT_USER, 120, first, HOT_NODE, "n3", 1, "n1")
    rows = [copy] * 400
    for i in range(1, 801):
        user = HOT_USER if i % 2 else rng.choice([None, *range(10, 60)])
        origin = HOT_NODE if rng.random() < 0.4 else rng.choice([None, 0, 1, 2])
        dest = rng.choice([None, 0, 1, 2, HOT_NODE])
        seconds = rng.choice([None, 0, 60, 61, 90, 150, 7199, 7200, rng.randrange(5000)])
        start = first + dt.timedelta(hours=rng.randrange(24 * 5))
        names = [None if n is None else rng.choice([f"n{n}", f"n{n} old", f"é{n}"]) for n in (origin, dest)]
        rows.append((i, user, seconds, start, origin, names[0], dest, names[1]))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def user_rows():
    rng = random.Random(12)
    users = [HOT_USER, *range(20, 60)]
    return [(u, rng.choice(["F", "M", None]), rng.choice([None, 10, 16, 25, 26, 70])) for u in users]


@pytest.fixture(scope="module")
def trips(spark, trip_rows):
    schema = (
        "trip bigint, user bigint, seconds int, start timestamp_ntz, o smallint, o_name string, d smallint, "
        "d_name string"
    )
    return spark.createDataFrame(trip_rows, schema).repartition(6)


@pytest.fixture(scope="module")
def users(spark, user_rows):
    return spark.createDataFrame(user_rows, "user bigint, gender string, age int")


def band_of(age):
    return "none" if age is None or age < 16 else "16-25" if age <= 25 else "26+"


def age_band():
    return derive.band(F.col("age"), (16, 26), ("16-25", "26+"), "none")


def null_last(row):
    return [(v is None, v) for v in row]


@pytest.mark.parametrize("key", [None, "trip", "user"])
def test_copies(trips, trip_rows, rows, key):
    got = rows(drop_copies(trips, key))
    assert len(got) == len(set(trip_rows)) and set(got) == set(trip_rows)


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 600, 0])
def test_facts(trips, users, trip_rows, user_rows, limit, monkeypatch):
    monkeypatch.setattr(joins.left_lookup, "__defaults__", (limit,))
    person = {u: (g, band_of(a)) for u, g, a in user_rows}
    segments = sorted({*person.values(), (None, "none")}, key=null_last)
    segment_id = {s: i for i, s in enumerate(segments, 1)}
    names = collections.defaultdict(set)
    for t in trip_rows:
        if t[4] is not None and t[6] is not None:
            names[t[4], t[6]].add((t[5], t[7]))
    route_id = {pair: i for i, pair in enumerate(sorted(names), 1)}
    sums = collections.defaultdict(list)
    for _, user, seconds, start, o, _, d, _ in trip_rows:
        if seconds and o is not None:
            segment = segment_id[person.get(user, (None, "none"))]
            sums[int(start.strftime("%Y%m%d")), segment, o, d].append(seconds)
    by_route = {(day, s, route_id[o, d]): v for (day, s, o, d), v in sums.items() if d is not None}
    by_node = collections.Counter()
    for (day, s, o, _), v in sums.items():
        by_node[day, s, o] += len(v)

    segment_dim = dims.segment_dim(users, F.col("gender"), age_band(), "gender", "band", "none")
    assert {(r.id, (r.gender, r.band)) for r in segment_dim.collect()} == {(i, s) for s, i in segment_id.items()}
    routes = dims.pair_dim(trips, "o", "d", "o_name", "d_name", "route", " → ")
    assert {(r.id, r.o, r.d, r.route) for r in routes.collect()} == {
        (route_id[p], *p, max(a for a, _ in n) + " → " + max(b for _, b in n)) for p, n in names.items()
    }
    closed = trips.where("seconds > 0 and o is not null").withColumn("day", derive.date_key(F.col("start")))
    look = facts.Lookup(segment_dim, ("gender", "band"), "seg", null_safe=("gender",))
    attributes = {"gender": F.col("gender"), "band": age_band()}
    keyed = facts.enrich_with_key(closed, users, "user", attributes, look, {"band": "none"})
    totals = facts.activity(keyed, ["day", "seg", "o", "d"], "seconds")
    fact = facts.build_fact(
        totals.where("d is not null"), [facts.Lookup(routes, ("o", "d"), "route")], ["day", "seg", "route"], "n",
        "minutes", complete=True, numbering="ordered",
    )
    got = [tuple(r) for r in fact.orderBy("id").collect()]
    assert got == [(i, *k, len(v), round(sum(v) / len(v) / 60)) for i, (k, v) in enumerate(sorted(by_route.items()), 1)]
    node = facts.build_fact(facts.coarsen(totals, ["day", "seg", "o"]), [], ["day", "seg", "o"], "n")
    assert {(r.day, r.seg, r.o): r.n for r in node.collect()} == by_node
    assert sorted(r.id for r in node.collect()) == list(range(1, len(by_node) + 1))


def test_nodes_and_days(trips, trip_rows):
    names = collections.defaultdict(set)
    for t in trip_rows:
        for i in (4, 6):
            if t[i] is not None:
                names[t[i]].add(t[i + 1])
    got = dims.node_dim(trips, [("o", "o_name"), ("d", "d_name")])
    assert {r.id: r.name for r in got.collect()} == {i: max(n) for i, n in names.items()}
    days = dims.calendar_dim(trips, "start")
    assert {tuple(r) for r in days.collect()} == {
        (int(d.strftime("%Y%m%d")), d.day, d.month, d.isocalendar().week, d.year, d)
        for d in {t[3].date() for t in trip_rows}
    }


def test_orphans_and_references(trips, users, trip_rows, user_rows, rows):
    known = {u[0] for u in user_rows}
    lost = collections.Counter(t[1] for t in trip_rows if t[1] is not None and t[1] not in known)
    assert rows(joins.orphans(trips, users, "user", "user")) == sorted(lost.items())
    check = quality.run_checks(trips, "trips", [quality.Reference("user", "users", "user")], {"users": users}).first()
    assert (check.n_bad, check.n_rows) == (sum(lost.values()), len(trip_rows))
    with_user = [t[1] for t in trip_rows if t[1] is not None]
    summary = reconcile.orphan_summary(trips, users, "user", "user").first()
    assert tuple(summary)[:4] == (len(set(with_user)), len(with_user), len(lost), sum(lost.values()))


def test_unique_and_duplicates(trips, trip_rows):
    per_trip = collections.Counter(t[0] for t in trip_rows)
    check = quality.run_checks(trips, "trips", [quality.Unique("trip")]).first()
    assert check.n_bad == sum(n > 1 for n in per_trip.values()) == 1


def test_row_differences(trips, trip_rows, rows):
    fewer = [t for t in trip_rows if t[4] != HOT_NODE]
    a, b = collections.Counter(trip_rows), collections.Counter(fewer)
    got = {tuple(r)[:-2]: (r.n_a, r.n_b) for r in reconcile.row_differences(trips, trips.where("o is null or o <> 3")).collect()}
    assert got == {t: (a[t], b[t]) for t in a if a[t] != b[t]}


def test_rollup(spark, trips, trip_rows):
    node = spark.createDataFrame([(0, "a"), (1, "a"), (HOT_NODE, "hot")], "id int, label string")
    fact = trips.select("o", F.lit(2).cast("bigint").alias("n"), F.col("seconds").alias("minutes"))
    measures = report.Measures("n", "total", "minutes", "plain", "weighted")
    got = report.rollup(fact, [report.Join(node, "o", {"label": "label"})], ["label"], measures)
    label = {0: "a", 1: "a", HOT_NODE: "hot"}
    groups = collections.defaultdict(list)
    for t in trip_rows:
        if t[4] in label:
            groups[label[t[4]]].append(t[2])
    want = {}
    for name, values in groups.items():
        known = [v for v in values if v is not None]
        want[name] = (2 * len(values), sum(known) / len(known), sum(known) / len(known))
    assert {r.label: (r.total, r.plain, r.weighted) for r in got.collect()} == want


def test_dense_keys(trips, trip_rows):
    assert sorted(r.id for r in keys.dense_key(trips).collect()) == list(range(1, len(trip_rows) + 1))
    ordered = keys.dense_key(trips.distinct(), ["trip"]).orderBy("id").collect()
    assert [r.trip for r in ordered] == sorted({t[0] for t in trip_rows})
