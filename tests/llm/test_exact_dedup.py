import hashlib

from pyspark.sql import functions as F

from lakeloom.llm import bitmap
from lakeloom.llm import exact_dedup as module
from lakeloom.llm.bitmap import LEAST, MOST, bits_for, maybe_in
from lakeloom.llm.exact_dedup import drop_copies, exact_dedup


def squeezed(text):
    return "".join(c for c in (text or "") if c not in " \t\n\x0b\x0c\r")


def plain(rows):
    norm = {n: squeezed(t) for n, (_, t) in enumerate(rows)}
    out = []
    for n, (i, _) in enumerate(rows):
        same = [m for m in norm if norm[m] == norm[n]]
        keep = min(same, key=lambda m: (-len(rows[m][1] or ""), rows[m][0] is not None, rows[m][0]))
        keep_id = rows[keep][0]
        out.append((i, keep_id, len(same), i == keep_id, hashlib.sha256(norm[n].encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a  b\tc"), (4, "a\nb\x0bc "), (5, None), (6, ""), (7, " \r\n"), (8, " "),
    (9, "é"), (10, "é"), (11, "ABC"), (12, "abc" * 50_000), (13, "abc " * 50_000), (14, "x"), (14, "x"),
    (None, "y"), (15, "y"), (16, "x"),
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup(docs).collect()), key=str) == plain(ROWS)


def test_collisions_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(module.F, "md5", lambda c: F.substring(F.hex(F.length(c)), 1, 2))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup(docs).collect()), key=str) == plain(ROWS)


def test_bitmap_passes_all_keys(spark):
    rows = spark.range(2000).withColumn("k", F.md5(F.col("id").cast("string")))
    keys = rows.where("id % 7 = 0").select("k")
    found = {r.id for r in maybe_in(rows, keys, "k").collect()}
    assert {i for i in range(2000) if i % 7 == 0} <= found and len(found) < 400


def test_rows_that_stay_and_empty_tables(spark):
    schema = "doc_id long, text string, hash int, n string, norm int"
    assert exact_dedup(spark.createDataFrame([], schema)).collect() == []
    rows = [*ROWS, (14, "only here"), (12, "ab c")]
    docs = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], schema)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    want = {(i, sha) for i, _, _, keep, sha in plain(rows) if keep}
    got = [(r.doc_id, hashlib.sha256(squeezed(r.text).encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want and (14, hashlib.sha256(b"onlyhere").hexdigest()) in got


def test_odd_columns_and_a_hot_null_id(spark):
    """Columns with dots, maps and clashing names; a third of the rows without an id, many of them equal."""
    schema = "doc_id long, text string, source string, `a.b` string, m map<string,int>, __row int, hash int, size int"
    schema = schema.replace("__row", "row")
    rows = [(n if n % 3 else None, f"text {n if n % 2 else 0}", "s", "x", {"k": n}, n, 1, 2) for n in range(300)]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert all(r.m["k"] == r.row and r["a.b"] == "x" for r in found)
    # 150 texts of their own and "text 0", whose smallest id is NULL.
    assert len(found) == len({r.text for r in found}) == 151
    assert [r.doc_id for r in found if r.text == "text 0"] == [None]


def test_bitmap_is_sized_by_the_keys(spark, monkeypatch):
    assert bits_for(0) == bits_for(1000) == LEAST and bits_for(1 << 20) == 1 << 24
    assert bits_for(50_000_000) == MOST and bits_for(10**9) is None
    rows = spark.range(400_000).withColumn("k", F.md5(F.col("id").cast("string")))
    keys = rows.where("id % 4 = 0").select("k")
    others = rows.where("id % 4 > 0")
    assert 0 < maybe_in(others, keys, "k").count() < 300_000 / 16
    monkeypatch.setattr(bitmap, "MOST", 1 << 10)
    assert maybe_in(others, keys, "k").count() == 300_000
