import random
import re

import pytest

from lakeloom.llm import repeats
from lakeloom.llm.substring_dedup import substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(rows, length):
    """Word counts, removed words and kept text by looking every window up."""
    words = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    least = {}
    for i, w in words:
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - length + 1):
            if least[tuple(w[s : s + length])] < i:
                gone.update(range(s, s + length))
        out.append((i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()))
    return sorted(out)


def ran(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in substring_dedup(docs, **options).collect())


@pytest.mark.parametrize("length,gram", [(50, 10), (6, 2), (5, 5), (3, 1)])
@pytest.mark.parametrize("crowd", [512, 2])
def test_documents_equal_brute_force(spark, monkeypatch, length, gram, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    assert ran(spark, rows, length=length, gram=gram) == plain(rows, length)


def test_partial_overlaps_ties_and_repeats(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5)] + ["é", "a b"]
    rows = []
    base = [rng.choice(words) for _ in range(400)]
    for i in range(120):
        a = rng.randrange(300)
        part = base[a : a + rng.randrange(1, 60)]
        rows.append((rng.randrange(60), "\t".join([rng.choice(words) for _ in range(5)] + part * rng.choice([1, 2]))))
    rows += rows[:10]
    assert ran(spark, rows, length=8, gram=3) == plain(rows, 8)


def test_edges(spark):
    text = " ".join(f"x{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, text), (5, "y " + text + "\x0bz"), (6, text.replace(" ", "\r\n"))]
    got = {r[0]: r[1:] for r in ran(spark, rows)}
    assert got[1] == got[2] == got[3] == (0, 0, "")
    assert got[4] == (60, 0, text) and got[5] == (62, 60, "y z") and got[6] == (60, 60, "")
    nothing = spark.createDataFrame([], "doc_id long, text string, hash int, doc string, th string, spans int")
    assert substring_dedup(nothing).collect() == []
    clash = spark.createDataFrame([(None, text, 1), (7, text, 2)], "doc_id long, text string, th int")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup(clash).collect()) == [(0, 0), (7, 60)]


def test_a_long_text(spark):
    words = [f"v{i * 7919 % 5003}" for i in range(300_000)]
    rows = [(1, " ".join(words[:1000])), (2, " ".join(words))]
    got = ran(spark, rows)
    assert got[1][:3] == (2, 300_000, plain([(1, rows[0][1]), (2, rows[1][1])], 50)[1][2])


def test_words_that_sums_of_letters_confuse(spark):
    """The Thue-Morse word and its complement have one polynomial hash modulo 2**64, whatever the odd base."""
    one = [bin(n).count("1") % 2 for n in range(1024)]
    same = " ".join(f"s{n}" for n in range(49))
    rows = [(1, same + " " + "".join("ab"[b] for b in one)), (2, same + " " + "".join("ba"[b] for b in one))]
    rows += [(3, rows[0][1] + " x")]
    assert [r[:3] for r in ran(spark, rows)] == [(1, 50, 0), (2, 50, 0), (3, 51, 50)]


def test_crowded_anchor(spark, monkeypatch):
    rng = random.Random(6)
    passage = [f"p{n}" for n in range(60)]
    rows = []
    for i in range(300):
        cut = rng.randrange(30)
        words = [f"{i}a"] + [rng.choice("xy") for _ in range(rng.randrange(5))] + passage[cut : 60 - rng.randrange(20)]
        rows.append((rng.randrange(200), " ".join(words + [rng.choice("xy") for _ in range(4)])))
    for crowd in (512, 5):
        monkeypatch.setattr(repeats, "CROWD", crowd)
        assert ran(spark, rows, length=20, gram=4) == plain(rows, 20)


@pytest.mark.parametrize("copies", [2, 50])
def test_repeated_rows_bring_no_bodies(spark, copies):
    passage = " ".join(f"p{n}" for n in range(200))
    rows = [(1, "left " + passage + " right")] * copies + [(3, "other " + passage + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    units = repeats.Units("words", 50, 10, inside=False)
    texts = repeats.keyed(docs, "doc_id", "text")
    bodies = repeats.surroundings(texts, repeats.judged_runs(texts, units), units).collect()
    assert 0 < len(bodies) < 30 and len({(b.doc, b.lo, b.back) for b in bodies}) == len(bodies)
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup(docs).collect()) == [(1, 0)] * copies + [(3, 200)]
