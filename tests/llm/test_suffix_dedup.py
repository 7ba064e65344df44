import hashlib
import random

import numpy as np
import pytest

from lakeloom.llm import repeats
from lakeloom.llm import suffix_dedup as module
from lakeloom.llm.suffix_dedup import maximal_repeats, suffix_array, suffix_dedup


def plain(rows, length):
    """Counts and kept bytes by looking every string up."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for s in range(len(t) - length + 1):
            key = t[s : s + length]
            first[key] = min((i, s), first.get(key, (i, s)))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for s in range(len(t) - length + 1):
            if first[t[s : s + length]] < (i, s):
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def ran(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((*r[:4], hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup(docs, **options).collect())


def random_rows(seed, n, alphabet="abé"):
    rng = random.Random(seed)
    base = "".join(rng.choice(alphabet) for _ in range(600))
    rows = []
    for i in range(n):
        a = rng.randrange(500)
        part = base[a : a + rng.randrange(1, 90)]
        rows.append((rng.randrange(2 * n), "".join(rng.choice(alphabet) for _ in range(6)) + part * rng.choice([1, 2])))
    return list({i: (i, t) for i, t in rows}.values())


def test_suffix_array_and_maximal_repeats():
    rng = random.Random(1)
    for _ in range(80):
        bodies = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(4)]
        found = suffix_array(bodies, 3)
        suffixes = [bodies[b][o:] for b, o in zip(found.body, found.offset)]
        every = [b[o:] for b in bodies for o in range(len(b) - 2)]
        assert suffixes == sorted(x for x in every if sum(y[:3] == x[:3] for y in every) > 1)
        for before, own, common in zip(suffixes, suffixes[1:], found.common[1:]):
            shared = [p == q for p, q in zip(before, own)]
            assert common == (shared.index(False) if False in shared else len(shared))
        # All strings that occur twice and lose occurrences with any further byte.
        places = {}
        for n, body in enumerate(bodies):
            for s in range(len(body)):
                for e in range(s + 3, len(body) + 1):
                    places.setdefault(body[s:e], []).append(((n, s), body[s - 1 : s] or n, body[e : e + 1] or ~n))
        want = {
            (len(k), tuple(sorted(p for p, _, _ in v)))
            for k, v in places.items()
            if len(v) > 1 and len({x for _, x, _ in v}) > 1 and len({x for _, _, x in v}) > 1
        }
        got = {
            (n, tuple(sorted(zip(found.body[g].tolist(), found.offset[g].tolist()))))
            for n, g in maximal_repeats(found, 3)
        }
        assert got == want


@pytest.mark.parametrize("crowd", [512, 2])
@pytest.mark.parametrize("length,gram", [(100, 16), (20, 4), (9, 9)])
def test_documents_equal_brute_force(spark, monkeypatch, length, gram, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text[:3000]) for r in docs][:120] + [(1000 + r.doc_id, r.text) for r in docs[:6]]
    assert ran(spark, rows, length=length, gram=gram) == plain(rows, length)


def test_random_overlaps(spark, monkeypatch):
    monkeypatch.setattr(module, "ARRAY", 500)
    for seed in (1, 2):
        rows = random_rows(seed, 150)
        assert ran(spark, rows, length=12, gram=4) == plain(rows, 12)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 250), (4, "é" * 60), (5, "é" * 60), (6, "a" * 99), (7, "a" * 100)]
    assert ran(spark, rows) == plain(rows, 100)
    schema = "doc_id long, text string, hash int, th string, body int, at int"
    assert suffix_dedup(spark.createDataFrame([], schema)).collect() == []
    clash = spark.createDataFrame([(8, "q" * 120, 1, "", 2, 3), (None, "q" * 120, 1, "", 2, 3)], schema)
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup(clash).collect()) == [(0, 119), (8, 120)]


def test_a_long_text(spark):
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 123, 1_300_000, dtype=np.uint8)).decode()
    rows = [(1, text), (2, "#" + text[900_000:1_200_000])]
    got = ran(spark, rows)
    assert [r[:4] for r in got] == [(1, 1_300_000, 0, 0), (2, 300_001, 300_000, 1)]


def test_crowded_anchor(spark, monkeypatch):
    """One passage in very many different surroundings, dealt over parts that must agree."""
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = []
    for i in range(400):
        left, right = ("".join(rng.choice("xy") for _ in range(rng.randrange(9))) for _ in range(2))
        rows.append((rng.randrange(10**6), f"{i}" * 5 + left + passage[rng.randrange(40) :] + right + f"{i}" * 40))
    for crowd in (512, 7):
        monkeypatch.setattr(repeats, "CROWD", crowd)
        assert ran(spark, rows, length=60, gram=8) == plain(rows, 60)


@pytest.mark.parametrize("copies", [2, 40])
def test_repeated_rows_bring_no_bodies(spark, copies):
    """What is looked into does not grow with the copies of a row."""
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(None, "left " + passage + " right")] * copies + [(3, "other " + passage + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    units = repeats.Units("bytes", 100, 16, inside=True)
    texts = repeats.keyed(docs, "doc_id", "text")
    bodies = repeats.surroundings(texts, repeats.judged_runs(texts, units), units).collect()
    assert 0 < len(bodies) < 30 and len({(b.doc, b.lo, b.back) for b in bodies}) == len(bodies)
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup(docs).collect())
    assert got == [(0, 0)] * copies + [(3, 902)]
