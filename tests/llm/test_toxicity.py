"""Subwords against plain code, gradients against differences, and held-out accuracy."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import toxicity
from lakeloom.llm.toxicity import GRAMS, Bags, Scorer, calibrated, count_words, fit, subwords, toxicity_scores, train

DOCS, LABELS = (f"/root/testdata/sf0.1/{name}.parquet" for name in ("documents", "labels"))


def test_words():
    assert count_words("The IDIOT!! the,  id1ot\n### ¿loser?") == Counter({"the": 2, "idiot": 1, "id1ot": 1, "loser": 1})
    assert count_words("") == count_words(" \n") == Counter()


def test_words_of_long_texts_in_parts(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["ab", "ü", " ", "\n", "!"]) for _ in range(3000))
    want = count_words(text)
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    assert count_words(text) == want


def test_subwords_are_those_of_plain_code():
    """Equal n-grams have equal buckets, different ones hardly ever."""
    words = ["idiot", "idiots", "é", "日本語", "a", "idiot", "x" * 50]
    starts, buckets = subwords(words)
    bucket_of = {}
    for n, word in enumerate(words):
        marked = f"<{word}>"
        grams = [marked[i : i + k] for k in GRAMS for i in range(len(marked) - k + 1)] + [("whole", word)]
        own = buckets[starts[n] : starts[n + 1]].tolist()
        assert len(own) == len(grams)
        for gram, bucket in zip(grams, own):
            assert bucket_of.setdefault(gram, bucket) == bucket
    assert len(set(bucket_of.values())) >= len(bucket_of) - 1


def sample(rng, n, bad):
    plain = ["the", "and", "ofer", "wat", "lining", "thers", "entor", "inged", "ash", "errand"]
    docs, labels = [], []
    for _ in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.3
        if toxic:
            words += rng.choices(bad, k=1 + len(words) // 20)
        counts = Counter(words)
        docs.append((list(counts), list(counts.values())))
        labels.append(int(toxic))
    return docs, np.array(labels)


def test_unseen_misspellings_are_caught():
    rng = random.Random(8)
    docs, labels = sample(rng, 400, ["stupid", "moronic", "worthless"])
    model = fit(docs, labels, share=0.3, steps=120)
    scorer = Scorer(model)
    clean = " ".join(rng.choices(["the", "and", "ofer", "wat", "lining"], k=100))
    scores = scorer.scores([clean, clean + " stupid moronic" * 4, clean + " stupidd moroniic wworthless sstupid" * 4, ""])
    assert scores[0] < 0.2 and scores[1] > 0.7 and scores[2] > 0.7 and 0 <= scores[3] <= 1


def test_training_is_repeatable_and_needs_both_labels():
    docs, labels = sample(random.Random(1), 60, ["bad"])
    one, two = (fit(docs, labels, share=0.3, steps=10) for _ in range(2))
    assert (one.margins == two.margins).all() and (one.slope, one.offset) == (two.slope, two.offset)
    for some in ([], [0] * 60):
        scores = Scorer(fit(docs[: len(some)], np.array(some, dtype=int), share=0.2)).scores(["bad", ""])
        assert scores == pytest.approx([0.2, 0.2])


def test_calibration_is_the_best_logistic_curve():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 2, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * x - 1)))).astype(int)
    slope, offset = calibrated(x, labels, labels.mean())
    assert slope == pytest.approx(1.5, abs=0.15) and offset == pytest.approx(-1, abs=0.15)


def test_means_are_those_of_the_scorer():
    docs, labels = sample(random.Random(2), 30, ["bad"])
    model = fit(docs, labels, share=0.3, steps=20)
    texts = [" ".join(word for word, n in zip(*doc) for _ in range(n)) for doc in docs]
    scorer = Scorer(model)
    assert Bags(docs).mean_margins(model.margins) == pytest.approx([scorer.mean_margin(t) for t in texts])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    labels = spark.read.parquet(LABELS)
    rows = toxicity_scores(docs, train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    aside = [r for r in rows if r.held_out]
    one, zero = ([r.score for r in aside if r.toxic == label] for label in (1, 0))
    # Every eighth toxic document here has no toxic word.
    above = np.mean([np.mean(np.array(zero) < score) for score in one])
    assert above > 0.82 and np.mean(np.array(zero) >= 0.7) < 0.03


def test_odd_rows(spark):
    schema = "doc_id long, text string, score int, `held.out` string"
    rows = [(1, None, 1, ""), (1, "bad bad", 2, ""), (None, "", 3, ""), (4, "x" * 100_000 + " bad " * 30_000, 4, "")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = toxicity_scores(docs, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert toxicity_scores(docs.limit(0), train(docs.limit(0), labels.limit(0))).collect() == []
