import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm.quality import FEATURES, Trees, fit, keep_good, matrix, quality_scores, train

SF_DIR = "/root/testdata/sf0.01"


def plain_score(model, row):
    """One tree after the other, one node after the other."""
    total = model.start
    inner = model.feature.shape[1]
    for feature, threshold, value in zip(model.feature, model.threshold, model.value):
        node = 0
        while node < inner:
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += value[node - inner]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 5))
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] < -0.5)).astype(float)
    model = fit(rows, labels, trees=12, depth=3)
    scores = model.score(rows)
    assert np.allclose(scores, [plain_score(model, r) for r in rows])
    assert ((scores > 0.5) == (labels == 1)).mean() > 0.95
    again = fit(rows, labels, trees=12, depth=3)
    assert np.array_equal(again.score(rows), scores)


def test_one_label_gives_a_constant():
    assert isinstance(fit(np.zeros((0, 3)), np.zeros(0)), Trees)
    assert fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.9).all()


def test_statistics_are_defined_for_all_texts():
    texts = [b"", b" \n", b"a", b"\x00", "é".encode() * 10, b"x " * 100_000, b"!!!", b"A\n\nA\n"]
    rows = matrix(texts)
    assert rows.shape == (len(texts), len(FEATURES)) and np.isfinite(rows).all()
    assert matrix([]).shape == (0, len(FEATURES))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_held_out_labels(spark, tables):
    docs, labels = tables
    model = train(docs, labels)
    got = {r.doc_id: r for r in quality_scores(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97 and {a for a, _ in held} == {0, 1}
    # Held-out labels have no influence.
    flipped = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
    other = train(docs, labels.withColumn("quality", F.coalesce(flipped, F.col("quality")).cast("int")))
    assert np.array_equal(other.threshold, model.threshold) and np.array_equal(other.value, model.value)


def test_bound_of_the_sample(tables):
    docs, labels = tables
    small = train(docs, labels, max_rows=60)
    assert len(small.feature) > 0 and not np.array_equal(small.value, train(docs, labels).value)


def test_edges(spark, tables):
    docs, labels = tables
    model = train(docs, labels)
    schema = "doc_id long, text string, label int, held_out string, score string"
    assert quality_scores(spark.createDataFrame([], schema), model).collect() == []
    rows = [(1, None, 1, "x", "y"), (1, "", 1, "x", "y"), (None, "z", 0, None, None)]
    frame = spark.createDataFrame(rows, schema)
    got = quality_scores(frame, model).collect()
    assert len(got) == 3 and got[0].score == got[1].score and not got[2].held_out
    kept = keep_good(frame, model, keep_from=0.0)
    assert kept.columns == frame.columns and kept.count() == 3
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert train(docs, none).score(matrix([b"a"])).tolist() == [0.5]
    odd = spark.createDataFrame([(None, 1), (3, None), (3, 0), (3, 1), (10**12, 1)], "doc_id long, quality int")
    assert np.isfinite(train(docs.union(docs), odd).score(matrix([b"a b"]))).all()


def gains(rows, labels, f, threshold, ridge=1.0):
    """Gain of a split of all rows, by the second-order formula with its limits, from gradients at the constant score."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    g, h = labels - share, np.full(len(labels), share * (1 - share))
    right = rows[:, f] > threshold
    if h[right].sum() < 1 or h[~right].sum() < 1:
        return 0.0
    parts = [g[side].sum() ** 2 / (h[side].sum() + ridge) for side in (right, ~right)]
    return sum(parts) - g.sum() ** 2 / (h.sum() + ridge)


@pytest.mark.parametrize("seed", range(12))
def test_first_split_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 9, (60, 4)).astype(float)
    labels = (rows[:, seed % 4] + rng.normal(0, 3, 60) > 4).astype(float)
    model = fit(rows, labels, trees=1, depth=1, bins=64)
    best = max(gains(rows, labels, f, t) for f in range(4) for t in np.unique(rows[:, f]))
    own = gains(rows, labels, int(model.feature[0, 0]), float(model.threshold[0, 0]))
    assert own == pytest.approx(best) and best > 0
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    right = rows[:, model.feature[0, 0]] > model.threshold[0, 0]
    for leaf, side in enumerate((~right, right)):
        want = 0.15 * (labels[side] - share).sum() / (side.sum() * share * (1 - share) + 1)
        assert model.value[0, leaf] == pytest.approx(want)
