"""Each stage on the smallest tables against a plain version of it, and the whole run."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeloom.llm.packing import VOCABULARY
from lakeloom.llm.quality import matrix, train
from lakeloom.session import materialize
from tests.llm.test_exact_dedup import plain as plain_exact
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_fingerprint, plain_roots

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF_DIR), "step"))
    return [[tuple(r) for r in f.collect()] if n < 5 else f.collect() for n, f in enumerate(frames)]


def plain_mix(docs):
    """Copies by id: prefix sums within each source."""
    rows = defaultdict(list)
    for key, text, _, source, _ in docs:
        rows[source].append((sum(1 for _ in (text or "").encode().split()), key))
    names = sorted(rows, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for n, _ in rows[s]) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    level, whole = 0.0, 1.5 * sum(sizes.values())
    for _ in names:
        full = [s for s in names if weight[s] * level > 2 * sizes[s]]
        open_ = sum(weight[s] for s in names if s not in full)
        level = (whole - sum(2 * sizes[s] for s in full)) / open_ if open_ else level
    copies, taken, target = {}, Counter(), {}
    for s in names:
        target[s] = min(weight[s] * level, 2.0 * sizes[s])
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        key = "" if s is None else "=" + s
        u = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:8], 16) / 2**32
        for i, (size, doc) in enumerate(sorted(rows[s]), 1):
            copies[doc] = math.floor(i * rate + u) - math.floor((i - 1) * rate + u)
            taken[s] += copies[doc] * size
    return copies, taken, target, {s: max(n for n, _ in rows[s]) for s in names}


def test_quality(spark, steps):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    want = [d for d in steps[0] if model.score(matrix([(d[1] or "").encode()]))[0] >= 0.7]
    assert sorted(steps[1]) == sorted(want) and 0 < len(want) < len(steps[0])


def test_exact(steps):
    kept = {i for i, _, _, keep, _ in plain_exact([d[:2] for d in steps[1]]) if keep}
    assert sorted(steps[2]) == sorted(d for d in steps[1] if d[0] in kept)


def test_near(steps):
    docs = sorted(steps[2])
    roots = plain_roots([plain_fingerprint(d[1]) for d in docs])
    assert sorted(steps[3]) == [d for n, d in enumerate(docs) if roots[n] == n]


def test_mix(steps):
    copies, taken, target, longest = plain_mix(steps[3])
    assert Counter(steps[4]) == Counter({d: copies[d[0]] for d in steps[3] if copies[d[0]]})
    assert all(abs(taken[s] - target[s]) <= 2 * longest[s] for s in target)


def test_pack(steps):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    used = check([d[:2] for d in steps[4]], steps[5], tokenizer, 2048)
    assert used <= 1.05 * sum(r.length for r in steps[5]) / 2048 + 2


def test_whole_run_and_columns(spark, steps):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name
    found = corpus_pipeline.run(spark, SF_DIR).drop("sequence_id", "offset").collect()
    assert Counter(found) == Counter(r for r in [tuple(r)[:5] for r in steps[5]])


def test_odd_and_empty_documents(spark):
    """NULLs in every column, empty and repeated rows, extra columns; and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, length int, hash string, fp long"
    good = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").first().text
    rows = [
        (None, None, None, None, None, None, None, None), (1, "", "en", None, 0, 1, "h", 2), (2, good, None, "s", 1, 1, "h", 2),
        (2, good, None, "s", 1, 1, "h", 2), (3, good + " ", "x", "s", 1, 1, "h", 2), (None, good, "x", None, 1, 1, "h", 2),
    ]
    for kept in (rows, []):
        docs = spark.createDataFrame(kept, schema)
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_DIR)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert found.columns == docs.columns, name
            result = found.collect()
            assert bool(result) == bool(kept) or name == "mix sources", name
