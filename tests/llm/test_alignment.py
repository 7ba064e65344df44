"""Alignment of tokenizers against a plain walk over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from lakeloom.llm import alignment
from lakeloom.llm.alignment import BYTE_BPE, PIECES, Csr, SecondTokenizer, align_tokens


def byte_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    table = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    assert set(table) == set(ByteLevel.alphabet())
    return table


@pytest.fixture(scope="module")
def plain():
    """Rows of the contract by loops over bytes and pairs."""
    one = Tokenizer.from_file(BYTE_BPE)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = byte_of()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(table[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in two.encode(text):
            piece = two.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if want == b"".join(t for _, t in a) == b"".join(t for _, t in b) else ([], [])

    def rows(docs):
        found, holders = [], Counter()
        for key, text in docs:
            a, b = tokens(text)
            by_byte = [[n for n, (_, t) in enumerate(side) for _ in t] for side in (a, b)]
            links = sorted(set(zip(*by_byte)))
            groups, ends = [([], [])], []
            for at in range(len(by_byte[0])):
                for side, own in ((0, a), (1, b)):
                    if at + 1 == len(by_byte[0]) or by_byte[side][at + 1] != by_byte[side][at]:
                        groups[-1][side].append(own[by_byte[side][at]][0])
                        ends.append(side)
                if ends[-2:] == [0, 1] and at + 1 < len(by_byte[0]):
                    groups.append(([], []))
                ends = []
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups) if a else ""
            digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
            ids = [(a[i][0], b[j][0]) for i, j in links]
            holders.update(set(ids))
            together = sum(len(x) * len(y) for x, y in groups)
            found.append((key, len(a), len(b), len(groups) if a else 0, len(links), together, ids, digest))
        top = Counter()
        for (a, _), n in holders.items():
            top[a] = max(top[a], n)
        return [
            (*r[:6], sum(holders[p] == top[p[0]] for p in r[6]), sum(holders[p] for p in r[6]), r[7]) for r in found
        ]

    return rows


ODD = [
    None, "", " ", "  ", "\n", "a", "it's 1234567 o'clock", "日本語のテキスト🙂🙂🏽", "<|endoftext|> <s> </s> <0x41> <unk>",
    "a ▁ b", "tab\tand\r\nends   　", "ﬁ ﬀ é é", "x" * 300, " " * 300, "\x00\x01", "1 + 1 = 2; y != z",
]


def key(row):
    return [(v is not None, v) for v in row]


def check(spark, docs, plain, **options):
    frame = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, row long, `n.a` string")
    got = align_tokens(frame.repartition(3), **options).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain(docs), key=key)


def test_odd_texts(spark, plain):
    rng = random.Random(5)
    pieces = ["the ", "einung", " é", "\n\n", "  ", "日本", "🙂", "\t", "2024", "don't", "<|endoftext|>", ".", "a", "́"]
    docs = [*enumerate(ODD), (3, "a"), (None, "the the"), (None, None)]
    docs += [(100 + n, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for n in range(150)]
    check(spark, docs, plain)
    check(spark, docs, plain, held=7)  # nearly all links are joined


def test_documents(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, docs, plain, held=500)
    check(spark, docs, plain)


def test_empty(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_product(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(alignment, "ROWS", 7)
    left, right = rng.random((20, 15)) < 0.2, rng.random((15, 12)) < 0.3

    def csr(dense):
        return Csr(np.r_[0, np.cumsum(dense.sum(axis=1))], np.nonzero(dense)[1], dense.shape[1])

    got = np.zeros((20, 12), dtype=int)
    for i, j, n in csr(left).times(csr(right)):
        got[i, j] = n
    assert (got == left.astype(int) @ right.astype(int)).all()
    assert csr(left).entries_of_product(csr(right)) == got.sum()
    back = csr(left).transposed()
    assert (back.columns == np.nonzero(left.T)[1]).all() and back.width == 20


@pytest.mark.parametrize("seed", range(5))
def test_product_takes_parts_instead_of_bytes(seed):
    rng = np.random.default_rng(seed)
    ends = [np.unique(np.append(rng.integers(1, 5000, 40), 5000)) for _ in "ab"]
    a_sizes, b_sizes = (np.diff(own, prepend=0) for own in ends)
    both = alignment.Alignment.of(np.arange(len(a_sizes)), np.arange(len(b_sizes)), a_sizes, b_sizes)
    assert both.a_parts.width == both.b_parts.width == len(np.union1d(*ends))  # and not 5000
    got = [(i, j) for x, y, n in both.overlaps() for i, j, k in zip(x, y, n) if k == 1]
    by_byte = zip(*(np.repeat(np.arange(len(s)), s) for s in (a_sizes, b_sizes)))
    assert got == sorted(set(by_byte))
    assert both.a_groups.width == len(np.intersect1d(*ends))


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(2)
    two = SecondTokenizer(PIECES)
    for n in range(40):
        text = "".join(rng.choice(["the", " ", "  ", "é", "日", "\n", "abc", " x"]) for _ in range(200))
        monkeypatch.setattr(alignment, "STRETCH", rng.choice([1, 5, 50]))
        assert two.ids(text).tolist() == two.pieces.encode(text)


def test_long_text(spark, plain):
    text = "A word, ein Wort. " * 30_000 + " " * 5000 + "z" * 5000
    [row] = align_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.n_a > 100_000 and row.count_sum == row.n_links  # a single document holds every link
