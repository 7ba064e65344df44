import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeloom.llm.packing import VOCABULARY, ByteBpe, pack, slots, solve


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def check(rows, found, tokenizer, capacity):
    want = defaultdict(list)
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            want[doc].append((n, a, b - a, crc))
    got, packed = defaultdict(list), defaultdict(list)
    for r in found:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        packed[r.sequence_id].append((r.offset, r.length))
    assert {d: sorted(p) for d, p in got.items()} == {d: sorted(p) for d, p in want.items()}
    for items in packed.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(packed)


def test_documents(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, "<|endoftext|> x"), (-4, "a" * 9000), (-5, " \n" * 4000), (-1, None)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, length int, part string")
    for capacity in (2048, 64):
        found = pack(docs.repartition(5), capacity=capacity).collect()
        used = check(rows, found, tokenizer, capacity)
        assert used <= 1.03 * sum(r.length for r in found) / capacity + 2


def test_ids_equal_on_all_code_points(tokenizer):
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)} ." for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    step = texts[::11] + texts[:3000]
    own = ByteBpe(VOCABULARY)
    assert [e.ids for e in tokenizer.encode_batch(step, add_special_tokens=False)] == [own.ids(t).tolist() for t in step]


LONG = 3_000_000


@pytest.mark.parametrize(
    "text",
    [" " * LONG, "\n" * LONG, "\t" * LONG + "word", "a" + " \n\u3000" * (LONG // 3) + " b <|endoftext|> c", "x" * LONG],
    ids=["spaces", "line ends", "tabs and a word", "mixed", "letters"],
)
def test_long_runs(tokenizer, text):
    assert ByteBpe(VOCABULARY).ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_plain_text(tokenizer):
    other = Tokenizer.from_file(VOCABULARY)
    other.encode_special_tokens = True
    plain = ByteBpe(VOCABULARY, added=False)
    known = plain.token_bytes()
    for text in ("<|endoftext|> x", " <|endoftext|><|endoftext|>", "x" + " " * 150_000 + "<|endoftext|>"):
        assert plain.ids(text).tolist() == other.encode(text, add_special_tokens=False).ids
        assert b"".join(known[i] for i in plain.ids(text)).decode() == text
        assert ByteBpe(VOCABULARY).ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_white_space_packs(spark, tokenizer):
    rows = [(1, " " * 1_500_000), (2, "a b"), (3, "a" + "\n" * 1_200_000 + "b")]
    assert check(rows, pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), tokenizer, 2048)


@pytest.mark.parametrize("seed", range(6))
def test_solver(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 300])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.choice([1, 30, 60]))]
    counts = {length: rng.choice([1, 5, 1000]) for length in lengths}
    packing = solve(counts, capacity)
    held = defaultdict(int)
    for config, times in packing.used:
        assert times > 0 and sum(config) <= capacity
        for length in config:
            held[length] += times
    assert dict(held) == counts
    assert packing.lower_bound <= packing.sequences <= 1.025 * packing.lower_bound + 3
    table = slots(packing)
    assert (np.diff(table["length"]) >= 0).all()


def test_solver_finds_matching_pairs():
    assert solve({6: 500, 4: 500, 7: 300, 3: 300, 5: 200}, 10).sequences == 900


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


ADDED = [
    "<|endoftext|> x", "a <|endoftext|>", "<|endoftext|>", "<|endoftext|><|endoftext|>", " \n<|endoftext|>  \n b  <|endoftext|>\t",
    "it'<|endoftext|>s 12<|endoftext|>3", "<|endoftext|", "<|<|endoftext|>|>", "<|ENDOFTEXT|>", "é<|endoftext|>日本 " * 90,
]


def test_added_tokens_have_their_ids(spark):
    unmodified = Tokenizer.from_file(VOCABULARY)
    assert unmodified.encode("<|endoftext|> x", add_special_tokens=False).ids == [50256, 2124]
    rows = list(enumerate(ADDED))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for capacity in (2048, 64):
        check(rows, pack(docs, capacity=capacity).collect(), unmodified, capacity)


def test_ids_equal_those_of_the_unmodified_file():
    unmodified, own = Tokenizer.from_file(VOCABULARY), ByteBpe(VOCABULARY)
    texts = ADDED + [unmodified.decode([n]) for n in range(50257)]
    rng = random.Random(3)
    texts += [unmodified.decode([rng.randrange(50257) for _ in range(60)]) for _ in range(3000)]
    want = [e.ids for e in unmodified.encode_batch(texts, add_special_tokens=False)]
    assert [own.ids(text).tolist() for text in texts] == want


def optimum(pieces, capacity):
    """The least number of sequences, by exhaustive search over small inputs."""
    best = len(pieces)

    def place(left, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not left:
            best = len(rooms)
            return
        for at in range(len(rooms)):
            if rooms[at] >= left[0] and rooms[at] not in rooms[:at]:
                place(left[1:], rooms[:at] + [rooms[at] - left[0]] + rooms[at + 1 :])
        place(left[1:], rooms + [capacity - left[0]])

    place(sorted(pieces, reverse=True), [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_solver_against_exhaustive_search(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 20])
    pieces = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))]
    packing = solve({n: pieces.count(n) for n in pieces}, capacity)
    least = optimum(pieces, capacity)
    assert packing.lower_bound <= least <= packing.sequences <= least + 1
