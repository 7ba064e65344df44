"""The trie of conversations against dictionaries of whole prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakeloom.llm import prefix_trie as module
from lakeloom.llm.prefix_trie import Full, Indexed, Node, Sorted, prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, n long, `key.x` string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{len(text or '')}:{text or ''}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest[:32], (role or "", text or "")))
    own = {conv: [t[3] for t in sorted(turns)] for conv, turns in own.items()}
    nodes = defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        giver = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        whole = tuple(own.get(giver, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append((conv, d == len(whole)))
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + (len(nodes[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(nodes[n])[0], len(n), min(nodes[n[:-1]])[0] if n else None, len(nodes[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c, end in sorted(nodes[n]) if end).encode()).hexdigest(),
        )
        for n in nodes
    )


def check(spark, rows, parts=3, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    assert sorted(tuple(r) for r in prefix_trie(frame, **options).collect()) == plain(rows)


def conversations(rng, n, texts, turns):
    rows = []
    for _ in range(n):
        conv = rng.choice([rng.randrange(400), rng.randrange(-300, 0), 10**12 + rng.randrange(150)])
        rows += [(conv, t, rng.choice(["user", "bot"]) if t % 2 else "user", rng.choice(texts)) for t in range(rng.randrange(turns))]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = conversations(rng, 120, ["a", "b", "", "ü" * 5], 9)
    check(spark, rows, turns=rng.choice([1, 10, 60]))  # several rounds of trees


def test_hot_first_turn_and_conversation(spark):
    rng = random.Random(9)
    rows = [(c, t, "user", "hello" if t < 2 else f"x{c % 7}{t}") for c in range(400) for t in range(rng.choice([2, 3, 4]))]
    rows += [(1000 + c, t, "bot", "same") for c in range(300) for t in range(8)]
    check(spark, rows, turns=40)
    check(spark, rows)


def test_nulls_ties_repeats_and_long(spark):
    rows = [(None, 1, "user", "lost"), (5, None, "user", "first"), (5, 1, None, None), (5, 1, "user", "tie"), (5, 1, "user", "tie")]
    rows += [(0, t, "user", f"t{t}") for t in range(3)] + [(100, 0, "u", "x" * 300_000)] + [(7, t, "u", "z") for t in range(2000)]
    rows += [(n, 0, "user", "t0") for n in range(1, 100)]  # without turns, where h takes the only one
    rows += [(n, 0, "user", "") for n in range(201, 240)]  # the giver is absent
    check(spark, rows)
    check(spark, rows, turns=1)


def test_empty_and_single(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(0, 0, "user", "a")], parts=1)


def test_ends_over_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 12)
    check(spark, [(c, t, "bot", "same") for c in range(0, 30_000, 100) for t in range(3)])


def test_layouts_grow_and_paths_are_compressed():
    rng = random.Random(1)
    keys = sorted({bytes([b]) * 16 + rng.randbytes(16 * rng.randrange(3)) for b in range(256) for _ in range(rng.choice([1, 60]))})
    root, order = Node(), keys[:]
    rng.shuffle(order)
    kinds = set()
    for n, key in enumerate(order):
        root.insert(key, key)
        kinds.add((type(root.children), getattr(root.children, "room", 0)))
    assert kinds == {(Sorted, 4), (Sorted, 16), (Indexed, 0), (Full, 0)}
    met = []

    def walk(node, way):
        met.extend(node.entries)
        assert all(e == way for e in node.entries)
        below = list(node.children.in_order()) if node.children else []
        assert not way or node.entries or len(below) > 1  # no node without need
        for child in below:
            walk(child, way + child.path)

    walk(root, b"")
    assert met == keys
