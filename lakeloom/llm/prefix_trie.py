"""Trie of the turns that conversations begin with, built from adaptive radix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches
from lakeloom.session import materialize

WIDTH = 16  # bytes of a turn's id
# Turns of the conversations that one tree takes, and how many conversations it takes at least.
TREE_TURNS, TREE_KEYS = 1 << 17, 8
# Bytes of decimal ids that are joined before they are hashed.
CHUNK = 1 << 16
NOBODY = (1 << 63) - 1  # above every id


class Sorted:
    """Children by byte, in order, for few of them."""

    def __init__(self, room: int, keys: bytes = b"", children: Iterable = ()) -> None:
        self.room, self.keys, self.children = room, bytearray(keys), list(children)

    def get(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return None if at < 0 else self.children[at]

    def put(self, byte: int, child: Node) -> Sorted | Indexed:
        at = self.keys.find(byte)
        if at >= 0:
            self.children[at] = child
            return self
        if len(self.keys) == self.room:
            grown = Sorted(16, self.keys, self.children) if self.room < 16 else Indexed(self.keys, self.children)
            return grown.put(byte, child)
        at = next((n for n, key in enumerate(self.keys) if key > byte), len(self.keys))
        self.keys.insert(at, byte)
        self.children.insert(at, child)
        return self

    def in_order(self) -> Iterator[Node]:
        return iter(self.children)


class Indexed:
    """Up to 48 children, found by a table of 256 places."""

    def __init__(self, keys: Iterable[int], children: Iterable) -> None:
        self.places, self.children = bytearray(256), []
        for byte, child in zip(keys, children):
            self.put(byte, child)

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.children[place - 1] if place else None

    def put(self, byte: int, child: Node) -> Indexed | Full:
        if self.places[byte]:
            self.children[self.places[byte] - 1] = child
        elif len(self.children) == 48:
            return Full((b, self.get(b)) for b in range(256)).put(byte, child)
        else:
            self.children.append(child)
            self.places[byte] = len(self.children)
        return self

    def in_order(self) -> Iterator[Node]:
        return (self.children[place - 1] for place in self.places if place)


class Full:
    """A child for every byte."""

    def __init__(self, pairs: Iterable[tuple[int, Node | None]]) -> None:
        self.children = [child for _, child in pairs]

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> Full:
        self.children[byte] = child
        return self

    def in_order(self) -> Iterator[Node]:
        return (child for child in self.children if child)


class Node:
    """A node of the radix tree: the bytes on the way to it, its children, and the entries whose key ends here."""

    __slots__ = ("path", "children", "entries")

    def __init__(self, path: bytes = b"", entry: object = None) -> None:
        self.path, self.children, self.entries = path, None, [] if entry is None else [entry]

    def add(self, child: Node) -> None:
        self.children = (self.children or Sorted(4)).put(child.path[0], child)

    def insert(self, key: bytes, entry: object) -> None:
        """Add an entry under its key; this node must be the root."""
        node, at = self, 0
        while at < len(key):
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                node.add(Node(key[at:], entry))
                return
            path = child.path
            if not key.startswith(path, at):
                same, most = 1, min(len(path), len(key) - at)
                while same < most:  # halve what is left, as paths may be long
                    half = (same + most + 1) // 2
                    same, most = (half, most) if key.startswith(path[:half], at) else (same, half - 1)
                fork = Node(path[:same])
                child.path = path[same:]
                fork.add(child)
                node.add(fork)
                child = fork
            node, at = child, at + len(child.path)
        node.entries.append(entry)


class Turn:
    """A node of the trie while its subtree is walked: what is known of it from the entries seen so far."""

    __slots__ = ("n", "low", "kids", "leaves", "saved", "ends", "first", "last", "name", "below")

    def __init__(self, first: bool, last: bool, name: xxhash.xxh3_128 | None) -> None:
        self.n, self.low, self.kids, self.leaves, self.saved, self.ends = 0, NOBODY, 0, 0, 0, None
        self.first, self.last, self.name, self.below = first, last, name, []

    def add(self, n: int, low: int, kids: int, leaves: int, saved: int) -> None:
        self.n += n
        self.low = min(self.low, low)
        self.kids += kids
        self.leaves += leaves
        self.saved += saved


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
ENTRY = (
    "key binary, sizes array<long>, start long, n array<long>, low array<long>, kids array<long>, leaves array<long>, "
    "saved array<long>, ends_at array<string>"
)
ROWS = f"kind int, tree long, name binary, parent binary, {NODES}, ends string, {ENTRY}"
NODE, RIM, CARRIED = 0, 1, 2


def tree_rows(entries: list[tuple], tree: int, whole: bool, named: bool) -> Iterator[tuple]:
    """Rows of ROWS for one stretch of sorted entries (those of ENTRY).

    An entry brings values for the trie nodes of its key from depth ``start`` on.  All values of a node meet in this
    tree, unless it lies on the way to the first or the last key, the rim, as neighbours may hold more of it.  What is
    known of the rim is carried on by two entries, except if the tree is ``whole``.  Nodes whose parent is in the rim
    get their parent by its name, a digest of its turns.  ``named``: all nodes give their names.
    """
    root = Node()
    for entry in entries:
        root.insert(entry[0], entry)
    first, last = entries[0], entries[-1]
    rims: tuple[list, list] = ([], [])
    way = bytearray()
    opened = [Turn(True, True, xxhash.xxh3_128())]
    now: tuple = ()

    def open_turns() -> None:
        for depth in range(len(opened), len(way) // WIDTH + 1):
            span = slice((depth - 1) * WIDTH, depth * WIDTH)
            above, own = opened[-1], bytes(way[span])
            on_first, on_last = above.first and first[0][span] == own, above.last and last[0][span] == own
            name = None
            if named or on_first or on_last:
                name = above.name.copy()
                name.update(own)
            opened.append(Turn(on_first, on_last, name))

    def meet(entry: tuple) -> None:
        start, values, ends = entry[2], entry[3:8], entry[8]
        for at, own in enumerate(zip(*values)):
            opened[start + at].add(*own)
            opened[start + at].ends = ends[at] or opened[start + at].ends

    def close_turns(down_to: int) -> Iterator[tuple]:
        nothing = (None,) * 9
        while len(opened) > down_to:
            turn, depth = opened.pop(), len(opened)
            name = turn.name.digest() if turn.name else None
            rim = not whole and (turn.first or turn.last)
            known = (None, None, name) if rim else (turn.low, None, None)
            for row in turn.below:
                yield (NODE, tree if rim else None, row[0], known[2], *row[1:3], known[0], *row[3:8], *nothing)
            if rim:
                yield (RIM, tree, name, None, *(None,) * 8, *nothing)
                rims[0 if turn.first else 1].append(turn)
                continue
            size = now[1][depth - 1] if depth else 0
            leaves, saved = turn.leaves if turn.kids else 1, turn.saved + (turn.n - 1) * size
            row = (name if named else None, turn.low, depth, turn.n, turn.kids, leaves, saved, turn.ends)
            if opened:
                opened[-1].below.append(row)
                opened[-1].add(turn.n, turn.low, 1, leaves, saved)
            else:
                yield (NODE, None, row[0], None, *row[1:3], None, *row[3:8], *nothing)

    for entry in root.entries:
        now = entry
        meet(entry)
    walk = [(root, root.children.in_order() if root.children else iter(()))]
    while walk:
        node, children = walk[-1]
        child = next(children, None)
        if child is None:
            walk.pop()
            del way[len(way) - len(node.path) :]
            yield from close_turns(len(way) // WIDTH + 1 if walk else 0)
            continue
        way += child.path
        open_turns()
        for entry in child.entries:
            now = entry
            meet(entry)
        walk.append((child, child.children.in_order() if child.children else iter(())))
    for turns, entry in zip(rims, (first, last)):
        if turns:
            turns.reverse()
            start = len(entry[0]) // WIDTH + 1 - len(turns)
            columns = zip(*((t.n, t.low, t.kids, t.leaves, t.saved, t.ends) for t in turns))
            yield (CARRIED, tree, None, None, *(None,) * 8, entry[0], entry[1], start, *map(list, columns))


def merged(entries: DataFrame, level: int, whole: bool, turns: int) -> DataFrame:
    """The rows of the trees over sorted entries, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [part.split()[0] for part in ROWS.split(", ")]
        task, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def columns(tree: int) -> Iterator[dict]:
            rows = list(tree_rows(held, tree, whole, level > 1))
            for at in range(0, len(rows), 1 << 14):
                yield dict(zip(names, map(list, zip(*rows[at : at + (1 << 14)]))))

        for batch in batches:
            for entry in zip(*(column.to_pylist() for column in batch.columns)):
                if size > turns and len(held) >= TREE_KEYS and not whole:
                    yield from columns(level << 58 | task << 30 | count)
                    count, held, size = count + 1, [], 0
                held.append(entry)
                size += len(entry[1]) + 1
        if held:
            yield from columns(level << 58 | task << 30 | count)

    names = [part.split()[0] for part in ENTRY.split(", ")]
    return materialize(map_batches(entries.select(*names), run, ROWS), "trees")


def trie_nodes(entries: DataFrame, turns: int) -> DataFrame:
    """Nodes (NODES and ends) of the trie over all entries, of which no two have one key.

    Entries are dealt by ranges of their keys, so that a first turn that many conversations share spreads over many
    tasks.  Every stretch of so many turns is a tree, which gives its inner nodes and hands on two entries for its rim;
    these are entries of the next round, a few for each tree of this one, until one tree takes them all.
    """
    found, level, before = [], 1, None
    dealt = entries.repartitionByRange("key").sortWithinPartitions("key")
    whole = False
    while True:
        found.append(merged(dealt, level, whole, turns))
        if whole:
            break
        carried = found[-1].where(F.col("kind") == CARRIED)
        n, size = carried.agg(F.count("*"), F.sum(F.size("sizes") + 1)).first()
        if not n:
            break
        whole = size <= turns or n == before or n <= 2
        # Enough keys for each part that the next round has fewer, however long they are.
        parts = 1 if whole else max(1, min(int(size // (4 * turns)) + 1, n // TREE_KEYS))
        dealt = carried.repartitionByRange(parts, "key") if parts > 1 else carried.coalesce(1)
        dealt, level, before = dealt.sortWithinPartitions("key"), level + 1, n
    columns = [part.split()[0] for part in NODES.split(", ")]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    nodes = rows.where(F.col("kind") == NODE)
    rim = rows.where(F.col("kind") == RIM).select("tree", F.col("name").alias("parent"))
    lows = nodes.where("name is not null").select(F.col("name").alias("parent"), F.col("conv_id").alias("above"))
    # The parent's id by tree and name: no tree has many rows that ask for it.
    lows = materialize(rim.join(materialize(lows, "lows"), "parent"), "parents")
    asked = nodes.where("parent is not null").select("tree", "parent", *columns, "ends").drop("parent_conv_id")
    asked = asked.join(lows, ["tree", "parent"]).withColumnRenamed("above", "parent_conv_id")
    return nodes.where("parent is null").select(*columns, "ends").unionByName(asked.select(*columns, "ends"))


def ends_digests(members: DataFrame) -> DataFrame:
    """(group, ends): SHA-256 of the ascending decimal ids of each group, joined by commas, for rows (group, conv_id).

    A digest needs its ids one after the other, however many a group has.  So they are sorted by ranges, joined to pieces
    in parallel, and only the pieces of a group are read in sequence, without being held.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        group, low, ids, size = None, None, [], 0
        for batch in batches:
            out: dict = {"group": [], "low": [], "ids": []}
            for own, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if own != group or size > CHUNK:
                    if ids:
                        for name, value in zip(out, (group, low, ",".join(ids))):
                            out[name].append(value)
                    group, low, ids, size = own, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield out
        if ids:
            yield {"group": [group], "low": [low], "ids": [",".join(ids)]}

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        group, digest = None, None
        for batch in batches:
            out: dict = {"group": [], "ends": []}
            for own, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != group:
                    if digest:
                        out["group"].append(group)
                        out["ends"].append(digest.hexdigest())
                    group, digest = own, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield out
        if digest:
            yield {"group": [group], "ends": [digest.hexdigest()]}

    rows = members.repartitionByRange("group", "conv_id").sortWithinPartitions("group", "conv_id")
    pieces = map_batches(rows.select("group", "conv_id"), join, "group binary, low long, ids string")
    pieces = materialize(pieces, "pieces").repartition("group").sortWithinPartitions("group", "low")
    return materialize(map_batches(pieces, hashed, "group binary, ends string"), "ends")


def _digest(*texts: Column) -> Column:
    """128 bits for a sequence of texts, which are told apart by the length of each."""
    parts = [part for text in texts for part in (F.length(text).cast("string"), F.lit(":"), text)]
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * WIDTH)


def prefix_trie(
    conversations: DataFrame,
    turns: int = TREE_TURNS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt from the first h turns of conversation c - c % 100, all if it has fewer and none if it is
    absent, and its own turns after its first h, where h is the CRC-32 of its decimal id modulo 6.  Each distinct
    sequence of first turns (role, text) is a node, the empty one the root; every conversation that begins with it is a
    member, one without turns too.  ``conv_id`` is the smallest member, and a subtree includes its top.  ``saved_tokens``
    adds, for every node of the subtree, the code points of its last text as often as it has members beyond the first.
    ``ends_sha256`` is the digest of the members that end there.

    Turns are ordered by number, NULL first; rows of one number by a digest of their role and text, and repeated rows are
    turns of their own.  A NULL role or text is empty.  Rows with a NULL conv_id belong to no conversation.  Other
    columns are ignored; an empty table gives no rows, not even the root.

    A turn is known by 128 bits of a SHA-256, a conversation by its turns' ids in a row.  Equal conversations are one
    entry with a number of members, combined before the shuffle.  Trees over ranges of such keys give the nodes; ``turns``
    bounds a tree.  The ids of a conversation, 16 bytes a turn, have to fit a task.
    """
    role, text = (F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in (role_col, text_col))
    conv = F.col(f"`{conv_col}`").cast("long")
    said = F.struct(F.col(f"`{turn_col}`").alias("turn"), _digest(role, text).alias("id"), F.length(text).alias("size"))
    rows = conversations.where(conv.isNotNull()).select(conv.alias("conv_id"), said.alias("t"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    own = materialize(own.select("conv_id", F.col("t.id").alias("own_ids"), F.col("t.size").alias("own_sizes")), "own")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    # No conversation gives more than the first five turns, to at most a hundred others.
    heads = own.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("giver"), F.slice("own_ids", 1, 5).alias("ids"), F.slice("own_sizes", 1, 5).alias("sizes")
    )
    rebuilt = own.withColumn("h", taken.cast("int")).withColumn("giver", F.expr("conv_id - conv_id % 100"))
    rebuilt = rebuilt.join(heads, "giver", "left")

    def turns_of(head: str, rest: str, kind: str) -> Column:
        none = F.array().cast(f"array<{kind}>")
        begun = F.when(F.col("h") > 0, F.slice(F.coalesce(F.col(head), none), F.lit(1), F.col("h"))).otherwise(none)
        return F.concat(begun, F.slice(F.col(rest), F.col("h") + 1, F.size(rest)))

    members = materialize(
        rebuilt.select(
            "conv_id",
            F.unhex(F.array_join(turns_of("ids", "own_ids", "string"), "")).alias("key"),
            turns_of("sizes", "own_sizes", "int").cast("array<long>").alias("sizes"),
        ).withColumn("group", F.unhex(F.md5("key"))),
        "members",
    )
    groups = members.groupBy("group", "key", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    ends = ends_digests(members.select("group", "conv_id"))
    # A conversation's entry speaks for its last node only.
    zero = F.array(F.lit(0).cast("long"))
    entries = materialize(groups, "groups").join(ends, "group").select(
        "key", "sizes", F.size("sizes").cast("long").alias("start"), F.array("n").alias("n"), F.array("low").alias("low"),
        zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"), F.array("ends").alias("ends_at"),
    )
    nodes = trie_nodes(materialize(entries, "entries"), turns)
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
