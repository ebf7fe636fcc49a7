"""Conversations as a trie of shared prefixes: members, leaves and what sharing saves, node by node.

Every turn becomes a cell of 24 bytes: the MD5 of role and text, and the text's length. Texts go no further. A conversation is
rebuilt as a row of cells: the first turns of its family's base, then its own. The rows are sorted by cells over ranges, so
conversations with a common prefix stand together, and each range works through its rows in order:

- *Shards.* Some ``SHARD_TURNS`` turns of different rows at a time are numbered by a dictionary of their cells and put into a ternary
  search tree, median first, so that siblings balance. A node's parent is always made before it, so going back over
  the nodes as they were made adds up members, children, leaves and savings without recursion.
- *Boundaries.* Only the nodes along a range's first row, and along the last row so far, can have members elsewhere. They
  stay open: the next shard starts from their sums, and at the range's end they are handed on as edges. Equal edges are
  summed by Spark, and one task adds up the tree of edges, at most two rows for each of ``MAX_RANGES`` ranges.
- *Parents.* A node closed under an open one doesn't know its parent's least member yet; it looks it up by join.
- *Ends.* Members that end at a node are hashed as they stream by. Where a range's first or last row may go on next door its ids
  are kept as pieces of text, and put together in order, so a conversation that a third of all others repeat is spread over
  ranges; the last hash over its ids is one stream by definition.

One conversation's cells are one value: they must fit a task's memory (24 MB for a million turns); all else is streamed.

Defined results: turns are ordered by turn, missing first, turns alike by their cell; role and text NULL count as empty;
rows without a conversation id are left out; repeated rows are turns of their own; ``%`` keeps the sign of a negative id;
a conversation without turns after rebuilding ends at the root; an empty table has no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import stored

CELL = 24
FAMILY = 5
HEADS = 9
RANGE_TURNS = 16_384
MAX_RANGES = 2048
SHARD_TURNS = 131_072
PIECE_IDS = 65_536
NO_ENDS = hashlib.sha256().hexdigest()

# --- rows of cells -----------------------------------------------------------


def cells(conversations: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the rebuilt turns of each conversation as one value."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.filter(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % FAMILY).alias("family"), "turn", F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")).alias("cell")
    )
    in_order = F.sort_array(F.collect_list(F.struct(F.isnotnull("turn").alias("has_turn"), "turn", "cell")))
    # Dealt by family once: the grouping and the window find their rows together.
    own = turns.repartition("family").groupBy("family", "conv_id").agg(in_order.alias("turns")).select("family", "conv_id", F.col("turns.cell").alias("own"))
    base = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS - 1))).over(Window.partitionBy("family"))
    joined = own.withColumns({"base": F.coalesce(base, F.array().cast("array<string>")), "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS})
    rest = F.slice("own", F.col("h").cast("int") + 1, F.greatest(F.size("own") - F.col("h").cast("int"), F.lit(0)))
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(F.slice("base", F.lit(1), F.col("h").cast("int")), rest), "")).alias("seq"))


def split(seq: bytes) -> list[bytes]:
    return [seq[i : i + CELL] for i in range(0, len(seq), CELL)]


# --- tree --------------------------------------------------------------------


class TernaryTree:
    """Rows of numbers. Node 0 stands for the empty row; ``up`` is the node of the row without its last number."""

    def __init__(self):
        self.key, self.low, self.next, self.high, self.up = [-1], [-1], [-1], [-1], [-1]

    def insert(self, row: list[int]) -> list[int]:
        """The nodes along the row."""
        key, low, high, path = self.key, self.low, self.high, [0]
        for number in row:
            link, owner = self.next, path[-1]
            at = link[owner]
            while at >= 0 and key[at] != number:
                link, owner = (low, at) if number < key[at] else (high, at)
                at = link[owner]
            if at < 0:
                at = link[owner] = len(key)
                key.append(number)
                self.up.append(path[-1])
                low.append(-1)
                high.append(-1)
                self.next.append(-1)
            path.append(at)
        return path

    def insert_all(self, rows: list[list[int]]) -> list[list[int]]:
        """Paths of sorted rows, put in by their medians."""
        paths: list[list[int]] = [[]] * len(rows)
        spans = [(0, len(rows))]
        while spans:
            start, end = spans.pop()
            if start < end:
                middle = (start + end) // 2
                paths[middle] = self.insert(rows[middle])
                spans += [(middle + 1, end), (start, middle)]
        return paths


class Sums:
    """What a node has of members and of closed children."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "ends")

    def __init__(self):
        self.n, self.least, self.children, self.leaves, self.saved, self.ends = 0, None, 0, 0, 0, None

    def take(self, n: int, least: int | None, children: int, leaves: int, saved: int, ends: str | None = None) -> None:
        self.n += n
        if least is not None:
            self.least = least if self.least is None else min(self.least, least)
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ends = self.ends or ends

    def close(self, n_bytes: int) -> None:
        """Once all children are in."""
        self.leaves = self.leaves if self.children else 1
        self.saved += (self.n - 1) * n_bytes

    def child(self, other: Sums) -> None:
        self.take(other.n, other.least, 1, other.leaves, other.saved)


# --- ranges ------------------------------------------------------------------

_NAMES = ("kind", "node_id", "parent_id", "depth", "n_bytes", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_TYPES = (pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string())
_SCHEMA = ", ".join(f"{n} {'string' if t == pa.string() else 'binary' if t == pa.binary() else 'long'}" for n, t in zip(_NAMES, _TYPES))


def _batch(rows: list[tuple], names=_NAMES, types=_TYPES) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))


def node_ids(seq: bytes) -> list[bytes]:
    """Names of the nodes along a row, the root's first."""
    digest = hashlib.md5()
    out = [digest.digest()]
    for cell in split(seq):
        digest.update(cell)
        out.append(digest.digest())
    return out


class Run:
    """Conversations with equal rows, in order of id."""

    def __init__(self, seq: bytes, least: int):
        self.seq, self.least, self.n, self.digest, self.held = seq, least, 0, hashlib.sha256(), []

    def add(self, conv_id: int) -> None:
        self.digest.update(f",{conv_id}".encode() if self.n else str(conv_id).encode())
        self.n += 1
        self.held.append(conv_id)

    def piece(self) -> tuple:
        row = ("piece", node_ids(self.seq)[-1], None, None, None, self.held[0], *[None] * 5, ",".join(map(str, self.held)))
        self.held = []
        return row


class Range:
    """The rows of one range, in order: shards, then edges."""

    def __init__(self, shard_turns: int):
        self.shard_turns = shard_turns
        self.first: bytes | None = None
        self.last = b""
        self.open: list[tuple[bytes, dict[int, Sums]]] = []  # the first row and the last so far, with sums by depth

    def shard(self, runs: list[tuple[bytes, int, int, str | None]]) -> list[tuple]:
        """Rows of the nodes that ``runs`` (row, members, least, ends) close."""
        rows = {seq: split(seq) for seq, *_ in [*runs, *((seq,) for seq, _ in self.open)]}
        code = {cell: i for i, cell in enumerate(sorted(set().union(*rows.values())))}
        order = sorted(rows)
        tree = TernaryTree()
        paths = dict(zip(order, tree.insert_all([[code[c] for c in rows[seq]] for seq in order])))
        sums = [Sums() for _ in tree.key]
        lengths = [int.from_bytes(cell[16:]) for cell in sorted(code)]
        for seq, n, least, ends in runs:
            sums[paths[seq][-1]].take(n, least, 0, 0, 0, ends)
        named: dict[int, tuple[bytes, int]] = {}  # nodes that are or were open, with their names and depths
        for seq, known in self.open:
            ids = node_ids(seq)
            for depth, old in known.items():
                at = paths[seq][depth]
                sums[at].take(old.n, old.least, old.children, old.leaves, old.saved, old.ends)
                named[at] = (ids[depth], depth)
        self.last = runs[-1][0]
        kept: set[int] = set()
        self.open = []
        for seq in dict.fromkeys((self.first, self.last)):
            ids, known = node_ids(seq), {}
            for depth, at in enumerate(paths[seq]):
                named[at] = (ids[depth], depth)
                if at not in kept:
                    kept.add(at)
                    known[depth] = sums[at]
            self.open.append((seq, known))
        depths = [0] * len(sums)
        for at in range(1, len(sums)):
            depths[at] = depths[tree.up[at]] + 1
        for at in range(len(sums) - 1, 0, -1):
            if at not in kept:
                sums[at].close(lengths[tree.key[at]])
                sums[tree.up[at]].child(sums[at])
        out = []
        for at in range(1, len(sums)):
            if at not in kept:
                own, up = sums[at], tree.up[at]
                late = up in kept
                out.append(("node", named[at][0] if at in named else None, named[up][0] if late else None, depths[at], None, own.least,
                            None if late else sums[up].least, own.n, own.children, own.leaves, own.saved, own.ends or NO_ENDS))
        return out

    def edges(self) -> list[tuple]:
        out = []
        for seq, known in self.open:
            ids, row = node_ids(seq), split(seq)
            for depth, own in known.items():
                n_bytes = int.from_bytes(row[depth - 1][16:]) if depth else 0
                out.append(("edge", ids[depth], ids[depth - 1] if depth else None, depth, n_bytes, own.least, None, own.n, own.children, own.leaves, own.saved, own.ends))
        return out

    def work(self, rows: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple]]:
        run, held, turns, pieces = None, [], 0, []
        for conv_id, seq in rows:
            if run is None or seq != run.seq:
                if run is not None:
                    # The first row may have begun in the range before.
                    ends = run.digest.hexdigest()
                    if run.seq == self.first:
                        pieces.append(run.piece())
                        ends = None
                    held.append((run.seq, run.n, run.least, ends))
                    turns += len(run.seq) // CELL
                    if turns >= self.shard_turns:
                        yield self.shard(held) + pieces
                        held, turns, pieces = [], 0, []
                else:
                    self.first = seq
                run = Run(seq, conv_id)
            elif len(run.held) >= PIECE_IDS:
                yield [run.piece()]  # left unused where the row turns out to be whole
            run.add(conv_id)
        if run is not None:
            held.append((run.seq, run.n, run.least, None))  # may go on in the next range
            yield [*self.shard(held), *pieces, run.piece(), *self.edges()]


def _range(shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(batch.column("conv_id").to_pylist(), batch.column("seq").to_pylist()))
        for out in Range(shard_turns).work(rows):
            for at in range(0, len(out), 10_000):
                yield _batch(out[at : at + 10_000])

    return run


# --- boundaries --------------------------------------------------------------


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes over the pieces of each node, which come in order."""
    node, digest, out = None, None, []
    for batch in batches:
        for node_id, text in zip(batch.column("node_id").to_pylist(), batch.column("ends_sha256").to_pylist()):
            if node_id != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = node_id, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if len(out) >= 10_000:
            yield _batch(out, ("node_id", "whole"), (pa.binary(), pa.string()))
            out = []
    if node is not None:
        yield _batch([*out, (node, digest.hexdigest())], ("node_id", "whole"), (pa.binary(), pa.string()))


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges, deepest first, with what their children hand up."""
    sums: dict[bytes, Sums] = {}
    rows = []
    for batch in batches:
        for row in batch.to_pylist():
            own = sums.setdefault(row["node_id"], Sums())
            own.take(row["n_convs"], row["conv_id"], row["n_children"], row["n_leaves"], row["saved_tokens"], row["ends_sha256"])
            own.close(row["n_bytes"])
            if row["parent_id"] is not None:
                sums.setdefault(row["parent_id"], Sums()).child(own)
            rows.append((row["node_id"], row["parent_id"], row["depth"]))
    out = [
        ("node", i, None, depth, None, sums[i].least, None if p is None else sums[p].least, sums[i].n, sums[i].children, sums[i].leaves, sums[i].saved,
         sums[i].ends or NO_ENDS)
        for i, p, depth in rows
    ]
    for at in range(0, len(out), 10_000):
        yield _batch(out[at : at + 10_000])


def nodes(conversations: DataFrame, range_turns: int = RANGE_TURNS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of every node."""
    rows = stored(cells(conversations), "trie-rows")
    turns = rows.agg(F.sum(F.octet_length("seq"))).first()[0] or 0
    ranges = max(1, min(MAX_RANGES, -(-turns // CELL // range_turns)))
    dealt = rows.repartitionByRange(ranges, "seq", "conv_id").sortWithinPartitions("seq", "conv_id").select("conv_id", "seq")
    found = stored(dealt.mapInArrow(_range(shard_turns), _SCHEMA), "trie-found")

    pieces = found.filter("kind = 'piece'").select("node_id", "conv_id", "ends_sha256").repartition("node_id")
    whole = pieces.sortWithinPartitions("node_id", "conv_id").select("node_id", "ends_sha256").mapInArrow(_joined, "node_id binary, whole string")
    edges = found.filter("kind = 'edge'").groupBy("node_id").agg(
        F.max("parent_id").alias("parent_id"), F.max("depth").alias("depth"), F.max("n_bytes").alias("n_bytes"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"),
    )
    edges = edges.join(whole, "node_id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "whole"))
    edges = edges.repartition(1).sortWithinPartitions(F.desc("depth"))
    tree = stored(edges.mapInArrow(_tree, _SCHEMA), "trie-edges")

    closed = found.filter("kind = 'node'")
    once_open = tree.unionByName(closed.filter("node_id is not null")).select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("above"))
    late = closed.filter("parent_id is not null").join(once_open, "parent_id").withColumn("parent_conv_id", F.col("above"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return closed.filter("parent_id is null").select(*names).unionByName(late.select(*names)).unionByName(tree.select(*names))
