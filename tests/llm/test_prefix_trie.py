import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ebbline.llm import prefix_trie
from tests.llm import edge

SCHEMA = "conv_id long, turn long, role string, text string"


def truncated(c):
    return c - (abs(c) % 5) * (1 if c >= 0 else -1)


def plain_nodes(rows):
    """Every node from the lists of all rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(truncated(c), [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = Counter()
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        out[min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def found(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def random_rows(seed, n=160, texts=3, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, n * 2), n):
        length = rng.choice([1, 2, 3, longest])
        rows += [(c, None if rng.random() < 0.02 else t, rng.choice(["user", "assistant"]) if t % 7 == 3 else "user", rng.choice(["", "é☃", "text "][:texts]) * (t % 3 + 1))
                 for t in range(length)]
    rng.shuffle(rows)
    return [r for i, r in enumerate(rows) if r[1] is not None or i % 50 == 0]


@pytest.mark.parametrize("options", [{}, {"range_turns": 40}, {"range_turns": 40, "shard_turns": 3}, {"shard_turns": 1}])
def test_against_all_lists(spark, options):
    for seed in (1, 2):
        rows = random_rows(seed)
        assert found(prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA), **options)) == plain_nodes(rows)


def test_given_table(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conversations.collect()]
    assert found(prefix_trie.nodes(conversations, range_turns=10, shard_turns=4)) == plain_nodes(rows)


def test_one_conversation_many_times_and_a_deep_one(spark, monkeypatch):
    """A third of all conversations is alike, over many ranges, and ids go through pieces."""
    rows = [(5 * c + 4, t, "user", f"hello {t}") for c in range(400) for t in range(9)]
    rows += [(5 * c + 3, t, "user", f"hello {t}" if t < c % 9 else f"{c} {t}") for c in range(400) for t in range(9)]
    rows += [(9_999, t, "user", f"deep {t}") for t in range(3_000)]
    table = spark.createDataFrame(rows, SCHEMA)
    want = plain_nodes_of_deep(rows)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    for options in ({"range_turns": 300}, {"range_turns": 300, "shard_turns": 50}, {}):
        assert found(prefix_trie.nodes(table, **options)) == want


def plain_nodes_of_deep(rows):
    """As ``plain_nodes``, with one long conversation of its own cut to its first ten turns; those behind have one member."""
    short = [r for r in rows if r[0] != 9_999 or r[1] < 10]
    out = plain_nodes(short)
    none, end = hashlib.sha256().hexdigest(), hashlib.sha256(b"9999").hexdigest()
    (last,) = [k for k in out if k[0] == 9_999 and k[7] == end]
    del out[last]
    first, deepest = last[1], last[1] + 2_990
    for depth in range(first, deepest):
        out[9_999, depth, 9_999 if depth > 1 else last[2], 1, 1, 1, 0, none] += 1
    out[9_999, deepest, 9_999, 1, 0, 1, 0, end] += 1
    return out


def test_tree_finds_rows_by_their_numbers():
    rng = random.Random(3)
    rows = sorted({tuple(rng.randrange(4) for _ in range(rng.randrange(6))) for _ in range(300)})
    tree = prefix_trie.TernaryTree()
    paths = tree.insert_all([list(r) for r in rows])
    prefixes = {r[:d] for r in rows for d in range(len(r) + 1)}
    assert len(tree.key) == len(prefixes)
    for row, path in zip(rows, paths):
        assert [tree.key[a] for a in path[1:]] == list(row) and path == tree.insert(list(row))
        assert [tree.up[a] for a in path] == [-1, *path[:-1]]


def test_median_insertion_balances_siblings():
    tree = prefix_trie.TernaryTree()
    tree.insert_all([[i] for i in range(1023)])
    deepest, level = 0, [tree.next[0]]
    while level:
        deepest += 1
        level = [at for node in level for at in (tree.low[node], tree.high[node]) if at >= 0]
    assert deepest == 10


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 0, "user", "no conversation"), (6, 0, None, edge.LONG),
            (6, 1, "assistant", edge.LONG), (7, 3, "user", "x"), (0, 5, "a", "b"), (-3, 1, "user", "neg"), (10, 0, "aa", "b"), (11, 0, "a", "ab")]
    want = plain_nodes(rows)
    names = [c for c in edge.CLASHING if c not in ("conv_id", "turn", "role", "text")]
    table = spark.createDataFrame(rows, SCHEMA)
    for df in (table, table.selectExpr("*", *[f"7 as {c}" for c in names], "8 as seq", "9 as cell", "1 as family", "2 as own", "3 as h", "4 as base")):
        assert found(prefix_trie.nodes(df)) == want
    assert prefix_trie.nodes(spark.createDataFrame([], SCHEMA)).count() == 0
