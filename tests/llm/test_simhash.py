import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ebbline.llm import simhash
from ebbline.llm.queries import QUERIES
from tests.llm import edge


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, most=3):
    """{node: least node reachable}, by comparing all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def plain_groups(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    component = plain_components({f for _, f in prints})
    least = {}
    for i, f in prints:
        if i is not None:
            least[component[f]] = min(i, least.get(component[f], i))
    return sorted(((i, f"{f:016x}", least.get(component[f])) for i, f in prints), key=str)


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op9_simhash"](spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert found == plain_groups(rows)
    assert len({r[2] for r in found}) < len({r[0] for r in found})


def test_edge_rows(spark):
    for table in (edge.docs(spark), edge.clashing(spark)):
        found = simhash.near_duplicates(table).select("doc_id", simhash.hex_digits(F.col("fp")).alias("f"), "component_id")
        assert sorted((tuple(r) for r in found.collect()), key=str) == plain_groups([(d[0], d[1]) for d in edge.DOCS])
    assert simhash.near_duplicates(edge.empty(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    kept = simhash.deduplicate(edge.clashing(spark))
    assert kept.columns == edge.clashing(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 5, 7, 8, None]
    assert simhash.deduplicate(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [3, 1024])
def test_close_pairs_connect_whatever_the_chunk(spark, chunk):
    rng = random.Random(4)
    nodes = set()
    for _ in range(40):
        seed = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            nodes.add(seed)
            for _ in range(rng.randint(1, 4)):
                seed ^= 1 << rng.randrange(64)
    signed = {n: n - (1 << 64) if n >> 63 else n for n in nodes}
    table = spark.createDataFrame([(s, s) for s in signed.values()], "fp long, id long")
    found = {r["id"]: r["component"] for r in simhash.components(simhash.close_links(table, chunk=chunk)).collect()}
    groups = {}
    for n, least in plain_components(nodes).items():
        groups.setdefault(least, set()).add(signed[n])
    for group in groups.values():
        assert {found.get(n, n) for n in group} == {min(group)}


def test_a_long_chain_is_one_component(spark):
    links = spark.range(500).selectExpr("id as u", "id + 1 as v")
    assert {r["component"] for r in simhash.components(links).collect()} == {0}


def test_spanning_links_of_a_large_group():
    fps = np.array([1 << b for b in range(60)] + [0], np.uint64)  # a star around zero, and pairs two bits apart
    assert len(simhash.spanning_links(fps, np.arange(61), 1)) == 60
    assert len(simhash.spanning_links(fps[:-1], np.arange(60), 1)) == 0


def test_points_around_a_fingerprint():
    points = simhash.around(3)
    for choice, mask in enumerate(simhash._choices(3)):
        own = [(flip, visitor) for c, flip, visitor in points if c == choice]
        free = 64 - (mask & 2**64 - 1).bit_count()
        assert len(own) == len({f for f, _ in own}) == 1 + free + free * (free - 1) // 2 <= 562
        assert all((f & 2**64 - 1).bit_count() == (2 if visitor else (f != 0)) and f & mask == 0 for f, visitor in own)


def near_copies(n, spread, seed):
    """Fingerprints around one template, with up to ``spread`` bits changed within the upper half."""
    rng = random.Random(seed)
    template, found = rng.getrandbits(64), set()
    while len(found) < n:
        flips = rng.sample(range(33, 64), rng.randint(1, spread))
        found.add(template ^ sum(1 << b for b in flips))
    return sorted(found)


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def roots(spark, fps, **options):
    nodes = spark.createDataFrame([(signed(f), i) for i, f in enumerate(fps)], "fp long, id long")
    reached = {r.id: r.component for r in simhash.components(simhash.close_links(nodes, **options)).collect()}
    return [reached.get(i, i) for i in range(len(fps))]


def test_crowded_keys_link_by_points_as_all_pairs_do(spark):
    fps = near_copies(300, 9, 1) + near_copies(60, 3, 2) + near_copies(40, 12, 3)
    found = roots(spark, fps, dense=20)
    assert found == roots(spark, fps)
    links = simhash.spanning_links(np.array(fps, np.uint64), np.arange(len(fps)), 3)
    plain = list(range(len(fps)))
    for u, v in links:
        plain[v] = u
    assert found == plain and 20 < len(set(found)) < 300


def test_ten_thousand_near_copies_make_rows_in_proportion(spark):
    """Rows of a crowded key are a fixed number for each fingerprint; chunks would repeat each row for every chunk."""
    fps = near_copies(10_000, 6, 5)
    nodes = spark.createDataFrame([(signed(f), i) for i, f in enumerate(fps)], "fp long, id long")
    mask = simhash._choices(3)[0]
    key = {signed(f) & mask for f in fps}
    assert len(key) == 1  # one key holds all
    dense = nodes.select(F.lit(0).alias("choice"), F.lit(key.pop()).alias("block"), "fp", "id")
    links = simhash.point_links(dense, 3)
    found = links.collect()
    assert all((fps[r.u] ^ fps[r.v]).bit_count() <= 3 for r in found) and len(found) <= 562 * len(fps)
    reached = {r.id: r.component for r in simhash.components(links).collect()}
    chunked = roots(spark, fps)
    assert [reached.get(i, i) for i in range(len(fps))] == chunked and len(set(chunked)) < 9_000
