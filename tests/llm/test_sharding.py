from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ebbline.llm import sharding
from ebbline.llm.queries import QUERIES
from tests.llm import edge


def check(rows, shards):
    """Gapless slots, and the sizes of the shards."""
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_query(spark, sf_dir):
    rows = QUERIES["op6_sharding"](spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r["size"] == len(docs[r.doc_id].encode()) + 1 and r.law == "bytes" and r.grown_shard is None for r in rows)
    sizes = check(rows, 16)
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    again = {(r.doc_id, r.shard, r.slot) for r in QUERIES["op6_sharding"](spark, sf_dir).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("share", [0, 3])
def test_even_sizes_even_with_a_hot_text(spark, share):
    text = F.concat(F.lit("t"), F.md5(F.col("id").cast("string")))
    if share:
        text = F.when(F.col("id") % share == 0, F.lit("the same text in a third of the rows")).otherwise(text)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = sharding.shard(docs, 8).collect()
    sizes = check(rows, 8)
    assert len(rows) == 20_000 and max(sizes.values()) < 1.03 * min(sizes.values())


def test_small_groups_of_equal_texts_stay_together(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.md5((F.col("id") % 10_000).cast("string")).alias("text"))
    shards = defaultdict(set)
    for r in sharding.shard(docs, 4).collect():
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_edge_rows(spark):
    found = sharding.shard(edge.clashing(spark), 3)
    rows = found.collect()
    assert len(set(found.columns)) == len(found.columns) and len(rows) == len(edge.DOCS)
    check(rows, 3)
    assert {r["size"] for r in rows if r.text is None} == {1}
    assert sharding.shard(edge.empty(spark), 3).count() == 0


def test_files(spark, tmp_path):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    sharding.write_shards(sharding.shard(docs, 4), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().count() == 4


def test_ranges_grow_with_the_bytes():
    assert sharding.n_ranges(0, 16) == sharding.n_ranges(1 << 38, 16) == 16 * sharding.PER_SHARD
    assert sharding.n_ranges(1 << 40, 16) == 8192 and sharding.n_ranges(10**14, 16) == sharding.MAX_RANGES


def test_law_and_slots_by_brute_force(spark, sf_dir):
    """Sizes, shards near the due share, slots in order of the key within a shard, equal texts side by side."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.shard(docs, 4).collect()
    size = {r.doc_id: len((r.text or "").encode()) + 1 for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == size
    total, shards = sum(size.values()), {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for own in shards.values():
        own.sort(key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= 2 * max(size.values()) + 2 * total / (4 * sharding.PER_SHARD)
    in_order = [r.text or "" for s in sorted(shards) for r in shards[s]]
    seen, last = set(), None
    for text in in_order:
        assert text == last or text not in seen
        seen.add(text)
        last = text
