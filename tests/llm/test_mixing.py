import math
from collections import Counter

from pyspark.sql import functions as F

from ebbline.llm import mixing
from tests.llm import edge


def test_cumulative_probabilities(spark):
    for rate in (0.01, 1.0, 7.5, 900.0):
        (sums,) = spark.range(1).select(mixing.cumulative(F.lit(rate)).alias("s")).first()
        total = 0.0
        for k, found in enumerate(sums):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert abs(found - total) < 1e-9
        assert abs(sums[-1] - 1) < 1e-9


def test_sources_come_near_their_weights(spark):
    text = F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "mid").otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), source.alias("source"), text.alias("text"))
    weights = {"hot": 1.0, "mid": 3.0, "nowhere": 5.0}
    rows = mixing.mix(docs, weights).collect()
    size = Counter()
    for r in rows:
        size[r.source] += len(r.text) + 1
    assert set(size) == {"hot", "mid"}
    assert abs(size["mid"] / size["hot"] - 3) < 0.15
    counts = Counter((r.doc_id, r.n_copies) for r in rows)
    assert all(n == c for (_, n), c in counts.items())
    keys = [r.shuffle_key for r in mixing.mix(docs, weights).collect()]
    assert sorted(keys) == sorted(r.shuffle_key for r in rows)
    assert len(set(keys)) == len(keys)


def test_rows_without_an_id_are_spread_and_draw_by_their_text(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread_and_drawn(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def spread_and_drawn(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("text "), F.col("id") % 9_000).alias("text"))
    mixed = mixing.mix(docs)
    parts = [r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) >= 4 and max(parts) < 2 * sum(parts) / len(parts)
    rows = mixed.collect()
    keys = {r.shuffle_key for r in rows}
    assert len(keys) == len(rows) and 0.95 < len(rows) / 20_000 < 1.05
    copies = {}
    for r in rows:
        assert copies.setdefault(r.text, r.n_copies) == r.n_copies
    assert len(set(copies.values())) > 2
    one_id = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.lit("s").alias("source"), F.col("id").cast("string").alias("text"))
    parts = [r["count"] for r in mixing.mix(one_id, epochs=3.0).groupBy(F.spark_partition_id()).count().collect()]
    assert not parts or len(parts) >= 4


def test_edge_rows(spark):
    found = mixing.mix(edge.clashing(spark), epochs=4.0)
    assert len(set(found.columns)) == len(found.columns)
    rows = found.collect()
    drawn = Counter(r.doc_id for r in rows)
    assert drawn[1] % 2 == 0  # both rows of this id draw the same count
    assert {r.source for r in rows} <= {"a", "b", "hot", None}
    assert mixing.mix(edge.empty(spark)).count() == 0
    assert mixing.mix(edge.docs(spark), {}).count() == 0
    assert mixing.mix(edge.docs(spark), {"none of these": 1.0}).count() == 0
