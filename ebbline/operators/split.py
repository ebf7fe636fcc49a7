"""Stable train/test assignment of whole entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.keys import hash_positions
from ebbline.params import MAX_IDS, SEED, TEST_SHARE


def group_split(rows: DataFrame, key: str = "app_id", share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """``(key, is_test)``: the first ``ceil(share * n)`` entities in seeded hash order."""
    entities = rows.select(key).dropna().distinct()
    placed = hash_positions(entities, [key], seed)
    cut = F.ceil(F.col("_total") * F.lit(share))
    return placed.select(key, (F.col("_position") <= cut).alias("is_test"))


def apply_split(rows: DataFrame, split: DataFrame, key: str = "app_id") -> DataFrame:
    """Add ``is_test``; entities that the saved split does not list are training rows."""
    return rows.join(split.select(key, "is_test"), key, "left").withColumn(
        "is_test", F.coalesce(F.col("is_test"), F.lit(False))
    )


def sample_ids(ids: DataFrame, limit: int = MAX_IDS, seed: int = SEED, key: str = "app_id") -> DataFrame:
    """The first ``limit`` ids in ascending order (0: all), in a seeded shuffled order."""
    chosen = ids.select(key).distinct()
    if limit > 0:
        chosen = chosen.orderBy(key).limit(limit)
    placed = hash_positions(chosen, [key], seed)
    return placed.select(key, F.col("_position").alias("position")).orderBy("position")
