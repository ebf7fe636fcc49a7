"""Dense numbering of distinct keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HEX_DIGITS = 3  # 4,096 hash buckets


def key_hash(keys: list[str], salt: object = "") -> Column:
    """A uniform, engine-independent hash of a key: ``md5('<salt>|<k1>|<k2>...')``."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(salt)), *parts))


def hash_positions(df: DataFrame, keys: list[str], salt: object = "") -> DataFrame:
    """Add ``_position`` (1..n in hash order, gap-free) and ``_total`` (n).

    The keys must be unique. A hash prefix cuts the rows into 4,096 even buckets;
    each is ranked by itself and shifted by the sizes of the buckets before it. The
    only unpartitioned window runs over those at most 4,096 sizes, which is also
    what bounds the broadcast. The join is a left one on unique keys, so Catalyst
    drops it, and the ranking, from a query that does not read the position.
    """
    hashed = df.withColumn("_hash", key_hash(keys, salt)).withColumn("_bucket", F.substring("_hash", 1, _HEX_DIGITS))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket", "left")
        .withColumn("_position", F.col("_before") + F.col("_rank"))
        .drop("_hash", "_bucket", "_rank", "_before")
    )


def assign_keys(df: DataFrame, keys: list[str], name: str, existing: DataFrame | None = None) -> DataFrame:
    """Give each row a new surrogate key after the greatest one in use."""
    numbered = hash_positions(df, keys)
    start = F.lit(0).cast("long")
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("m")).scalar()
    return numbered.withColumn(name, start + F.col("_position")).drop("_position", "_total")
