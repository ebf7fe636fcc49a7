"""Shards of near equal bytes by sampled splitters.

The key of a record is the hash of its text, then its id, so equal texts lie side by side. Keys are
sampled with chances in proportion to size; weighted quantiles of the sample cut the key
space into many more ranges than shards, only between different texts. Then the ranges are measured over
all records, and ranges that turned out overfull, by one text with many copies or by chance, are cut again,
by a second sample within them and now also between copies. Runs of ranges, measured exactly, make up the
shards: a shard's border is the range border nearest to its due share. So sizes differ by less than a range
or two, whatever the sample missed.

Slots are the rank within the range plus the sizes of the ranges before it, so no task sorts a whole shard.

A range has some ``RANGE_BYTES``, so their number grows with the data, from ``PER_SHARD`` for each shard up to ``MAX_RANGES`` in
all; the samples (``SAMPLES`` for each range) and the table of ranges, which is broadcast, are bounded by that. A task sorts
one range. Built of DataFrame functions only.

Defined results: text NULL counts as empty; size is the text's UTF-8 bytes plus 1; id NULL is least; rows
equal in text and id can't be told apart and are never cut, their slots are in any order; an empty
table gives no rows; of an input column named like an output column the output stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import stored, without

PER_SHARD = 128
RANGE_BYTES = 128 << 20
MAX_RANGES = 1 << 18
SAMPLES = 16
OVERFULL = 2.0
SEED = 6
ADDED = ("size", "shard", "slot")
_PREFIX = 14  # bits of the key's hash that find the few borders to compare with
_LEAST = -(1 << 63)


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``size`` and the key ``_shard_h, _shard_i``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    # Names of its own, so that no column of the input has one of them.
    return without(docs, *ADDED).withColumns({"size": size_of(F.col(text_col)), "_shard_h": F.xxhash64(text), "_shard_i": number})


def _sample(keys: DataFrame, mean_bytes: float, salt: int) -> DataFrame:
    """The key with ``weight``: a record of s bytes with chance ``s / mean_bytes``, at most 1; weight is bytes it stands for."""
    draw = F.shiftrightunsigned(F.xxhash64("_shard_h", "_shard_i", F.lit(salt)), 11).cast("double") / F.lit(float(1 << 53))
    chance = F.col("size") / F.lit(mean_bytes)
    return keys.filter(draw < chance).withColumn("weight", F.greatest(F.col("size").cast("double"), F.lit(mean_bytes)))


def _with_range(frame: DataFrame, borders: DataFrame) -> DataFrame:
    """Add ``_range``, the number of borders at or below the key.

    Borders are gathered under the first bits of their hash, so a row is compared with those of its own prefix only.
    """
    spark = frame.sparkSession
    prefix = F.shiftright("_shard_h", 64 - _PREFIX)
    half = 1 << (_PREFIX - 1)
    every = spark.range(-half, half, 1, 1).withColumnRenamed("id", "_shard_prefix")
    near = borders.groupBy(prefix.alias("_shard_prefix")).agg(F.collect_list(F.struct("_shard_h", "_shard_i")).alias("_shard_near"))
    before = Window.orderBy("_shard_prefix").rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast(near.schema["_shard_near"].dataType)
    found = every.join(near, "_shard_prefix", "left").withColumn("_shard_near", F.coalesce("_shard_near", none))
    found = found.withColumn("_shard_before", F.coalesce(F.sum(F.size("_shard_near")).over(before), F.lit(0)))
    key = F.struct("_shard_h", "_shard_i")
    at = F.col("_shard_before") + F.size(F.filter("_shard_near", lambda b: b <= key))
    # One row for each of the 16,384 prefixes, each border once.
    joined = frame.join(F.broadcast(found), prefix == F.col("_shard_prefix")).withColumn("_shard_range", at.cast("long"))
    return joined.drop("_shard_prefix", "_shard_near", "_shard_before")


def n_ranges(total: int, shards: int, per_shard: int = PER_SHARD) -> int:
    """How many ranges a table of so many bytes is cut into, before overfull ones are cut again."""
    return max(shards * per_shard, min(MAX_RANGES, -(-total // RANGE_BYTES)))


def layout(keys: DataFrame, shards: int, per_shard: int = PER_SHARD) -> tuple[DataFrame, DataFrame]:
    """The borders of the ranges as keys, and for each range its ``shard`` and first slot."""
    keys = keys.select("_shard_h", "_shard_i", "size")
    total = keys.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / n_ranges(total, shards, per_shard))
    ordered = Window.orderBy("_shard_h", "_shard_i")
    upto = F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    step = F.floor((upto - F.col("weight") / 2) / F.lit(share))
    drawn = _sample(keys, share / SAMPLES, SEED).withColumn("step", step)
    first = drawn.groupBy("step").agg(F.min("_shard_h").alias("_shard_h")).select("_shard_h").distinct().withColumn("_shard_i", F.lit(_LEAST))
    borders = stored(first, "borders")

    measured = _with_range(keys, borders)
    full = measured.groupBy("_shard_range").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > F.lit(OVERFULL * share))
    inside = measured.join(F.broadcast(full.select("_shard_range")), "_shard_range", "left_semi")
    inner = Window.partitionBy("_shard_range").orderBy("_shard_h", "_shard_i")
    upto = F.sum("weight").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    step = F.floor((upto - F.col("weight") / 2) / F.lit(share))
    again = _sample(inside, share / SAMPLES, SEED + 1).withColumn("step", step)
    more = again.filter("step > 0").groupBy("_shard_range", "step").agg(F.min(F.struct("_shard_h", "_shard_i")).alias("key")).select("key._shard_h", "key._shard_i")
    borders = stored(borders.unionByName(more).distinct(), "borders")

    ranges = _with_range(keys, borders).groupBy("_shard_range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    ranges = stored(ranges, "ranges")
    before = Window.orderBy("_shard_range").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(before), F.lit(0)) + F.col("bytes") / 2
    shard = F.least(F.floor(middle * F.lit(shards) / F.lit(max(1, total))), F.lit(shards - 1)).cast("int")
    placed = ranges.withColumn("shard", shard)
    earlier = Window.partitionBy("shard").orderBy("_shard_range").rowsBetween(Window.unboundedPreceding, -1)
    return borders, placed.select("_shard_range", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_shard_first"))


def place(frame: DataFrame, borders: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot`` to a frame with the key, by the layout made from the same rows."""
    rank = F.row_number().over(Window.partitionBy("_shard_range").orderBy("_shard_h", "_shard_i"))
    ranked = _with_range(frame, borders).withColumn("_shard_rank", rank)
    # One row for each range: bounded by the parameters.
    joined = ranked.join(F.broadcast(ranges), "_shard_range")
    slotted = joined.withColumn("slot", (F.col("_shard_first") + F.col("_shard_rank") - 1).cast("long"))
    return slotted.drop("_shard_range", "_shard_rank", "_shard_first", "_shard_h", "_shard_i")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", per_shard: int = PER_SHARD) -> DataFrame:
    """The input's rows and columns with ``size, shard, slot``."""
    wide = keyed(docs, id_col, text_col)
    keys = stored(wide.select("_shard_h", "_shard_i", "size"), "shard-keys")
    return place(wide, *layout(keys, shards, per_shard))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, its files in slot order."""
    ordered = sharded.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
