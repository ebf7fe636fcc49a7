"""Mixing sources to target weights by Poisson replication.

Each source has a share of the target weights. Its repetition rate is that share of the wished
output over the source's own size in bytes, so a rate of 1 keeps its size. Each document draws its
number of copies from the Poisson distribution with that rate: the uniform number is a hash of the
seed and the document's id, and the count is the number of cumulative probabilities at or below it.
So a draw is the same in every run and needs no state. Documents are exploded by their count and
dealt out by a hash of id and copy, within which rows are sorted: a global random order. Rows without an id are told apart
by their text when they draw, and by their place in the task that reads them when they are dealt out.

Built of DataFrame functions only. Sizes are summed before the shuffle; the rates are a row for each
source, written first, so the planner sees their size and broadcasts them while they are small. A
source that holds much of the data is one row there and needs no shuffle of its own.

Defined results: source NULL is a source of its own; text NULL counts as empty; each text has a byte
beside its own, so a source of empty texts has a size; repeated rows and rows of one id draw the
same count; rows without an id draw by their text and are dealt out one by one; target weights that name no source here have no effect,
sources without a target weight or with zero give no rows; an empty table gives no rows; input columns
named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import stored, without

SEED = 20_240
ALPHA = 0.7
EPOCHS = 1.0
ADDED = ("rate", "n_copies", "copy", "shuffle_key")
_HEX = 13  # 52 bits, exact in a double


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from the MD5 of seed and keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("double") / F.lit(float(16**_HEX))


def cumulative(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of the Poisson distribution, until the rest is below any draw's resolution.

    Logarithms are summed, so great rates don't underflow.
    """
    most = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.lit(0.0).alias("log"), F.array(F.exp(-rate)).alias("sums"))
    step = lambda s, k: F.struct(
        (s["log"] + F.log(rate) - F.log(k.cast("double"))).alias("log"),
        F.concat(s["sums"], F.array(F.element_at(s["sums"], -1) + F.exp(s["log"] + F.log(rate) - F.log(k.cast("double")) - rate))).alias("sums"),
    )
    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["sums"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS,
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(source, rate, sums)``: a row for each source with a positive rate.

    Without ``weights`` the target weight is the source's size to the power ``alpha``, which raises small sources and lowers
    great ones. ``epochs`` is the wished output as a multiple of the input.
    """
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(size).alias("bytes"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(alpha))
    elif not weights:
        weight = F.lit(0.0)
    else:
        given = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))])
        weight = F.coalesce(F.when(F.col("source").isNotNull(), given[F.col("source")]), F.lit(0.0))
    weighted = sizes.withColumn("weight", weight)
    all_bytes = weighted.agg(F.sum("bytes").cast("double")).scalar()
    all_weight = weighted.agg(F.sum("weight")).scalar()
    rate = F.lit(float(epochs)) * all_bytes * F.col("weight") / all_weight / F.col("bytes")
    return weighted.filter("weight > 0").select("source", rate.alias("rate")).withColumn("sums", cumulative(F.col("rate")))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The input's rows, each as often as drawn, with ``rate, n_copies, copy`` (1..n_copies) and ``shuffle_key``, in global random order."""
    base = without(docs, *ADDED)
    # Stored, so that the planner knows its size before the documents are read and broadcasts it only while it is small.
    per_source = stored(rates(docs, weights, alpha, epochs, source_col, text_col), "rates").toDF("_mix_source", "_mix_rate", "_mix_sums")
    drawn = base.join(per_source, F.col(source_col).cast("string").eqNullSafe(F.col("_mix_source")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = F.col(id_col).cast("string")
    drawn = drawn.withColumn("_mix_draw", uniform(seed, F.coalesce(known, F.concat(F.lit("text|"), F.md5(text.cast("binary"))))))
    # A third of all rows may lack an id: each has a name of its own.
    drawn = drawn.withColumn("_mix_name", F.coalesce(known, F.concat(F.lit("row|"), F.monotonically_increasing_id().cast("string"))))
    count = F.size(F.filter("_mix_sums", lambda p: p <= F.col("_mix_draw"))).cast("long")
    drawn = drawn.withColumnRenamed("_mix_rate", "rate").withColumn("n_copies", count).filter("n_copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.col("_mix_name"), F.col("copy").cast("string")))
    dealt = copies.select(*[F.col(f"`{c}`") for c in base.columns], "rate", "n_copies", "copy", key.alias("shuffle_key"), F.xxhash64(text).alias("_mix_text"))
    # Rows of one id but other texts are spread too.
    return dealt.repartition(F.col("shuffle_key"), F.col("_mix_text")).drop("_mix_text").sortWithinPartitions("shuffle_key")
