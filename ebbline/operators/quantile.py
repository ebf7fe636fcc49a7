"""Exact medians and weighted quantiles by radix selection: counting passes only.

Every double has a 64-bit code whose order is the numbers' own. A pass cuts the codes that are still in question by their
next sixteen bits, adds up the weights of the cells and keeps the cell that holds the wanted rank; after four passes the
cell is one number. Where few rows are left, one pass looks at all their remaining bits. No pass ranks rows or gathers a
group: a task sends at most 65,536 sums for each key (of few rows, one for each), and what is ordered are those cells. A
group may hold any share of the rows. The cells that were kept are stored and, where they are few, broadcast,
so that only the sums of a pass are shuffled, never the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.text import finite
from ebbline.session import new_path

_DIGIT = 16
_BITS = 64
_FEW_ROWS = 1_000_000  # so many rows in kept cells are told apart in one pass
_BROADCAST_CELLS = 100_000  # kept cells; beyond it they are joined by shuffle
_SLACK = 1 - 1e-12  # sums of weights differ in their last bits by the order of addition


def _arrow_codes() -> Callable:
    """Made inside a function, so that workers need not have this package."""
    import numpy as np
    import pyarrow as pa

    def codes(values):
        numbers = values.to_numpy(zero_copy_only=False)
        bits = np.abs(numbers).view(np.int64)
        return pa.array(np.where(numbers < 0, -bits, bits), pa.int64(), mask=np.isnan(numbers))

    codes.__annotations__ = {"values": pa.Array, "return": pa.Array}  # as types: Spark does not read them from text
    return codes


def order_code(value: Column) -> Column:
    """The bits of a finite double as a long in the order of the numbers; both zeros are 0.

    Read from Arrow batches: by arithmetic alone a code takes a logarithm and several powers. Marked as not deterministic so that the planner
    does not work it out again for each place that reads it.
    """
    return F.arrow_udf(_arrow_codes(), "long").asNondeterministic()(value)


def _stored(df: DataFrame) -> DataFrame:
    """Sums or cells, written to the shared folder and read back."""
    path = new_path(df.sparkSession, "cells")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _summed(rows: DataFrame) -> Callable[[int, DataFrame | None, int | None], DataFrame]:
    """Sums of the rows' cells at a shift: of all, or by target of those in the kept cells, whose prefixes stand before another shift."""

    def cells(shift: int, kept: DataFrame | None, before: int | None) -> DataFrame:
        cell = F.shiftright("_code", shift).alias("_cell")
        sums = (F.sum("_weight").alias("_sum"), F.count("*").alias("_rows"), F.min("_value").alias("_value"))
        if kept is None:
            return rows.groupBy("_key", cell).agg(*sums)
        kept = F.broadcast(kept) if kept.count() <= _BROADCAST_CELLS else kept
        near = rows.withColumn("_prefix", F.shiftright("_code", before)).join(kept, ["_key", "_prefix"])
        return near.groupBy("_key", "_target", "_want", cell).agg(*sums)

    return cells


def _summed_columns(df: DataFrame, columns: list[str]) -> Callable[[int, DataFrame | None, int | None], DataFrame]:
    """The same of whole columns, a row weighing one. Cells of a batch are counted column by column, so rows are never unpivoted."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def cells(shift: int, kept: DataFrame | None, before: int | None) -> DataFrame:
        prefixes = None
        if kept is not None:  # a cell or two of each column
            prefixes = {c: [] for c in columns}
            for row in kept.select("_key.column_name", "_prefix").distinct().collect():
                prefixes[row["column_name"]].append(row["_prefix"])
        counted = wide.mapInArrow(_arrow_cells(columns, shift, prefixes, before), "column_name string, _cell long, _rows long, _value double")
        found = counted.groupBy(F.struct("column_name").alias("_key"), "_cell").agg(
            F.sum("_rows").cast("double").alias("_sum"), F.sum("_rows").alias("_rows"), F.min("_value").alias("_value")
        )
        if kept is None:
            return found
        return found.withColumn("_prefix", F.shiftright("_cell", before - shift)).join(F.broadcast(kept), ["_key", "_prefix"]).drop("_prefix")

    return cells


def _arrow_cells(columns: list[str], shift: int, prefixes: dict[str, list[int]] | None, before: int | None) -> Callable:
    """Made inside a function, so that workers need not have this package."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            found = []
            for at, name in enumerate(columns):
                numbers = batch.column(at).to_numpy(zero_copy_only=False)
                numbers = numbers[np.isfinite(numbers)]
                bits = np.abs(numbers).view(np.int64)
                codes = np.where(numbers < 0, -bits, bits)
                if prefixes is not None:
                    near = np.isin(codes >> before, np.array(prefixes[name], np.int64))
                    numbers, codes = numbers[near], codes[near]
                order = np.argsort(codes)
                cell = codes[order] >> shift
                first = np.flatnonzero(np.concatenate([np.ones(min(len(cell), 1), bool), cell[1:] != cell[:-1]]))
                found.append((np.full(len(first), at), cell[first], np.diff(first, append=len(cell)), numbers[order[first]]))
            at, cell, rows, value = (np.concatenate(f) for f in zip(*found))
            names = pa.DictionaryArray.from_arrays(pa.array(at, pa.int32()), pa.array(columns, pa.string())).cast(pa.string())
            yield pa.record_batch([names, pa.array(cell, pa.int64()), pa.array(rows, pa.int64()), pa.array(value, pa.float64())], ["column_name", "_cell", "_rows", "_value"])

    return run


def select_ranks(cells_at: Callable[[int, DataFrame | None, int | None], DataFrame], wants: Column) -> DataFrame:
    """``(_key, _target, value)``: the least value whose weight, with all below, reaches the target's wanted one.

    ``cells_at`` reads the rows once for each pass, see :func:`_summed`; ``wants`` is an array of a few wanted weights
    of a key, the targets, by its weight ``_total``. The key is a struct, whose missing fields equal each other.
    """
    found, shift = None, _BITS - _DIGIT
    while True:
        if found is None:  # all targets of a key share the first pass
            cells = _stored(cells_at(shift, None, None))
            totals = cells.groupBy("_key").agg(F.sum("_sum").alias("_total"))
            targets = totals.select("_key", F.posexplode(wants).alias("_target", "_want"))
            cells = cells.join(targets, "_key")
        else:
            cells = cells_at(shift, found.drop("_rows"), before)
        upto = Window.partitionBy("_key", "_target").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        reached = cells.withColumn("_upto", F.sum("_sum").over(upto)).filter(F.col("_upto") >= F.col("_want") * _SLACK)
        first = F.min(F.struct("_cell", (F.col("_upto") - F.col("_sum")).alias("before"), "_rows", "_value")).alias("_first")
        kept = reached.groupBy("_key", "_target", "_want").agg(first)
        if shift == 0:
            return kept.select("_key", "_target", F.col("_first._value").alias("value"))
        found = _stored(
            kept.select(
                "_key", "_target", (F.col("_want") - F.col("_first.before")).alias("_want"), F.col("_first._cell").alias("_prefix"), "_first._rows"
            )
        )
        before, left = shift, found.agg(F.sum("_rows")).first()[0] or 0
        shift = 0 if left <= _FEW_ROWS else shift - _DIGIT


def exact_medians(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Exact median of each column in each group: rows ``(groups..., column_name, median)``.

    NaN and the infinities are missing values; a column without values gives no row. ``df`` is read two to four times, so it should be stored.
    """
    n = F.col("_total")
    both = F.array(F.floor((n + 1) / 2).cast("double"), (F.floor(n / 2) + 1).cast("double"))
    middle = select_ranks(_summed(_long(df, groups, columns)) if groups else _summed_columns(df, columns), both)
    return middle.groupBy("_key").agg((F.sum("value") / 2).alias("median")).select("_key.*", "median")


def _long(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    keys = [*groups, "column_name"]
    long = df.select(*groups, *[finite(F.col(c).cast("double")).alias(c) for c in columns]).unpivot(groups, columns, "column_name", "_value")
    return long.filter("_value is not null").withColumn("_code", order_code(F.col("_value"))).select(F.struct(*keys).alias("_key"), "_value", "_code", F.lit(1.0).alias("_weight"))


def weighted_quantiles(df: DataFrame, groups: list[str], value: Column, weight: Column, q: float) -> DataFrame:
    """``(groups..., quantile)``: the least value that, with all below it, has a share ``q`` of the group's weight. Exact.

    Rows without a value or with a weight of zero don't count.
    """
    rows = df.select(
        F.struct(*(groups or [F.lit(0).alias("_all")])).alias("_key"), finite(value.cast("double")).alias("_value"), weight.cast("double").alias("_weight")
    )
    rows = rows.filter("_value is not null and _weight > 0").withColumn("_code", order_code(F.col("_value")))
    return select_ranks(_summed(rows), F.array(F.col("_total") * q)).select(*[F.col(f"_key.`{g}`") for g in groups], F.col("value").alias("quantile"))
