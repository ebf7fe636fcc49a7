"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str], ties: list[str | Column] | None = None) -> DataFrame:
    """Keep the row with the greatest ``order`` columns for each key.

    ``ties`` decides between equal rows, so the result does not depend on file order.
    Spark limits each group before the shuffle (``WindowGroupLimit``): a hot key
    sends one row per input partition, not all its rows.
    """
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in ties or []]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def last_in_order(df: DataFrame, keys: list[str], place: tuple[str, ...]) -> DataFrame:
    """Keep the row of each key that stands last, by the columns of ``place``, which are dropped."""
    return latest(df, keys, list(place)).drop(*place)
