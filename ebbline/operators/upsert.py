"""Table maintenance as new table versions: insert-if-absent and delete-and-insert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def absent(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; NULL keys match, so a rerun adds nothing."""
    known = target.select(*keys)
    return source.join(known, same_key(source, known, keys), "left_anti")


def delete_insert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key is not reloaded, and all the new rows."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)
