"""Id lists: keep or look up rows by a list whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Some 4 MB of long ids; beyond it the list is joined by shuffle.
BROADCAST_IDS = 250_000
# Values that may become literals of a partition filter.
LITERAL_VALUES = 10_000


def is_small(ids: DataFrame, most: int = BROADCAST_IDS) -> bool:
    """Whether there are at most ``most`` rows. Counting stops there."""
    return ids.limit(most + 1).count() <= most


def bounded_rows(df: DataFrame, most: int = LITERAL_VALUES) -> list[Row] | None:
    """All rows if there are at most ``most`` of them, else None."""
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None


def parse_wanted(raw: DataFrame, ids: DataFrame, parse, key: str = "app_id") -> DataFrame:
    """Parsed rows of the wanted ids, without ever shuffling the raw text.

    A short id list is broadcast and the raw rows are filtered where they are read.
    A long one is joined after parsing, when the rows are narrow. That join is an
    inner one on distinct ids: a semi-join would be pushed below the parsing.
    """
    wanted = ids.select(key).distinct()
    if is_small(wanted):
        return parse(raw.join(F.broadcast(wanted), key, "left_semi"))
    return parse(raw).join(wanted, key)
