"""Rows dealt out by a key."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_TASK = 250_000


def spread(rows: DataFrame, key: str, n_rows: int, rows_per_task: int | None = None) -> DataFrame:
    """Rows by key, in so many partitions that what a task holds does not grow with the table."""
    tasks = -(-n_rows // (rows_per_task or ROWS_PER_TASK))
    # A stated number is not merged again into a task or two for each core.
    return rows.repartition(tasks, key) if tasks > rows.sparkSession.sparkContext.defaultParallelism else rows.repartition(key)
