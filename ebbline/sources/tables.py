"""Stored tables that a load changes in part: folders by partition, and tables bucketed by key."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.sources.readers import missing

BUCKETS = 64


def key_bucket(*keys: str) -> Column:
    """The hash partition of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows below a path, none where nothing has been written."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if not missing(error):
            raise
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, part: str) -> None:
    """Write whole partitions; those that ``rows`` has replace the stored ones, all others stay. Large ones are spread over tasks."""
    by_part = rows.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part)
    by_part.parquet(path)


def bucketed_table(spark: SparkSession, path: str, schema: str, keys: list[str]) -> str:
    """The name of a table at ``path`` whose files are bucketed and sorted by ``keys``; made if the catalog lacks it.

    A join on just these keys reads it without an exchange; ``insertInto`` appends files to its buckets.
    """
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {BUCKETS} BUCKETS LOCATION '{path}'"
    )
    return name


def append_bucketed(rows: DataFrame, name: str, keys: list[str]) -> None:
    """Add rows to a bucketed table. They are dealt out as its buckets are, so each bucket gets one file."""
    rows.repartition(BUCKETS, *keys).write.insertInto(name)
