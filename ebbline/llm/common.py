"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.session import new_path

#: White space of the word definitions: blank and 0x09 to 0x0D; ``bytes.split()`` cuts at the same six bytes.
SPACES = "\\x20\\x09-\\x0D"
WORD_PATTERN = f"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: no lineage, no second computation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever else the table carries."""
    return df.select(*columns)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of these names in any case: an operator's own output columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def as_bytes(column: str) -> Column:
    """Text as UTF-8 bytes, so that workers get it without decoding."""
    return F.col(column).cast("string").cast("binary")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``rows`` rows and about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            n = min(rows, batch.num_rows - start)
            while n > 1 and batch.slice(start, n).nbytes > size:
                n = (n + 1) // 2
            yield batch.slice(start, n)
            start += n
