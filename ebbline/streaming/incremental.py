"""Incremental ingest with Structured Streaming.

Progress is the checkpoint of the file source, so a restart continues with the
files not yet done, and a repeated batch writes the same partition again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ebbline.operators.dedup import latest
from ebbline.sources import tables


def stream_files(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files below a path, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there in micro-batches, then stop. Starting again resumes."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(
    stream: DataFrame, target: str, checkpoint: str, measures: list[Column] | None = None, progress: str | None = None
) -> StreamingQuery:
    """Append each micro-batch as its own partition ``batch_id=n``.

    A batch that is repeated after a failure overwrites its own partition only. ``measures`` are observed while a batch
    is written, so it is read once; with the time they are a row of the ``progress`` table, overwritten by batch in the same way.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{target}/batch_id={batch_id}"
        if measures is None:
            batch.write.mode("overwrite").parquet(path)
            return
        seen = Observation()
        batch.observe(seen, *measures).write.mode("overwrite").parquet(path)
        spark = batch.sparkSession
        record = spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{name} long" for name in seen.get))
        record.withColumn("updated_utc", F.current_timestamp()).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    return run_available(stream, checkpoint, write)


def read_ingested(spark: SparkSession, target: str, keys: list[str], order: list[str], ties: list[str]) -> DataFrame:
    """The ingested table, latest row per key; of equal rows the later batch wins."""
    rows = spark.read.option("basePath", target).parquet(target)
    return latest(rows, keys, order, ["batch_id", *ties]).drop("batch_id")


def upsert_batches(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], ties: list[str]) -> StreamingQuery:
    """Keep the latest row of each key in the stream's state, and write the keys of each batch with it to ``batch_id=n``.

    The state is a streaming aggregation's own: it is checkpointed with the source's progress, so after a restart a late row
    still loses against the newer one it has, and a repeated batch overwrites its own partition with the same rows. A batch
    costs its own rows. Columns must be of types that can be ordered.
    """
    rest = [c for c in stream.columns if c not in (*keys, *order, *ties)]
    newest = stream.groupBy(*keys).agg(F.max(F.struct(*order, *ties, *rest)).alias("_row"))
    rows = newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in stream.columns])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_upserted(spark: SparkSession, target: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The table as of the last batch: each key's row of the last batch that had it."""
    names = [f"`{f.name}`" for f in schema.fields]
    fields = StructType([*schema.fields, StructField("batch_id", LongType())])
    return latest(tables.read_table(spark, target, fields), keys, ["batch_id"]).select(*names)
