"""Writers: numbered parquet parts, compaction, headed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbline.params import ROWS_PER_FILE


def write_parts(df: DataFrame, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE) -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def compact_parts(
    spark: SparkSession, source: str, target: str, schema: str | None = None, files: int | None = None
) -> None:
    """Rewrite many small parts as few files; without a schema those of the parts are merged.

    Without ``files`` the scan already packs small parts into partitions of
    ``spark.sql.files.maxPartitionBytes``, and each becomes one file: no shuffle.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    parts = reader.parquet(source)
    if files:
        parts = parts.coalesce(files)
    parts.write.mode("overwrite").parquet(target)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed UTF-8 CSV, quotes doubled inside quoted fields."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"', encoding="UTF-8", emptyValue="").csv(path)


def write_ids(ids: DataFrame, path: str) -> None:
    """Distinct ids, ascending over the files of the folder."""
    write_csv(ids.select("app_id").distinct().orderBy("app_id"), path)
