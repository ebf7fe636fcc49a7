"""Readers with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.functions.text import to_id

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct integer ids of a headed CSV; the column may be called app_id or appid."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    name = next((n for n in ("app_id", "appid") if n in raw.columns), None)
    if name is None:
        raise ValueError(f"Id file must contain 'app_id'. Found: {raw.columns}")
    return raw.select(to_id(F.col(name)).alias("app_id")).dropna().distinct()


def read_monthly_long(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS, multiLine="false").schema(schemas.MONTHLY_LONG).csv(path)


def read_metadata_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(schemas.METADATA_LANDING).csv(path)


def read_predict_input(spark: SparkSession, path: str) -> DataFrame:
    """Scoring input, all text: the scorer converts and reports per row."""
    return spark.read.options(**CSV_OPTIONS).csv(path)


def missing(error: AnalysisException) -> bool:
    """Whether the error says that there is no such path, or no file with a schema in it."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All parquet parts below a path; columns a part lacks are NULL; no parts is an error."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if not missing(error):
            raise
        raise FileNotFoundError(f"No parquet parts found in: {path}") from error
    return spark.read.schema(schema).parquet(path)


#: Where a row stands: its file's path, then its place in the file.
FILE_ORDER = ("_file", "_row")


def read_parts_in_order(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All parts below a path as ``read_parts`` reads them, each row with its ``FILE_ORDER``."""
    rows = read_parts(spark, path, schema)
    return rows.select(*rows.columns, *[F.col(f"_metadata.{field}").alias(name) for field, name in zip(("file_path", "row_index"), FILE_ORDER)])
