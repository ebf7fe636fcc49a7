"""Metadata documents to a metadata table, and that table to the load format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.functions.text import blank_to_null, bool_label, clean_items, clean_text, parse_list, pipe_join
from ebbline.operators.checks import require_columns
from ebbline.operators.dedup import latest


def _names(items: Column) -> Column:
    return clean_items(F.transform(items, lambda x: F.coalesce(blank_to_null(x["description"]), x["name"])))


def parse_documents(documents: DataFrame) -> DataFrame:
    """``(app_id, payload, scraped_utc)`` to the metadata table.

    Status is ``ok``, ``no_data`` (no node for the id, or not a success) or
    ``error`` (the payload is not JSON).
    """
    node = F.element_at(F.from_json("payload", schemas.PAYLOAD, {"mode": "PERMISSIVE"}), F.col("app_id").cast("string"))
    # from_json cannot tell a broken document from an empty one; the JSON path parser can.
    is_json = F.get_json_object("payload", "$").isNotNull() | (F.trim("payload") == "null")
    read = documents.select("app_id", "scraped_utc", "payload", node.alias("node"), is_json.alias("_is_json"))
    status = (
        F.when(F.col("payload").isNotNull() & ~F.col("_is_json"), "error")
        .when(F.coalesce(F.col("node.success"), F.lit(False)), "ok")
        .otherwise("no_data")
    )
    judged = read.withColumn("status", status)
    data = F.col("node.data")

    def when_ok(value: Column) -> Column:
        return F.when(F.col("status") == "ok", value)

    price = F.when(data["price_overview"]["currency"] == "USD", data["price_overview"]["final"] / 100.0)
    return judged.select(
        "app_id",
        "status",
        "scraped_utc",
        when_ok(F.coalesce(data["is_free"], F.lit(False))).alias("is_free"),
        when_ok(price).alias("price_usd"),
        when_ok(blank_to_null(data["release_date"]["date"])).alias("release_date_str"),
        when_ok(_names(data["genres"])).alias("genres"),
        when_ok(_names(data["categories"])).alias("categories"),
        F.when(F.col("status") == "error", "malformed_json").alias("error"),
    )


def _has(df: DataFrame, name: str, value: Column, default: Column) -> Column:
    return (value if name in df.columns else default).alias(name)


def _list_field(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("")
    if df.schema[name].dataType.typeName() == "array":
        items = clean_items(F.col(name))
    else:
        items = parse_list(F.col(name))
    return clean_text(pipe_join(items))


def load_format(metadata: DataFrame) -> DataFrame:
    """Cleaned text columns, one row per id, lists pipe-separated; optional columns may be absent."""
    require_columns(metadata, ["app_id"], "Metadata")
    if "status" in metadata.columns:
        metadata = metadata.filter("status = 'ok'")
    order = [c for c in ["scraped_utc"] if c in metadata.columns]
    newest = latest(metadata, ["app_id"], order, metadata.columns)
    empty = F.lit("")
    return newest.select(
        F.col("app_id").cast("long").alias("app_id"),
        _has(newest, "is_free", bool_label(F.col("is_free")) if "is_free" in newest.columns else empty, empty),
        _has(newest, "price_usd", F.col("price_usd"), F.lit(None).cast("double")),
        _has(newest, "release_date_str", clean_text(F.col("release_date_str")), empty),
        _list_field(newest, "genres").alias("genres_csv"),
        _list_field(newest, "categories").alias("categories_csv"),
        _has(newest, "scraped_utc", F.col("scraped_utc"), empty),
    )
