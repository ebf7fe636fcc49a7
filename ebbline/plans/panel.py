"""Supervised panel: features at position k, target at k + horizon.

The twelve months of an entity sit in one wide row, so the whole panel is computed
row by row from arrays: no window, no shuffle beyond de-duplication and the
metadata join, both on ``app_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import months_between, parse_month, parse_release_month
from ebbline.functions.series import shape_features
from ebbline.functions.text import clean_items, finite
from ebbline.operators.checks import require_columns
from ebbline.operators.dedup import latest
from ebbline.params import HORIZON, MIN_MONTHS, TOP_K_CATEGORIES, TOP_K_GENRES
from ebbline.schemas import MONTH_COLUMNS

TAG_FIELDS = {"genre": "genres", "category": "categories"}
TAG_PREFIX = {"genre": "genre_", "category": "cat_"}


def _months(with_index: bool = False) -> Column:
    """The wide month columns as an array of structs, newest first."""
    return F.array(
        *[
            F.struct(
                *([F.lit(i).alias("month_index")] if with_index else []),
                F.col(label).alias("label"),
                finite(F.col(avg)).alias("avg"),
                finite(F.col(peak)).alias("peak"),
            )
            for i, (label, avg, peak) in enumerate(MONTH_COLUMNS, start=1)
        ]
    )


def chronological(months: Column) -> Column:
    """Observations with both measures present, oldest first."""
    return F.reverse(F.filter(months, lambda m: m["avg"].isNotNull() & m["peak"].isNotNull()))


def unpivot_months(wide: DataFrame) -> DataFrame:
    """Wide metrics to one row per month that has a label or a value."""
    return (
        wide.select("app_id", "scraped_utc", "url", F.inline(_months(with_index=True)))
        .filter("label is not null or avg is not null or peak is not null")
        .select(
            "app_id", "month_index", F.col("label").alias("month_label"),
            F.col("avg").alias("avg_players"), F.col("peak").alias("peak_players"), "scraped_utc", "url",
        )
    )


def chrono_series(wide: DataFrame) -> DataFrame:
    """Valid observations with their chronological position ``k_index``."""
    return wide.select("app_id", F.posexplode(chronological(_months())).alias("k_index", "month")).select(
        "app_id", "k_index", F.col("month.label").alias("month_label"),
        F.col("month.avg").alias("avg_players"), F.col("month.peak").alias("peak_players"),
    )


def with_history(wide: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Entities with enough valid observations, with their ``series`` array."""
    return wide.withColumn("series", chronological(_months())).filter(F.size("series") >= min_months)


def metrics_with_metadata(wide: DataFrame, metadata: DataFrame) -> DataFrame:
    """Latest usable metrics joined to latest usable metadata; clashing names get ``_meta``."""
    require_columns(wide, ["app_id", "status"], "Metrics")
    require_columns(metadata, ["app_id"], "Metadata")
    metrics = latest(wide.filter("status = 'ok'"), ["app_id"], ["scraped_utc"], wide.columns)
    if "status" in metadata.columns:
        metadata = metadata.filter("status = 'ok'")
    metadata = latest(metadata, ["app_id"], [c for c in ("scraped_utc",) if c in metadata.columns], metadata.columns)
    for name in set(metadata.columns) & set(metrics.columns) - {"app_id"}:
        metadata = metadata.withColumnRenamed(name, f"{name}_meta")
    return metrics.join(metadata, "app_id")


def tag_vocabulary(joined: DataFrame, top_genres: int = TOP_K_GENRES, top_categories: int = TOP_K_CATEGORIES) -> DataFrame:
    """``(kind, tag, tag_count, rank)``: the most frequent tags per kind, ties by tag.

    A tag counts once per occurrence. Both kinds are counted in one pass; only the
    counted tags are ranked.
    """

    def tagged_items(kind: str, field: str) -> Column:
        return F.transform(clean_items(F.col(field)), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("tag")))

    tagged = [tagged_items(kind, field) for kind, field in TAG_FIELDS.items()]
    counts = (
        joined.select(F.explode(F.concat(*tagged)).alias("item"))
        .groupBy("item.kind", "item.tag")
        .agg(F.count("*").alias("tag_count"))
    )
    order = Window.partitionBy("kind").orderBy(F.desc("tag_count"), "tag")
    limit = F.when(F.col("kind") == "genre", top_genres).otherwise(top_categories)
    most = max(top_genres, top_categories)
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.filter(F.col("rank") <= limit)


def collect_vocabulary(vocabulary: DataFrame) -> dict[str, list[str]]:
    """Vocabulary as ordered lists: at most the two top-k sizes, so it fits the driver."""
    rows = vocabulary.select("kind", "tag").orderBy("kind", "rank").collect()
    return {kind: [r["tag"] for r in rows if r["kind"] == kind] for kind in TAG_FIELDS}


def multihot(tags: Column, vocabulary: list[str], prefix: str) -> list[Column]:
    """One 0/1 column per vocabulary tag, exact match on stripped tags."""
    items = clean_items(tags)
    return [F.array_contains(items, tag).cast("int").alias(f"{prefix}{tag}") for tag in vocabulary]


def multihot_columns(panel: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """The panel with its tag arrays replaced by 0/1 columns."""
    hot = [c for kind, field in TAG_FIELDS.items() for c in multihot(F.col(field), vocabulary[kind], TAG_PREFIX[kind])]
    return panel.select("*", *hot).drop(*TAG_FIELDS.values())


def build_panel(joined: DataFrame, horizon: int = HORIZON, min_months: int = MIN_MONTHS) -> DataFrame:
    """Panel rows of every entity with enough history.

    ``joined`` is :func:`metrics_with_metadata`. Positions with a value at or below
    zero in their window or target give no row. Tags stay arrays.
    """
    # Texts and features are worked out in steps of their own: the code of all in one step is too long to be compiled.
    eligible = with_history(joined, max(min_months, horizon + 3)).withColumn("_released", parse_release_month(F.col("release_date_str")))

    def window_at(k: Column) -> Column:
        fields = [k.cast("int").alias("k_index"), F.get("series", k)["label"].alias("month_k_label")]
        for measure in ("avg", "peak"):
            for offset, name in ((-2, "2"), (-1, "1"), (0, "0"), (horizon, "y")):
                fields.append(F.get("series", k + offset)[measure].alias(f"_{measure}{name}"))
        return F.struct(*fields)

    positions = F.sequence(F.lit(2), F.size("series") - horizon - 1)
    rows = eligible.select(
        "app_id", "is_free", "price_usd", "release_date_str", "genres", "categories",
        "_released",
        F.inline(F.transform(positions, window_at)),
    )
    values = [f"_{measure}{name}" for measure in ("avg", "peak") for name in ("2", "1", "0", "y")]
    positive = rows.filter(" and ".join(f"{v} > 0" for v in values))
    shape = shape_features(
        tuple(F.col(f"_avg{n}") for n in "210"), tuple(F.col(f"_peak{n}") for n in "210")
    )
    positive = positive.withColumn("_month", parse_month(F.col("month_k_label"))).withColumns({f"_{name}": c for name, c in shape.items()})
    age = months_between(F.col("_released"), F.col("_month"))
    return positive.select(
        "app_id",
        "k_index",
        F.col("k_index").cast("double").alias("age_months"),
        age.cast("double").alias("age_since_release_months"),
        "month_k_label",
        F.col("_avgy").alias("y_avg"),
        F.col("_peaky").alias("y_peak"),
        F.ln("_avgy").alias("y_log_avg"),
        F.ln("_peaky").alias("y_log_peak"),
        *[finite(F.col(f"_{name}")).alias(name) for name in shape],
        F.coalesce(F.col("is_free"), F.lit(False)).cast("int").alias("is_free"),
        finite(F.col("price_usd")).alias("price_usd"),
        "release_date_str",
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
    )


def null_rate(panel: DataFrame, column: str = "y_log_avg") -> DataFrame:
    return panel.agg(F.count("*").alias("n_rows"), F.avg(F.col(column).isNull().cast("double")).alias("null_rate"))
