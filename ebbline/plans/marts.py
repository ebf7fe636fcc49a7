"""Retention marts: the newest month beside the one six months before it, curves, and group means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import parse_month
from ebbline.operators.quantile import exact_medians
from ebbline.operators.spread import spread
from ebbline.params import HORIZON

MART_APP = ("app_id", "app_sk", "price_tier", "is_free", "avg_players_recent", "avg_players_6mo_ago", "persistence_6m_ratio")


def app_persistence(
    activity: DataFrame, apps: DataFrame, recent_index: int = 1, months_apart: int = HORIZON, min_months: int = 0
) -> DataFrame:
    """One row per app: recent average, average so many calendar months before, and their ratio.

    The recent month is the newest one that stands at ``recent_index`` in its load. The past month is found by the
    calendar, at whatever index and in whichever load it stands; if no load has it, it is missing. An app without a recent month has no row. Where several
    loads have a month, the greatest index is that of the last load. A month with an unreadable label is older than
    any other and has no month before it. Rows are summed up by app and month before their months meet, a window
    of at most as many rows as an app has months.
    """
    if "month_start_date" not in activity.columns:
        activity = activity.withColumn("month_start_date", parse_month(F.col("month_label")))
    here = F.col("month_index") == recent_index
    number = F.coalesce(F.year("month_start_date") * 12 + F.month("month_start_date"), F.lit(0))
    months = activity.groupBy("app_id", number.alias("_month")).agg(
        F.max_by("avg_players", "month_index").alias("_avg"),
        F.max_by(F.when(here, F.col("avg_players")), F.when(here, F.col("month_index"))).alias("_recent"),
        F.max(here).alias("_here"),
        F.count("*").alias("_rows"),
    )
    newest = F.max(F.when(F.col("_here"), F.col("_month"))).over(Window.partitionBy("app_id"))
    paired = months.withColumn("_newest", newest).filter("_newest is not null")
    pairs = paired.groupBy("app_id").agg(
        F.max(F.when(F.col("_month") == F.col("_newest"), F.col("_recent"))).alias("avg_players_recent"),
        F.max(F.when(F.col("_month") == F.col("_newest") - months_apart, F.col("_avg"))).alias("avg_players_6mo_ago"),
        F.sum("_rows").alias("_months"),
    )
    if min_months:
        pairs = pairs.filter(F.col("_months") >= min_months)
    ratio = F.try_divide("avg_players_recent", "avg_players_6mo_ago")
    return (
        pairs.join(apps.select("app_id", "app_sk", "price_tier", "is_free"), "app_id")
        .withColumn("persistence_6m_ratio", ratio)
        .select(*MART_APP)
    )


def decay_curve(activity: DataFrame) -> DataFrame:
    return activity.groupBy("month_index", "month_label").agg(
        F.count("*").alias("row_count"),
        F.avg("avg_players").alias("avg_avg_players"),
        F.avg("peak_players").alias("avg_peak_players"),
    )


def _retention(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("game_count"),
        F.avg("persistence_6m_ratio").alias("avg_retention_ratio"),
        F.avg("avg_players_recent").alias("avg_players_recent"),
        F.avg("avg_players_6mo_ago").alias("avg_players_6mo_ago"),
    )


def tag_retention(persistence: DataFrame, bridge: DataFrame, tags: DataFrame, kind: str) -> DataFrame:
    """Retention by genre or category.

    Apps of one tag are averaged on the small surrogate key first; the names are
    joined to the finished groups. The bridge is counted, so it should be stored, and dealt out by app.
    """
    sk, name = f"{kind}_sk", f"{kind}_name"
    measures = persistence.select("app_sk", "persistence_6m_ratio", "avg_players_recent", "avg_players_6mo_ago")
    grouped = _retention(spread(bridge, "app_sk", bridge.count()).join(measures, "app_sk"), sk)
    return grouped.join(tags.select(sk, name), sk).select(
        name, "game_count", "avg_retention_ratio", "avg_players_recent", "avg_players_6mo_ago"
    )


def price_tier_retention(persistence: DataFrame) -> DataFrame:
    return _retention(persistence, "price_tier", "is_free")


def growth_decay(persistence: DataFrame, min_players: float = 0.0) -> DataFrame:
    """Apps with a positive ratio, as growing or decaying, with the size of the log change."""
    ratio = F.col("persistence_6m_ratio")
    return persistence.filter((ratio > 0) & (F.col("avg_players_recent") >= min_players)).select(
        "app_id", "price_tier", "is_free", "avg_players_recent", "avg_players_6mo_ago", "persistence_6m_ratio",
        F.when(ratio >= 1, "Growth").otherwise("Decay").alias("trend_bucket"),
        F.abs(F.ln(ratio)).alias("abs_log_change"),
    )


def curve_measures(activity: DataFrame) -> DataFrame:
    """Sum and exact median of the activity measures per month of the curve."""
    keys = ["month_index", "month_label"]
    sums = activity.groupBy(*keys).agg(
        F.sum("avg_players").alias("sum_avg_players"), F.sum("peak_players").alias("sum_peak_players")
    )
    medians = (
        exact_medians(activity, keys, ["avg_players", "peak_players"])
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("column_name") == "avg_players", F.col("median"))).alias("median_avg_players"),
            F.max(F.when(F.col("column_name") == "peak_players", F.col("median"))).alias("median_peak_players"),
        )
    )
    return sums.join(medians, keys, "left")
