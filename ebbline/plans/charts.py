"""The dashboard's chart queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.params import CHART_TOP_N, MONTHS_KEPT

# Fixed value: a tier that is shown under another name.
TIER_ALIAS = {"Under_10": "0_10"}


def life_cycle(curve: DataFrame) -> DataFrame:
    """Curve by month index, oldest first: mean of the group means, and its weighted form."""
    return (
        curve.filter(F.col("month_index").between(1, MONTHS_KEPT))
        .groupBy("month_index")
        .agg(
            F.avg("avg_avg_players").alias("avg_avg_players"),
            F.avg("avg_peak_players").alias("avg_peak_players"),
            (F.sum(F.col("avg_peak_players") * F.col("row_count")) / F.sum("row_count")).alias("weighted_peak_players"),
            F.sum("row_count").alias("row_count"),
        )
        .orderBy(F.desc("month_index"))
    )


def price_range(tier_mart: DataFrame) -> DataFrame:
    """Mean retention per tier, best first, unweighted over the free flag."""
    tier = F.col("price_tier")
    label = tier
    for name, shown in TIER_ALIAS.items():
        label = F.when(tier == name, shown).otherwise(label)
    return (
        tier_mart.groupBy(label.alias("price_range"))
        .agg(
            F.avg("avg_retention_ratio").alias("avg_retention_ratio"),
            (
                F.sum(F.col("avg_retention_ratio") * F.col("game_count"))
                / F.sum(F.when(F.col("avg_retention_ratio").isNotNull(), F.col("game_count")))
            ).alias("weighted_retention_ratio"),
            F.sum("game_count").alias("game_count"),
        )
        .orderBy(F.desc_nulls_last("avg_retention_ratio"), "price_range")
    )


def top_groups(mart: DataFrame, name: str, n: int = CHART_TOP_N) -> DataFrame:
    """The n groups with the best mean retention; ties by name."""
    return (
        mart.groupBy(name)
        .agg(F.avg("avg_retention_ratio").alias("avg_retention_ratio"), F.sum("game_count").alias("game_count"))
        .orderBy(F.desc_nulls_last("avg_retention_ratio"), name)
        .limit(n)
    )


def ranked_changes(trend_mart: DataFrame, n: int = CHART_TOP_N) -> DataFrame:
    """The n largest changes of each bucket. The limit applies before the shuffle too."""
    order = Window.partitionBy("trend_bucket").orderBy(F.desc("abs_log_change"), "app_id")
    return trend_mart.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def excluding(trend_mart: DataFrame, excluded: DataFrame) -> DataFrame:
    """All points but the listed ``(trend_bucket, app_id)`` pairs."""
    return trend_mart.join(excluded, ["trend_bucket", "app_id"], "left_anti")


def trend_lines(trend_mart: DataFrame) -> DataFrame:
    """Least-squares line of recent on past activity, one per bucket."""
    y, x = "avg_players_recent", "avg_players_6mo_ago"
    return trend_mart.groupBy("trend_bucket").agg(
        F.count("*").alias("n_points"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )
