"""Training rows: target, feature set, imputation, weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.series import NUMERIC_FEATURES, base_log
from ebbline.functions.text import finite
from ebbline.operators.quantile import exact_medians
from ebbline.params import DOWNTREND_FEATURE, DOWNTREND_THRESHOLD, DOWNTREND_WEIGHT


def model_rows(panel: DataFrame) -> DataFrame:
    """Panel rows that have id, target and base, with ``base_log`` and ``delta``."""
    kept = panel.dropna(subset=["app_id", "y_log_avg", "avg_k"])
    return kept.withColumn("base_log", base_log(F.col("avg_k"))).withColumn(
        "delta", F.col("y_log_avg") - F.col("base_log")
    )


def non_null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, n_values)`` for each column, in one pass over one row of counts."""
    counts = rows.agg(*[F.count(finite(F.col(c).cast("double"))).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_values")


def usable_features(train: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Feature columns with at least one value in the training rows; one row reaches the driver."""
    columns = list(columns or NUMERIC_FEATURES)
    counts = {r["column_name"]: r["n_values"] for r in non_null_counts(train, columns).collect()}
    return [c for c in columns if counts[c] > 0]


def fit_medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact training medians; one number per feature reaches the driver."""
    return {r["column_name"]: r["median"] for r in exact_medians(train, [], columns).collect()}


def impute(rows: DataFrame, medians: dict[str, float]) -> DataFrame:
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    return rows.withColumns(filled)


def sample_weight(trend: Column) -> Column:
    """More weight for a clear downtrend; a missing trend gets none."""
    return F.when(F.coalesce(trend, F.lit(0.0)) < DOWNTREND_THRESHOLD, DOWNTREND_WEIGHT).otherwise(1.0)


def weight_summary(rows: DataFrame) -> DataFrame:
    """Rows per weight and the boosted share."""
    weight = sample_weight(F.col(DOWNTREND_FEATURE))
    boosted = (F.col(DOWNTREND_FEATURE) < DOWNTREND_THRESHOLD).cast("double")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.sum(weight).alias("sum_weight"),
        F.avg(F.coalesce(boosted, F.lit(0.0))).alias("boosted_share"),
    )
