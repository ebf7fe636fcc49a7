"""Forecast evaluation in one aggregation pass.

``predictions`` holds ``base_log, delta, y_log_avg`` and the predicted log changes
``delta_q10, delta_q50, delta_q90``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def _rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def metrics(predictions: DataFrame) -> DataFrame:
    """Error against persistence, interval coverage, calibration, direction."""
    y, base = F.col("y_log_avg"), F.col("base_log")
    low, mid, high = (base + F.col(f"delta_q{q}") for q in (10, 50, 90))
    up, true_up = F.col("delta_q50") > 0, F.col("delta") > 0
    # The names of the metrics.
    scored = predictions.agg(
        _rmse(y - base).alias("rmse_persistence_log"),
        _rmse(y - mid).alias("rmse_q50_log"),
        _share((y >= low) & (y <= high)).alias("coverage_10_90"),
        _share(y < low).alias("p_below_10"),
        _share(y < mid).alias("p_below_50"),
        _share(up == true_up).alias("directional_acc_q50_delta"),
        _share(up).alias("pred_pos_rate_q50_delta"),
        _share(true_up).alias("true_pos_rate_delta"),
        _share((low > mid) | (mid > high)).alias("crossing_rate"),
        F.count("*").alias("n_test"),
    )
    return scored.withColumn(
        "delta_rmse_vs_persistence", F.col("rmse_persistence_log") - F.col("rmse_q50_log")
    )


def downtrend_slice(predictions: DataFrame) -> DataFrame:
    """Rows that fell twice in a row: how often the forecast and the truth fall on."""
    falling = predictions.filter((F.col("avg_km2") > F.col("avg_km1")) & (F.col("avg_km1") > F.col("avg_k")))
    return falling.agg(
        F.count("*").alias("n_rows"),
        _share(F.col("delta_q50") < 0).alias("pred_negative_share"),
        _share(F.col("delta") < 0).alias("true_negative_share"),
    )
