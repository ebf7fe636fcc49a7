"""Features of three consecutive observations, shared by training and scoring.

``oldest``, ``previous`` and ``current`` are the observations at k-2, k-1 and k.
Both the panel and the scorer build their features here, so they cannot drift.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.params import MIN_BASE


def growth(current: Column, previous: Column) -> Column:
    return F.try_divide(current, previous) - 1.0


def population_std(a: Column, b: Column, c: Column) -> Column:
    mean = (a + b + c) / 3.0
    return F.sqrt((F.pow(a - mean, F.lit(2.0)) + F.pow(b - mean, F.lit(2.0)) + F.pow(c - mean, F.lit(2.0))) / 3.0)


def lag_features(name: str, oldest: Column, previous: Column, current: Column) -> dict[str, Column]:
    """Lags, growth and log-space shape of one measure."""
    l0, l1, l2 = F.ln(current), F.ln(previous), F.ln(oldest)
    return {
        f"{name}_k": current,
        f"{name}_km1": previous,
        f"{name}_km2": oldest,
        f"{name}_growth_k": growth(current, previous),
        f"{name}_growth_km1": growth(previous, oldest),
        f"log_{name}_k": l0,
        f"trend3_log_{name}": l0 - l2,
        f"curv_log_{name}": (l0 - l1) - (l1 - l2),
        f"vol3_log_{name}": population_std(l2, l1, l0),
    }


def shape_features(
    avg: tuple[Column, Column, Column], peak: tuple[Column, Column, Column]
) -> dict[str, Column]:
    """All features of one position; both tuples run oldest, previous, current."""
    out = lag_features("avg", *avg) | lag_features("peak", *peak)
    out["avg_over_peak_k"] = F.try_divide(avg[2], peak[2])
    out["avg_over_peak_km1"] = F.try_divide(avg[1], peak[1])
    out["shock_log_peak_avg"] = out["log_peak_k"] - out["log_avg_k"]
    return {name: out[name] for name in SHAPE_FEATURES}


def base_log(avg_k: Column) -> Column:
    """Log of the persistence forecast."""
    return F.ln(F.greatest(avg_k, F.lit(MIN_BASE)))


# The feature names, in model order.
SHAPE_FEATURES = (
    "avg_k", "avg_km1", "avg_km2", "peak_k", "peak_km1", "peak_km2",
    "avg_growth_k", "avg_growth_km1", "peak_growth_k", "peak_growth_km1",
    "avg_over_peak_k", "avg_over_peak_km1",
    "log_avg_k", "log_peak_k",
    "trend3_log_avg", "trend3_log_peak",
    "curv_log_avg", "curv_log_peak",
    "vol3_log_avg", "vol3_log_peak",
    "shock_log_peak_avg",
)
STATIC_FEATURES = ("is_free", "price_usd", "age_months", "age_since_release_months")
NUMERIC_FEATURES = SHAPE_FEATURES + STATIC_FEATURES
