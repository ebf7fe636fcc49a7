"""Declared schemas of every stored table."""

from __future__ import annotations

from ebbline.params import MONTHS_KEPT

# The column names of the stored tables, here and below.
RAW_PAGES = "app_id long, url string, html string, status_code int, error string, scraped_utc string"

MONTH_COLUMNS = [
    (f"month{i}_label", f"month{i}_avg_players", f"month{i}_peak_players") for i in range(1, MONTHS_KEPT + 1)
]

METRICS_WIDE = (
    "app_id long, status string, scraped_utc string, url string, status_code int, error string, "
    "last30_avg_players double, last30_peak_players double, "
    + ", ".join(f"{label} string, {avg} double, {peak} double" for label, avg, peak in MONTH_COLUMNS)
)

METADATA = (
    "app_id long, status string, scraped_utc string, is_free boolean, price_usd double, "
    "release_date_str string, genres array<string>, categories array<string>, error string"
)

PAYLOAD = (
    "map<string, struct<success: boolean, data: struct<"
    "is_free: boolean, "
    "price_overview: struct<final: double, currency: string>, "
    "release_date: struct<date: string>, "
    "genres: array<struct<description: string, name: string>>, "
    "categories: array<struct<description: string, name: string>>>>>"
)

MONTHLY_LONG = (
    "app_id int, month_index int, month_label string, avg_players double, peak_players double, "
    "scraped_utc string, url string"
)

METADATA_LANDING = (
    "app_id string, is_free string, price_usd string, release_date_str string, "
    "genres_csv string, categories_csv string, scraped_utc string"
)

DIM_APP = (
    "app_sk long, app_id int, is_free boolean, price_usd double, price_tier string, "
    "release_date date, release_date_str string"
)
DIM_DATE = (
    "date_sk long, month_start_date date, year_num int, month_num int, month_label string, month_index int"
)
FACT_MONTHLY = "app_sk long, date_sk long, avg_players double, peak_players double, scraped_utc string"


def dim_tag(kind: str) -> str:
    return f"{kind}_sk long, {kind}_name string, {kind}_norm string"


def bridge(kind: str) -> str:
    return f"app_sk long, {kind}_sk long"


PREDICT_REQUIRED = ("avg_m1", "avg_m2", "avg_m3", "peak_m1", "peak_m2", "peak_m3", "is_free", "price_usd")
PREDICT_OPTIONAL = ("age_months", "age_since_release_months", "genres", "categories")
