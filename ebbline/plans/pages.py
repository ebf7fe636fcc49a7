"""From tables of raw list pages and activity pages to ids and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import TRAILING_WINDOW_LABEL
from ebbline.functions.html import activity_rows, anchor_ids, page_ids
from ebbline.functions.text import strip
from ebbline.params import MONTHS_KEPT

OUTCOMES = ("ok", "not_found", "no_table", "error")


def _exploded(pages: DataFrame, ids: Column) -> DataFrame:
    return pages.select(F.explode(ids).alias("app_id")).select(F.col("app_id").cast("long").alias("app_id"))


def list_page_ids(pages: DataFrame) -> DataFrame:
    """Ids linked from list pages, strict form. Duplicates are kept for the union to drop."""
    return _exploded(pages, anchor_ids(F.col("html")))


def sweep(pages: DataFrame, ids: Column) -> DataFrame:
    """Pages before the first readable page that yields no id.

    ``pages(page_no, html, fetch_error)``: a page that could not be fetched is
    skipped and does not end the sweep.
    """
    readable = pages.filter(F.col("fetch_error").isNull())
    first_empty = readable.filter(F.size(ids) == 0).agg(F.min("page_no").alias("first_empty")).scalar()
    return readable.filter(first_empty.isNull() | (F.col("page_no") < first_empty))


def page_link_ids(pages: DataFrame) -> DataFrame:
    """Ids of search pages, each once per page."""
    return _exploded(pages, page_ids(F.col("html")))


def sweep_ids(pages: DataFrame) -> DataFrame:
    return page_link_ids(sweep(pages, page_ids(F.col("html"))))


def candidate_ids(*sources: DataFrame) -> DataFrame:
    """Distinct ids over all sources."""
    union = sources[0].select("app_id")
    for source in sources[1:]:
        union = union.unionByName(source.select("app_id"))
    return union.distinct()


def parse_pages(pages: DataFrame) -> DataFrame:
    """Outcome and activity rows per fetched page.

    ``pages(app_id, url, html, status_code, error, scraped_utc)`` gives the same
    columns without ``html``, with ``status`` and ``rows``.
    """
    rows = activity_rows(F.col("html"))
    status = (
        F.when(F.col("status_code") == 404, "not_found")
        .when(F.col("html").isNull(), "error")
        .when(F.size("rows") == 0, "no_table")
        .otherwise("ok")
    )
    found = F.when(~F.col("status_code").eqNullSafe(404), rows)
    # Out of an array of one: filters on the outcome are not pushed below, where the page would be parsed for each of them again.
    parsed = pages.select("*", F.explode_outer(F.array(found)).alias("rows"))
    return parsed.select(
        "app_id",
        status.alias("status"),
        "scraped_utc",
        "url",
        F.when(status != "ok", F.col("status_code")).alias("status_code"),
        F.when(status == "error", F.coalesce("error", F.lit("fetch_failed"))).alias("error"),
        "rows",
    )


def _is_trailing(row: Column) -> Column:
    return F.lower(strip(row["label"])) == TRAILING_WINDOW_LABEL


def wide_metrics(parsed: DataFrame, months: int = MONTHS_KEPT) -> DataFrame:
    """One wide record per page: the trailing window and the newest ``months`` rows.

    The rows are already together in an array, so no pivot and no shuffle is needed.
    """
    trailing = F.get(F.filter("rows", _is_trailing), 0)
    split = parsed.withColumn("_trailing", trailing).withColumn(
        "_months", F.filter("rows", lambda r: ~F.coalesce(_is_trailing(r), F.lit(False)))
    )
    columns = [
        F.col("_trailing.avg_players").alias("last30_avg_players"),
        F.col("_trailing.peak_players").alias("last30_peak_players"),
    ]
    for i in range(1, months + 1):
        row = F.get("_months", i - 1)
        columns += [
            row["label"].alias(f"month{i}_label"),
            row["avg_players"].alias(f"month{i}_avg_players"),
            row["peak_players"].alias(f"month{i}_peak_players"),
        ]
    return split.select("app_id", "status", "scraped_utc", "url", "status_code", "error", *columns)


def finished_ids(outcomes: DataFrame) -> DataFrame:
    """Ids that need no further fetch: every outcome but an error is final."""
    return outcomes.filter("status <> 'error'").select("app_id").dropna().distinct()


def counters() -> list[Column]:
    """Processed, and one count per outcome."""
    return [F.count("*").alias("processed"), *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in OUTCOMES]]


def run_counters(outcomes: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """One row: the counters and, of the ids asked for, how many are still pending."""
    row = outcomes.agg(*counters())
    if wanted is None:
        return row
    return row.withColumn("pending", pending_ids(wanted, outcomes).agg(F.count("*")).scalar())


def ok_ids(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("status = 'ok'").select("app_id").dropna().distinct()


def failure_log(outcomes: DataFrame, stage: str) -> DataFrame:
    return outcomes.filter("status = 'error'").select(
        F.col("scraped_utc").alias("utc"), "app_id", F.lit(stage).alias("stage"), "error"
    )


def pending_ids(candidates: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ids still to do: without a page, or with errors only. By key, so ids that appear between two runs shift nothing."""
    return candidates.select("app_id").dropna().distinct().join(finished_ids(outcomes), "app_id", "left_anti")
