"""The given tables as inputs of the engine.

A part is an entity, its shipments per calendar month are its activity. All rules
read attribute values, never id arithmetic, and every row of a table takes part:
undiscounted months have no average (missing value), untaxed ones a peak of zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.operators.spread import ROWS_PER_TASK, spread
from ebbline.params import MONTHS_KEPT
from ebbline.schemas import MONTH_COLUMNS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
METADATA_UTC = "2024-01-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def monthly(spark: SparkSession, sf_dir: str, id_type: str = "long") -> DataFrame:
    """Activity per part and calendar month. A part has few shipments in a month, so rows are dealt out by part once and
    all that follows by part, windows and joins included, needs no other shuffle and has tasks of bounded size.

    The id gets its type here, below the shuffles: a later cast would hide that the
    rows are already partitioned by it.
    """
    shipped = table(spark, sf_dir, "lineitem")
    rows = shipped.select(
        F.col("l_partkey").cast(id_type).alias("app_id"), F.trunc(F.col("l_shipdate"), "MM").alias("month"),
        "l_discount", "l_quantity", "l_tax", "l_extendedprice", "l_shipdate",
    )
    return (
        spread(rows, "app_id", shipped.count(), ROWS_PER_TASK)
        .groupBy("app_id", "month")
        .agg(
            F.avg(F.when(F.col("l_discount") > 0, F.col("l_quantity"))).alias("avg_players"),
            F.max(F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).otherwise(0.0)).alias("peak_players"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


def numbered_months(spark: SparkSession, sf_dir: str, id_type: str = "long") -> DataFrame:
    """All observed months of each part, numbered from the newest."""
    order = Window.partitionBy("app_id").orderBy(F.desc("month"))
    return (
        monthly(spark, sf_dir, id_type)
        .withColumn("month_index", F.row_number().over(order))
        .withColumn("month_label", F.date_format("month", "MMMM yyyy"))
    )


def page_url() -> Column:
    return F.concat(F.lit("https://activity.example.org/app/"), F.col("app_id"), F.lit('?view="avg, peak"'))


def monthly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_months(spark, sf_dir, "int").select(
        "app_id",
        F.col("month_index").cast("int").alias("month_index"),
        "month_label",
        "avg_players",
        "peak_players",
        F.date_format("last_ship", ISO_FORMAT).alias("scraped_utc"),
        page_url().alias("url"),
    )


def _month_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part with all its months, newest first."""
    fields = F.struct("month_index", "month_label", "avg_players", "peak_players")
    return (
        numbered_months(spark, sf_dir)
        .groupBy("app_id")
        .agg(F.array_sort(F.collect_list(fields)).alias("months"), F.max("last_ship").alias("last_ship"))
    )


def metrics_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = []
    for i, (label, avg, peak) in enumerate(MONTH_COLUMNS):
        month = F.get("months", F.lit(i))
        columns += [
            month["month_label"].alias(label), month["avg_players"].alias(avg), month["peak_players"].alias(peak)
        ]
    return _month_array(spark, sf_dir).select(
        "app_id",
        F.lit("ok").alias("status"),
        F.date_format("last_ship", ISO_FORMAT).alias("scraped_utc"),
        page_url().alias("url"),
        F.lit(None).cast("int").alias("status_code"),
        F.lit(None).cast("string").alias("error"),
        *columns,
    )


def activity_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered activity pages of all months. Those with many zero peaks of late are 'not found', some fail, some have no table."""

    def line(label: Column, avg: Column, peak: Column) -> Column:
        cells = [label, avg, F.lit("+1.0"), F.lit("+0.5%"), peak]
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td> "), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))

    def month_line(m: Column) -> Column:
        avg = F.coalesce(m["avg_players"].cast("string"), F.lit("-"))
        return line(m["month_label"], avg, F.format_number(m["peak_players"], 2))

    months = F.array_join(F.transform("months", month_line), "")
    newest = F.get("months", F.lit(0))
    trailing = line(F.lit("Last 30 <b>Days</b>"), F.lit("1,234.5"), F.format_number(newest["peak_players"], 2))
    headers = "<tr><th>Month</th><th>Avg. Players</th><th>Gain</th><th>% Gain</th><th>Peak Players</th></tr>"
    html = F.concat(
        F.lit("<html><table class='nav'><tr><th>Menu</th></tr></table><TABLE id=\"monthly\">" + headers),
        trailing, months, F.lit("</TABLE></html>"),
    )
    late = F.slice("months", 1, MONTHS_KEPT)
    zeros = F.size(F.filter(late, lambda m: m["peak_players"] == 0))
    missing = F.size(F.filter(late, lambda m: m["avg_players"].isNull()))
    return _month_array(spark, sf_dir).select(
        "app_id",
        page_url().alias("url"),
        F.when((zeros >= 2) | (missing >= 3), None)
        .when((missing == 2), "<html><p>No data.</p></html>")
        .otherwise(html)
        .alias("html"),
        F.when(zeros >= 2, 404).when(missing >= 3, None).otherwise(200).alias("status_code"),
        F.when((zeros < 2) & (missing >= 3), "timeout").alias("error"),
        F.date_format("last_ship", ISO_FORMAT).alias("scraped_utc"),
    )


def release_text() -> Column:
    released = F.date_add(F.lit("1992-01-01").cast("date"), F.col("p_size") * 40 + F.floor("p_retailprice").cast("int"))
    kind = F.col("p_type")
    return (
        F.when(F.col("p_size") == 9, None)
        .when(kind.isin("ECONOMY", "STANDARD"), F.date_format(released, "d MMM, yyyy"))
        .when(kind == "LARGE", F.date_format(released, "MMM d, yyyy"))
        .when(kind == "MEDIUM", F.date_format(released, "MMM yyyy"))
        .when(kind == "PROMO", "Coming Soon")
        .otherwise("To be announced (TBA)")
    )


def price() -> Column:
    return F.when(F.col("p_size") != 7, F.round(F.col("p_retailprice") - 900, 2))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.lit("ok").alias("status"),
        F.lit(METADATA_UTC).alias("scraped_utc"),
        (F.col("p_type") == "PROMO").alias("is_free"),
        price().alias("price_usd"),
        release_text().alias("release_date_str"),
        F.split("p_name", " ").alias("genres"),
        F.array("p_type", "p_brand", F.concat(F.lit("Size-"), F.col("p_size"))).alias("categories"),
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as all-text rows, some with an unusable id."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return part.select(
        F.when(F.col("p_size") == 21, F.concat(key, F.lit(".5")))
        .when(F.col("p_size") == 22, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(F.col("p_size") == 23, "n/a")
        .otherwise(key)
        .alias("app_id"),
        bool_text().alias("is_free"),
        F.when(F.col("p_size") == 24, "free").otherwise(price().cast("string")).alias("price_usd"),
        F.coalesce(release_text(), F.lit("")).alias("release_date_str"),
        F.regexp_replace("p_name", " ", "|").alias("genres_csv"),
        F.concat_ws("|", "p_type", "p_brand", F.concat(F.lit(" Size-"), F.col("p_size"))).alias("categories_csv"),
        F.lit("").alias("scraped_utc"),
    )


def bool_text() -> Column:
    kind = F.col("p_type")
    return (
        F.when(kind == "ECONOMY", " yes ")
        .when(kind == "LARGE", "N")
        .when(kind == "MEDIUM", "True")
        .when(kind == "PROMO", "0")
        .when(kind == "STANDARD", F.col("p_brand"))
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as JSON payloads keyed by id; some without success, some cut off."""

    def named(x: Column) -> Column:
        return F.struct(x.alias("description"), F.lit("unused").alias("name"))

    def only_name(x: Column) -> Column:
        return F.struct(F.lit("").alias("description"), x.alias("name"))

    data = F.struct(
        (F.col("p_type") == "PROMO").alias("is_free"),
        F.struct(
            F.round(price() * 100).cast("long").alias("final"),
            F.when(F.col("p_brand") == "Brand#5", "EUR").otherwise("USD").alias("currency"),
        ).alias("price_overview"),
        F.struct(F.coalesce(release_text(), F.lit("")).alias("date")).alias("release_date"),
        F.transform(F.split("p_name", " "), named).alias("genres"),
        F.transform(F.array("p_type", F.lit(" "), F.concat(F.lit(" "), F.col("p_brand"))), only_name).alias("categories"),
    )
    payload = F.to_json(
        F.create_map(F.col("p_partkey").cast("string"), F.struct((F.col("p_size") != 13).alias("success"), data.alias("data")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.when(F.col("p_size") == 17, F.concat(F.lit('{"open": '), payload)).otherwise(payload).alias("payload"),
        F.lit(METADATA_UTC).alias("scraped_utc"),
    )


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered list page per order: a customer link, a deeper link and a stylesheet link."""
    key = F.col("o_custkey").cast("string")
    html = F.concat(
        F.lit('<html><link href="/app/999999999"><a class="x" href="/app/'), key,
        F.lit('">one</a><a href="/app/888888888/reviews">two</a></html>'),
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_no"), html.alias("html"))


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered search page per shipment: an item attribute and a long link; unshipped, untaxed ones are empty."""
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    html = F.concat(
        F.lit('<div data-ds-appid="'), part, F.lit('"><a href="https://shop.example.org/app/'), supplier,
        F.lit('/Some_Name/">item</a></div>'),
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", html.alias("html"))


def sweep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given raw pages as a sweep; pages behind plain http could not be fetched."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page_no"), "html", F.when(F.col("url").startswith("http://"), "503").alias("fetch_error")
    )


def score_input(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    """Scoring rows, as text: the three newest months of each part, oldest first, with its metadata. ``wide`` may be its stored months."""
    wide = metrics_wide(spark, sf_dir) if wide is None else wide
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.when(F.col("p_type") == "PROMO", "1").when(F.col("p_size") == 31, "maybe").otherwise("0").alias("is_free"),
        F.coalesce(price().cast("string"), F.lit("")).alias("price_usd"),
        F.regexp_replace("p_name", " ", " , ").alias("genres"),
        F.concat_ws(",", F.lower("p_type"), "p_brand", F.concat(F.lit("size_"), F.col("p_size"))).alias("categories"),
    )
    measures = [
        F.col(f"month{4 - i}_{name}_players").cast("string").alias(f"{name}_m{i}")
        for name in ("avg", "peak") for i in (1, 2, 3)
    ]
    return wide.select("app_id", *measures).join(part, "app_id")
