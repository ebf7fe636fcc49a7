"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline import jobs, params, schemas
from ebbline.catalog import bind
from ebbline.functions import dates, html, series, text
from ebbline.operators.checks import column_report, duplicate_keys, orphans
from ebbline.operators.dedup import last_in_order, latest
from ebbline.operators.split import apply_split, group_split, sample_ids
from ebbline.plans import boosting, charts, evaluate, marts, metadata, pages, panel, scoring, training, warehouse
from ebbline.session import new_path
from ebbline.sources import readers, tables, writers
from ebbline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WORD = r"""[^"'\s>/]+"""
LOWER_WORD = "[a-z]{2,}"
PANEL_KEY = ("app_id", "k_index")


def query(function: Query, name: str | None = None) -> Query:
    QUERIES[name or function.__name__] = function
    return function


def query_as(name: str) -> Callable[[Query], Query]:
    """Register under a name that a module here already has."""
    return lambda function: query(function, name)


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (without negative zero) and dates as text, so two engines print alike.

    A shift far below the last digit moves exact halves off the rounding boundary:
    a sum in another order may miss them by one bit.
    """

    def column(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "double":
            value = value + 0.03 * 10**-digits
            return F.when(F.abs(value) < 0.5 * 10**-digits, 0.0).otherwise(F.round(value, digits)).alias(name)
        if kind == "date":
            return value.cast("string").alias(name)
        return value

    return df.select(*[column(n, k) for n, k in df.dtypes])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: for plans that read them more than once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- sources and sinks -------------------------------------------------------


@query
def scan_ids(spark, sf):
    path = new_path(spark, "ids")
    raw = bind.table(spark, sf, "lineitem").select(F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("app_id"))
    writers.write_ids(raw, path)
    return readers.read_ids(spark, path)


@query
def load_staging(spark, sf):
    path = new_path(spark, "monthly-csv")
    writers.write_csv(bind.monthly_long(spark, sf), path)
    return shown(readers.read_monthly_long(spark, path))


def _stored_parts(spark, sf) -> str:
    """Ragged parts: usable pages with all columns, the others without metrics."""
    path = new_path(spark, "metrics-parts")
    wide = stored(pages.wide_metrics(pages.parse_pages(bind.activity_pages(spark, sf))), "wide")
    writers.write_parts(wide.filter("status = 'ok'").drop("status_code", "error"), path)
    failed = wide.filter("status <> 'ok'").select("app_id", "status", "scraped_utc", "url", "status_code", "error")
    writers.write_parts(failed, path)
    return path


@query
def scan_parts(spark, sf):
    return shown(readers.read_parts(spark, _stored_parts(spark, sf), schemas.METRICS_WIDE))


@query
def compact_parts(spark, sf):
    source, target = _stored_parts(spark, sf), new_path(spark, "metrics-merged")
    writers.compact_parts(spark, source, target)
    return shown(readers.read_parts(spark, target, schemas.METRICS_WIDE))


@query
def prep_meta(spark, sf):
    now = bind.metadata(spark, sf).withColumn("release_date_str", F.concat(F.lit("\t"), "release_date_str", F.lit("\r\n")))
    older = now.withColumn("scraped_utc", F.lit("2023-01-01T00:00:00+00:00")).withColumn("price_usd", F.col("price_usd") + 1)
    failed = now.withColumn("status", F.lit("error")).withColumn("scraped_utc", F.lit("2025-01-01T00:00:00+00:00"))
    path = new_path(spark, "metadata-csv")
    writers.write_csv(metadata.load_format(now.unionByName(older).unionByName(failed)), path)
    back = readers.read_metadata_landing(spark, path)
    return back.select(
        text.to_int(F.col("app_id")).cast("long").alias("app_id"), "is_free",
        F.round(text.to_number(F.col("price_usd")), 6).alias("price_usd"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("release_date_str", "genres_csv", "categories_csv", "scraped_utc")],
    )


# --- pages and documents -----------------------------------------------------


@query
def extract_links(spark, sf):
    raw = bind.table(spark, sf, "pages")
    return raw.select("page_id", F.explode(html.anchor_ids(F.col("html"), "/", WORD)).alias("link"))


@query
def extract_links_union(spark, sf):
    found = pages.page_link_ids(bind.shop_pages(spark, sf))
    return found.groupBy("app_id").agg(F.count("*").alias("n_pages"))


@query
def sweep_until_empty(spark, sf):
    ids = html.anchor_ids(F.col("html"), "/", LOWER_WORD)
    return pages.sweep(bind.sweep_pages(spark, sf), ids).select("page_no", F.size(ids).alias("n_ids"))


@query
def candidate_ids(spark, sf):
    shop = pages.page_link_ids(bind.shop_pages(spark, sf))
    return pages.candidate_ids(pages.list_page_ids(bind.list_pages(spark, sf)), shop)


def _wanted(spark, sf) -> DataFrame:
    """Ids that were asked for: some never get a page."""
    parts = bind.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("app_id"))
    return pages.candidate_ids(parts, bind.table(spark, sf, "orders").select(F.col("o_custkey").alias("app_id")))


def _parsed(spark, sf) -> DataFrame:
    return pages.parse_pages(bind.activity_pages(spark, sf))


@query
def parse_month_table(spark, sf):
    # The outer form, since Spark lets the plain one filter pages by a parse of its own.
    rows = _parsed(spark, sf).select("app_id", F.posexplode_outer("rows").alias("position", "r")).filter("position is not null")
    return shown(rows.select("app_id", "position", "r.label", "r.avg_players", "r.peak_players"))


@query
def wide_metrics(spark, sf):
    wide = pages.wide_metrics(_parsed(spark, sf))
    return shown(wide.filter("status = 'ok'").drop("status", "status_code", "error"))


@query
def classify_outcome(spark, sf):
    return _parsed(spark, sf).select("app_id", "status", "status_code", "error")


@query
def run_counters(spark, sf):
    return pages.run_counters(stored(_parsed(spark, sf), "parsed"), _wanted(spark, sf))


@query
def ok_ids(spark, sf):
    return pages.ok_ids(_parsed(spark, sf))


@query
def failure_log(spark, sf):
    return pages.failure_log(metadata.parse_documents(bind.documents(spark, sf)), "fetch_or_parse")


@query_as("sample_ids")
def sample_id_order(spark, sf):
    return sample_ids(bind.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("app_id")))


@query
def pending_ids(spark, sf):
    return pages.pending_ids(_wanted(spark, sf), _parsed(spark, sf))


@query
def parse_meta(spark, sf):
    parsed = metadata.parse_documents(bind.documents(spark, sf))
    return shown(
        parsed.withColumn("genres", text.pipe_join(F.col("genres"))).withColumn("categories", text.pipe_join(F.col("categories")))
    )


# --- cleaning and typing -----------------------------------------------------


@query
def to_float(spark, sf):
    price = F.col("l_extendedprice")
    raw = (
        F.when(F.col("l_returnflag") == "R", F.format_number(price, 2))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), price.cast("string"), F.lit("\n")))
        .when(F.col("l_tax") == 0, "")
        .when(F.col("l_tax") > 0.06, "n/a")
        .otherwise("-")
    )
    rows = bind.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", text.to_number(raw).alias("value"))
    return shown(rows)


@query
def norm_bool(spark, sf):
    raw = bind.table(spark, sf, "part").select(F.col("p_partkey").alias("app_id"), bind.bool_text().alias("raw"))
    return raw.select("app_id", text.bool_label(F.col("raw")).alias("label"), text.bool_flag(F.col("raw")).alias("flag"))


@query
def typed_meta(spark, sf):
    return shown(warehouse.typed_metadata(bind.landing(spark, sf)))


@query
def parse_list_field(spark, sf):
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    raw = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit(" ['"), first, F.lit("' '"), second, F.lit(" ']")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("["), first, F.lit(", ,"), second, F.lit("]")))
        .when(F.col("p_type") == "MEDIUM", F.concat(first, F.lit("| "), second, F.lit(", "), "p_brand"))
        .when(F.col("p_type") == "PROMO", F.col("p_name"))
        .when(F.col("p_type") == "SMALL", "  ")
    )
    items = text.parse_list(raw)
    return bind.table(spark, sf, "part").select(
        F.col("p_partkey").alias("app_id"), F.size(items).alias("n_items"), text.pipe_join(items).alias("items")
    )


@query
def dedup_latest(spark, sf):
    events = bind.table(spark, sf, "events").withColumn("scraped_utc", F.date_format("ts", bind.ISO_FORMAT))
    return shown(latest(events.drop("ts"), ["user_id"], ["scraped_utc"], ["event_id"]))


@query
def dedup_file_order(spark, sf):
    """Events in two folders of parts: the last row of a user in file order stays, though an earlier file may hold a newer one."""
    root, events = new_path(spark, "ordered-parts"), bind.table(spark, sf, "events")
    for folder, rows in enumerate((events.filter("value >= 50 or value is null"), events.filter("value < 50"))):
        parts = rows.withColumn("scraped_utc", F.date_format("ts", bind.ISO_FORMAT)).drop("ts")
        parts.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.parquet(f"{root}/part_{folder:06d}")
    schema = "event_id long, user_id long, event_type string, value double, props string, scraped_utc string"
    rows = readers.read_parts_in_order(spark, f"{root}/*", schema)
    return shown(last_in_order(rows, ["user_id"], readers.FILE_ORDER))


@query
def required_columns(spark, sf):
    """What the given tables lack of the columns that the steps require."""
    wanted = {"part": ("p_partkey", "app_id"), "lineitem": ("l_partkey", "l_shipdate"), "events": ("ts", "scraped_utc", "status"), "documents": ("doc_id", "text")}
    reports = [column_report(bind.table(spark, sf, name), columns, name) for name, columns in wanted.items()]
    return reduce(DataFrame.unionByName, reports)


@query
def price_tier(spark, sf):
    rows = bind.metadata(spark, sf)
    return rows.select("app_id", warehouse.price_tier(F.col("is_free"), F.col("price_usd")).alias("price_tier"))


@query
def parse_release(spark, sf):
    rows = bind.metadata(spark, sf)
    raw = F.col("release_date_str")
    return shown(
        rows.select("app_id", raw, dates.parse_date(raw).alias("release_date"), dates.parse_release_month(raw).alias("release_month"))
    )


@query
def parse_month(spark, sf):
    label = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MMMM yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", " MMM yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy/MM"))
        .otherwise("Last 30 Days")
    )
    counts = bind.table(spark, sf, "orders").groupBy(label.alias("label")).agg(F.count("*").alias("n_rows"))
    month = dates.parse_month(F.col("label"))
    return shown(counts.select("label", "n_rows", month.alias("month"), F.year(month).alias("year_num"), F.month(month).alias("month_num")))


@query
def months_since_release(spark, sf):
    """Months from order to shipment. Orders have few columns; shipments are counted per order and month first."""
    shipped = (
        bind.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", F.trunc(F.col("l_shipdate"), "MM").alias("ship_month"))
        .agg(F.count("*").alias("n"))
    )
    orders = bind.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    joined = shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    age = dates.months_between(F.col("ordered"), F.col("ship_month"))
    return joined.groupBy(age.alias("months")).agg(F.sum("n").alias("n_rows"))


@query
def norm_tag_sql(spark, sf):
    tags = bind.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("tag")).agg(F.count("*").alias("n_rows"))
    texts = bind.table(spark, sf, "documents").groupBy(F.col("text").alias("tag")).agg(F.count("*").alias("n_rows"))
    norm = text.warehouse_norm(F.col("tag"))
    return tags.unionByName(texts).select(F.md5("tag").alias("tag_key"), F.md5(norm).alias("norm_key"), F.length(norm).alias("n_chars"), "n_rows")


@query
def norm_tag_score(spark, sf):
    """Comma items of whole texts by their scoring key; the items are counted before anything is compared."""
    items = F.explode(text.comma_items(F.col("text")))
    texts = bind.table(spark, sf, "documents").select(items.alias("tag"))
    return (
        texts.groupBy(text.scoring_norm(F.col("tag")).alias("norm"))
        .agg(F.count("*").alias("n_rows"))
        .select(F.md5("norm").alias("norm_key"), F.length("norm").alias("n_chars"), "n_rows")
    )


@query
def safe_log(spark, sf):
    rows = bind.table(spark, sf, "lineitem").groupBy("l_tax", "l_discount").agg(F.count("*").alias("n_rows"))
    return shown(rows.select("l_tax", "l_discount", "n_rows", text.safe_log(F.col("l_tax") - F.col("l_discount")).alias("log_value")))


@query
def finite_values(spark, sf):
    """Prices as numbers that are not all finite: per part how many count, and their sum."""
    price = (
        F.when(F.col("l_tax") == 0, F.lit(float("inf")))
        .when(F.col("l_tax") == 0.01, F.lit(float("-inf")))
        .when(F.col("l_discount") == 0, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
    )
    rows = bind.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("app_id"))
    value = text.finite(price)
    return shown(rows.agg(F.count("*").alias("n_rows"), F.count(value).alias("n_finite"), F.sum(value).alias("total")), 3)


# --- panel -------------------------------------------------------------------


def _joined(spark, sf, wide: DataFrame | None = None) -> DataFrame:
    return panel.metrics_with_metadata(bind.metrics_wide(spark, sf) if wide is None else wide, bind.metadata(spark, sf))


def _panel(spark, sf) -> DataFrame:
    return panel.build_panel(_joined(spark, sf))


@query
def metrics_with_meta(spark, sf):
    lists = {c: text.pipe_join(F.col(c)) for c in ("genres", "categories")}
    return shown(_joined(spark, sf).withColumns(lists))


@query
def unpivot_months(spark, sf):
    return shown(panel.unpivot_months(bind.metrics_wide(spark, sf)).drop("url", "scraped_utc"))


@query
def chrono_series(spark, sf):
    return shown(panel.chrono_series(bind.metrics_wide(spark, sf)))


@query
def min_history(spark, sf):
    return panel.with_history(bind.metrics_wide(spark, sf)).select("app_id", F.size("series").alias("n_valid"))


@query_as("panel")
def panel_rows(spark, sf):
    return shown(_panel(spark, sf).drop("genres", "categories"))


@query
def panel_null_rate(spark, sf):
    rows = _panel(spark, sf)
    by_target = panel.null_rate(rows).withColumn("column_name", F.lit("y_log_avg"))
    return shown(by_target.unionByName(panel.null_rate(rows, "age_since_release_months").withColumn("column_name", F.lit("age_since_release_months"))))


@query
def tag_topk(spark, sf):
    return panel.tag_vocabulary(_joined(spark, sf))


@query
def tag_topk_narrow(spark, sf):
    """A narrower vocabulary, as a table on its own: written as one file and read back."""
    path = new_path(spark, "vocabulary")
    panel.tag_vocabulary(_joined(spark, sf), 10, 40).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@query
def panel_multihot(spark, sf):
    """The 0/1 columns of each panel row, written side by side in vocabulary order."""
    joined = stored(_joined(spark, sf), "joined")
    words = panel.collect_vocabulary(panel.tag_vocabulary(joined))
    hot = panel.multihot_columns(panel.build_panel(joined), words)

    def digits(prefix: str) -> Column:
        names = [c for c in hot.columns if c.startswith(prefix)]
        return F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in names])

    return hot.select(*PANEL_KEY, digits("genre_").alias("genre_hot"), digits("cat_").alias("category_hot"))


# --- warehouse ---------------------------------------------------------------


def _typed(spark, sf) -> DataFrame:
    return warehouse.typed_metadata(bind.landing(spark, sf))


def _star(spark, sf) -> dict[str, DataFrame]:
    """The star, each table stored once as a load stores it."""
    return warehouse.build_star(_typed(spark, sf), bind.monthly_long(spark, sf), None, lambda name, table: stored(table, name))


def _facts(spark, sf, monthly: DataFrame, old: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The part of the star that carries the facts: apps, calendar, facts."""
    old = old or {}
    typed = stored(warehouse.latest_metadata(_typed(spark, sf)), "typed")
    monthly = stored(warehouse.latest_months(monthly), "monthly")
    apps = stored(warehouse.upsert_apps(old.get("dim_app"), typed), "dim_app")
    calendar = stored(warehouse.upsert_dates(old.get("dim_date"), monthly), "dim_date")
    fact = warehouse.upsert_fact(old.get("fact_monthly"), warehouse.fact_rows(monthly, apps, calendar))
    return {"dim_app": apps, "dim_date": calendar, "fact_monthly": fact}


def _repeated(typed: DataFrame) -> DataFrame:
    """Metadata with an older, dearer row beside that of each cheap app: the older ones must not count."""
    fresh = typed.withColumn("scraped_utc", F.lit(bind.METADATA_UTC))
    older = fresh.filter("price_usd < 50").withColumns(
        {"price_usd": F.col("price_usd") + 9, "scraped_utc": F.lit("2023-01-01T00:00:00+00:00")}
    )
    return fresh.unionByName(older)


def _repeated_months(monthly: DataFrame) -> DataFrame:
    """Months with an older row beside each of the first three, and the rows of the first month twice."""
    older = monthly.filter("month_index <= 3").withColumns(
        {"avg_players": F.col("avg_players") + 7, "scraped_utc": F.lit("1970-01-01T00:00:00+00:00")}
    )
    return monthly.unionByName(older).unionByName(monthly.filter("month_index = 1"))


@query
def dim_date(spark, sf):
    return shown(warehouse.upsert_dates(None, bind.monthly_long(spark, sf)))


@query
def dim_tags(spark, sf):
    items = warehouse.tag_items(_typed(spark, sf))
    dims = [
        warehouse.upsert_tags(None, items, k).toDF("tag_sk", "tag_name", "tag_norm").withColumn("kind", F.lit(k))
        for k in ("genre", "category")
    ]
    return dims[0].unionByName(dims[1])


@query
def dim_app_upsert(spark, sf):
    """Load the cheap half of the apps at another price, then upsert all of them, from staging that repeats ids."""
    typed = warehouse.latest_metadata(_repeated(_typed(spark, sf)))
    first = typed.filter("price_usd < 50").withColumn("price_usd", F.col("price_usd") + 5)
    return shown(warehouse.upsert_apps(warehouse.upsert_apps(None, first), typed))


@query
def bridge_tags(spark, sf):
    """Load the pairs of the apps that have a release text, then insert those of all apps."""
    typed = stored(_typed(spark, sf), "typed")
    apps, items = stored(warehouse.upsert_apps(None, typed), "dim_app"), stored(warehouse.tag_items(typed), "items")
    early = warehouse.tag_items(typed.filter("release_date_str is not null"))
    found = []
    for kind in ("genre", "category"):
        tags = stored(warehouse.upsert_tags(None, items, kind), "tags")
        keys = ["app_sk", f"{kind}_sk"]
        bridge = tables.bucketed_table(spark, new_path(spark, "bridge"), schemas.bridge(kind), keys)
        tables.append_bucketed(warehouse.new_pairs(None, early, apps, tags, kind).select(*keys), bridge, keys)
        added = stored(warehouse.new_pairs(spark.table(bridge), items, apps, tags, kind).select(*keys), "new-pairs")
        tables.append_bucketed(added, bridge, keys)
        found.append(spark.table(bridge).toDF("app_sk", "tag_sk").withColumn("kind", F.lit(kind)))
    return found[0].unionByName(found[1])


@query
def fact_monthly(spark, sf):
    return shown(_facts(spark, sf, bind.monthly_long(spark, sf))["fact_monthly"])


@query
def fact_upsert(spark, sf):
    """An older load from month 4 on, then a reload of months 1 to 6, from staging that repeats months."""
    monthly = stored(warehouse.latest_months(_repeated_months(bind.monthly_long(spark, sf))), "monthly")
    apps = stored(warehouse.upsert_apps(None, _typed(spark, sf)), "dim_app")
    calendar = stored(warehouse.upsert_dates(None, monthly), "dim_date")
    old = monthly.filter("month_index >= 4").withColumn("avg_players", F.col("avg_players") + 100)
    unlabelled = old.filter("month_index = 5").withColumn("month_label", F.lit(None).cast("string"))  # matches no month
    fact = warehouse.fact_rows(old.unionByName(unlabelled), apps, calendar)
    return shown(warehouse.upsert_fact(fact, warehouse.fact_rows(monthly.filter("month_index <= 6"), apps, calendar)))


@query
def check_keys(spark, sf):
    """Violated keys: of a sound star none, of one with repeated apps and months without a key those, and of the raw shipments."""
    star = _star(spark, sf)
    apps, fact = star["dim_app"], star["fact_monthly"]
    broken = star | {
        "dim_app": apps.unionByName(apps.filter("price_tier = 'Free'")),
        "fact_monthly": fact.withColumn("date_sk", F.when(F.col("peak_players") > 0, F.col("date_sk"))),
    }
    raw = duplicate_keys(bind.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "unique lineitem")
    sound = warehouse.check_keys(star).withColumn("check_name", F.concat(F.lit("sound star: "), "check_name"))
    return warehouse.check_keys(broken).unionByName(sound).unionByName(raw)


@query
def check_refs(spark, sf):
    """Missing parents: of a sound star none, of one that lost a month and the dear apps those, and of the raw tables."""
    customers = bind.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    raw = orphans(bind.table(spark, sf, "orders"), customers, "o_custkey", "orders -> customer in credit")
    star = _star(spark, sf)
    broken = star | {"dim_date": star["dim_date"].filter("month_index <> 5"), "dim_app": star["dim_app"].filter("price_tier <> '60_plus'")}
    sound = warehouse.check_references(star).withColumn("check_name", F.concat(F.lit("sound star: "), "check_name"))
    return warehouse.check_references(broken).unionByName(sound).unionByName(raw)


# --- marts and charts --------------------------------------------------------


def _persistence(spark, sf) -> DataFrame:
    return marts.app_persistence(bind.monthly_long(spark, sf), warehouse.upsert_apps(None, _typed(spark, sf)))


def _tag_mart(spark, sf, kind: str) -> DataFrame:
    typed = _typed(spark, sf)
    apps, items = stored(warehouse.upsert_apps(None, typed), "dim_app"), warehouse.tag_items(typed, (kind,))
    tags = stored(warehouse.upsert_tags(None, items, kind), "dim_tag")
    bridge = stored(warehouse.insert_bridge(None, items, apps, tags, kind), "bridge")
    return marts.tag_retention(marts.app_persistence(bind.monthly_long(spark, sf), apps), bridge, tags, kind)


@query
def mart_app_persistence(spark, sf):
    return shown(_persistence(spark, sf))


@query
def mart_persistence_two_loads(spark, sf):
    """A load without each app's newest month, then the whole one on top: the marts must read the newest months."""
    monthly = stored(bind.monthly_long(spark, sf), "monthly-long")
    before = monthly.filter("month_index > 1").withColumn("month_index", F.col("month_index") - 1)
    first = _facts(spark, sf, before)
    first["fact_monthly"] = stored(first["fact_monthly"], "fact")
    star = _facts(spark, sf, monthly, first)
    rows = warehouse.activity(star["fact_monthly"], star["dim_app"], star["dim_date"])
    return shown(marts.app_persistence(rows, star["dim_app"]).drop("app_sk"))


@query
def mart_persistence_gaps(spark, sf):
    """Two loads with gaps: the second lacks the months 2 to 8 of each app, so the past month is known from the first one, where
    it stands at another index; months without a peak are in neither."""
    monthly = bind.monthly_long(spark, sf).filter("month_index = 1 or peak_players > 0")
    before = monthly.filter("month_index > 1").withColumn("month_index", F.col("month_index") - 1)
    first = _facts(spark, sf, before)
    first["fact_monthly"] = stored(first["fact_monthly"], "fact")
    star = _facts(spark, sf, monthly.filter("month_index not between 2 and 8"), first)
    rows = warehouse.activity(star["fact_monthly"], star["dim_app"], star["dim_date"])
    return shown(marts.app_persistence(rows, star["dim_app"]).drop("app_sk"))


@query
def mart_view(spark, sf):
    """A mart by SQL over the registered views."""
    jobs.register_views(_star(spark, sf))
    return shown(spark.sql("select * from v_price_tier_retention"))


@query
def mart_export(spark, sf):
    """A mart as it is read back from its CSV export."""
    path = new_path(spark, "marts")
    jobs.export_marts(_star(spark, sf), path)
    columns = "app_id int, price_tier string, is_free boolean, avg_players_recent double, avg_players_6mo_ago double, persistence_6m_ratio double, trend_bucket string, abs_log_change double"
    return shown(spark.read.options(**readers.CSV_OPTIONS).schema(columns).csv(f"{path}/growth_decay"))


@query
def mart_decay_curve(spark, sf):
    return shown(marts.decay_curve(bind.monthly_long(spark, sf)))


@query
def mart_genre_retention(spark, sf):
    return shown(_tag_mart(spark, sf, "genre"))


@query
def mart_category_retention(spark, sf):
    return shown(_tag_mart(spark, sf, "category"))


@query
def mart_price_tier(spark, sf):
    return shown(marts.price_tier_retention(_persistence(spark, sf)))


@query
def mart_growth_decay(spark, sf):
    return shown(marts.growth_decay(_persistence(spark, sf)))


@query
def mart_star_decay(spark, sf):
    """The decay curve through the star: fact joined back to its dimensions."""
    star = _facts(spark, sf, bind.monthly_long(spark, sf))
    return shown(marts.decay_curve(warehouse.activity(star["fact_monthly"], star["dim_app"], star["dim_date"])))


@query
def life_cycle_chart(spark, sf):
    return shown(charts.life_cycle(marts.decay_curve(bind.monthly_long(spark, sf))))


@query
def price_range_chart(spark, sf):
    return shown(charts.price_range(marts.price_tier_retention(_persistence(spark, sf))))


@query
def top10_genre(spark, sf):
    return shown(charts.top_groups(_tag_mart(spark, sf, "genre"), "genre_name"))


@query
def top10_category(spark, sf):
    return shown(charts.top_groups(_tag_mart(spark, sf, "category"), "category_name"))


@query
def top_changes(spark, sf):
    return shown(charts.ranked_changes(marts.growth_decay(_persistence(spark, sf))))


@query
def decay_curve_measures(spark, sf):
    return shown(marts.curve_measures(stored(bind.monthly_long(spark, sf), "monthly")), 4)


@query
def scatter_excluding(spark, sf):
    """All points but the ten largest changes of each bucket."""
    points = marts.growth_decay(_persistence(spark, sf))
    return shown(charts.excluding(points, charts.ranked_changes(points).select("trend_bucket", "app_id")))


@query
def scatter_trend(spark, sf):
    return shown(charts.trend_lines(marts.growth_decay(_persistence(spark, sf))))


# --- modelling ---------------------------------------------------------------


def _rows(spark, sf) -> DataFrame:
    return training.model_rows(_panel(spark, sf))


def _stored_rows(spark, sf, *columns: str) -> DataFrame:
    return stored(_rows(spark, sf).select(*columns), "model-rows")


def _predictions(spark, sf) -> DataFrame:
    """A fixed stand-in forecast: half of the recent trend, with a band of 0.3."""
    middle = 0.5 * F.col("trend3_log_avg")
    return _rows(spark, sf).withColumns({"delta_q10": middle - 0.3, "delta_q50": middle, "delta_q90": middle + 0.3})


@query
def model_rows(spark, sf):
    return shown(_rows(spark, sf).select(*PANEL_KEY, "y_log_avg", "base_log", "delta"))


@query_as("group_split")
def entity_split(spark, sf):
    return group_split(stored(_rows(spark, sf).select("app_id").distinct(), "model-ids"))


@query
def split_rows(spark, sf):
    """Rows per side under a saved split that lists only some entities: the others train."""
    rows = _stored_rows(spark, sf, "app_id", "is_free")
    saved = group_split(rows.filter("is_free = 0"))
    sides = apply_split(rows, saved)
    return sides.groupBy("is_test").agg(F.count("*").alias("n_rows"), F.count_distinct("app_id").alias("n_entities"))


@query
def all_missing_cols(spark, sf):
    rows = _rows(spark, sf).withColumn("never_known", F.lit(None).cast("double"))
    return training.non_null_counts(rows, [*series.NUMERIC_FEATURES, "never_known"])


@query
def impute_medians(spark, sf):
    columns = list(series.NUMERIC_FEATURES)
    rows = _stored_rows(spark, sf, *columns)
    medians = training.fit_medians(rows, columns)
    filled = training.impute(rows, medians)
    sums = filled.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "mean_filled")
    fitted = spark.createDataFrame(list(medians.items()), "column_name string, median double")
    return shown(sums.join(F.broadcast(fitted), "column_name"))


@query
def sample_weights(spark, sf):
    return shown(training.weight_summary(_rows(spark, sf)))


@query
def eval_metrics(spark, sf):
    return shown(evaluate.metrics(_predictions(spark, sf)))


@query
def downtrend_slice(spark, sf):
    return shown(evaluate.downtrend_slice(_predictions(spark, sf)))


_MODELS: dict[tuple[str, str], boosting.QuantileModel] = {}


def _fitted(spark, sf, wide: DataFrame | None = None):
    """Model, training rows and held-out rows. Queries of one session over the same tables share one fit."""
    joined = stored(_joined(spark, sf, wide), "joined")
    train, held_out = boosting.sides(stored(panel.build_panel(joined), "panel"))
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        _MODELS[key] = boosting.learn(train, panel.collect_vocabulary(panel.tag_vocabulary(joined)))
    return _MODELS[key], train, held_out


@query
def quantile_forecast(spark, sf):
    model, _, held_out = _fitted(spark, sf)
    predicted = boosting.predict(held_out, model)
    forecasts = [(F.col("base_log") + F.col(f"delta_q{q}")).alias(f"yhat_log_q{q}") for q in (10, 50, 90)]
    return shown(predicted.select(*PANEL_KEY, "y_log_avg", "base_log", *forecasts))


SMALL_FIT = boosting.BoostingConfig(rounds=3, learning_rate=0.5, max_depth=2, min_leaf_rows=10, subsample=1.0)


@query
def small_fit(spark, sf):
    """Forecasts of a small model fitted to all rows: few values for each feature, so every split is tried, and no bags.

    The model is saved and loaded in between. Target and features are rounded and weights whole, so sums don't depend on their order.
    """
    trend = F.col("trend3_log_avg")
    features = {
        "k": F.col("k_index"), "free": F.col("is_free").cast("int"), "trend": F.greatest(F.lit(-8), F.least(F.lit(8), F.floor(4 * trend))),
        "load": F.floor(10 * F.col("avg_over_peak_k")),
    }
    rows = _rows(spark, sf).select(
        *PANEL_KEY, F.round("delta", 4).alias("delta"), F.when(trend < -0.05, 2.0).otherwise(1.0).alias("weight"),
        *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in features.items()],
    )
    rows = stored(rows, "small-rows")
    model = boosting.QuantileModel(list(features), dict.fromkeys(features, 0.0), {}, SMALL_FIT.learning_rate)
    vectors = boosting.feature_vector(rows, model).select(F.xxhash64(*PANEL_KEY).alias("row_hash"), "features", "delta", "weight")
    cuts = boosting.learned_thresholds(rows, model.features, SMALL_FIT.max_bins)
    model.start, model.trees = boosting.boost(stored(vectors, "small-vectors"), [cuts[c] for c in features], SMALL_FIT)
    path = new_path(spark, "small-model")
    boosting.save_model(spark, model, path)
    predicted = boosting.predict(rows, boosting.load_model(spark, path))
    return shown(predicted.select(*PANEL_KEY, "delta_q10", "delta_q50", "delta_q90"))


@query
def boost_invariants(spark, sf):
    """Of a fitted model, for each quantile: whether its start is that quantile of the weighted target, and whether the loss fell."""
    model, train, _ = _fitted(spark, sf)
    weight = training.sample_weight(F.col(params.DOWNTREND_FEATURE))
    rows = boosting.predict(train, model).withColumn("weight", weight)

    def loss(q: float, predicted: Column) -> Column:
        gap = F.col("delta") - predicted
        return F.sum(F.col("weight") * F.greatest(q * gap, (q - 1) * gap))

    sums, found = [F.count("*").alias("n_rows"), F.sum("weight").alias("sum_weight")], []
    for q, start in sorted(model.start.items()):
        own, wanted = boosting.column_name(q), q * F.col("sum_weight") * (1 - 1e-12)
        sums += [
            F.sum(F.when(F.col("delta") < start, F.col("weight")).otherwise(0.0)).alias(f"below_{own}"),
            F.sum(F.when(F.col("delta") <= start, F.col("weight")).otherwise(0.0)).alias(f"upto_{own}"),
            loss(q, F.col(own)).alias(f"loss_{own}"), loss(q, F.lit(start)).alias(f"first_{own}"),
        ]
        found.append(
            F.struct(
                F.lit(q).alias("quantile"), "n_rows", "sum_weight",
                ((F.col(f"below_{own}") < wanted) & (F.col(f"upto_{own}") >= wanted)).alias("start_is_quantile"),
                (F.col(f"loss_{own}") < F.col(f"first_{own}")).alias("loss_fell"),
            )
        )
    return shown(rows.agg(*sums).select(F.inline(F.array(*found))))  # all rows are forecast once


# --- scoring -----------------------------------------------------------------


def _vocabulary(spark, sf) -> dict[str, list[str]]:
    return panel.collect_vocabulary(panel.tag_vocabulary(_joined(spark, sf)))


@query
def score_validate(spark, sf):
    return scoring.validate(bind.score_input(spark, sf)).select("app_id", "row_error")


@query
def score_features(spark, sf):
    checked = scoring.validate(bind.score_input(spark, sf))
    features = scoring.feature_rows(checked, {"genre": [], "category": []})
    bare = features.select("app_id", *[F.col(f"f_{c}").alias(c) for c in series.NUMERIC_FEATURES])
    return shown(scoring.align(bare, ["app_id", *series.NUMERIC_FEATURES, "genre_absent"]))


@query
def score_multihot(spark, sf):
    words = _vocabulary(spark, sf)
    tagged = scoring.feature_rows(scoring.validate(bind.score_input(spark, sf)), words)
    joined = {k: text.pipe_join(F.array_sort(f"f_{f}")) for k, f in panel.TAG_FIELDS.items()}
    return tagged.select("app_id", joined["genre"].alias("genres_matched"), joined["category"].alias("categories_matched"))


@query
def score_forecast(spark, sf):
    wide = stored(bind.metrics_wide(spark, sf), "wide")  # of the panel and of the scoring rows
    model, _, _ = _fitted(spark, sf, wide)
    path, given = new_path(spark, "forecast-csv"), bind.score_input(spark, sf, wide)
    writers.write_csv(scoring.score(given, model), path)
    columns = ", ".join(f"{f.name} string" for f in given.schema.fields)
    forecasts = "pred_p10_players double, pred_p50_players double, pred_p90_players double, row_error string"
    return shown(spark.read.options(**readers.CSV_OPTIONS).schema(f"{columns}, {forecasts}").csv(path))


def _step(feature: int, threshold: float, left: float, right: float) -> dict:
    """A tree of one split."""
    return {"feature": [feature, -1, -1], "threshold": [threshold, 0.0, 0.0], "left": [1, 1, 2], "right": [2, 1, 2], "value": [0.0, left, right]}


def literal_model() -> boosting.QuantileModel:
    """A stated model, so that its forecasts can be stated in SQL too."""
    model = boosting.QuantileModel(["trend3_log_avg", "price_usd", "age_months"], {"trend3_log_avg": 0.0, "price_usd": 20.0, "age_months": 3.0}, {}, 0.5)
    model.start = {0.1: -0.4, 0.5: 0.0, 0.9: 0.4}
    model.trees = {q: [_step(0, 0.25, -0.2 - q, 0.3), _step(1, 30.0, 0.1, q), _step(2, 2.0, 9.0, -0.05)] for q in model.start}
    return model


@query
def score_literal_model(spark, sf):
    """Forecasts of a stated model that was saved and loaded."""
    path = new_path(spark, "literal-model")
    boosting.save_model(spark, literal_model(), path)
    scored = scoring.score(bind.score_input(spark, sf), boosting.load_model(spark, path))
    return shown(scored.select("app_id", "pred_p10_players", "pred_p50_players", "pred_p90_players", "row_error"))


@query
def score_csv(spark, sf):
    """The stated model's forecasts written as CSV, every input row with its columns and error, and read back."""
    path, given = new_path(spark, "literal-csv"), bind.score_input(spark, sf)
    writers.write_csv(scoring.score(given, literal_model()), path)
    columns = ", ".join(f"{f.name} string" for f in given.schema.fields)
    forecasts = "pred_p10_players double, pred_p50_players double, pred_p90_players double, row_error string"
    back = spark.read.options(**readers.CSV_OPTIONS).schema(f"{columns}, {forecasts}").csv(path)
    error = F.coalesce("row_error", F.lit(""))
    return shown(back.select(F.col("app_id").cast("long").alias("app_id"), "pred_p10_players", "pred_p50_players", "pred_p90_players", error.alias("row_error")))


@query
def train_summary(spark, sf):
    """Metrics of the stated model on the held-out panel rows, with the sizes that a training run reports."""
    rows = stored(_rows(spark, sf), "model-rows")
    sides = apply_split(rows, group_split(rows))
    summary = jobs.summarize(literal_model(), sides.filter("not is_test"), sides.filter("is_test"))
    return shown(summary.drop("quantiles", "crossing_rate"))


@query
def backtransform(spark, sf):
    rows = _rows(spark, sf)
    return shown(rows.select(*PANEL_KEY, scoring.back_transform(F.col("avg_k"), 0.9 * F.col("trend3_log_avg")).alias("forecast")))


# --- incremental -------------------------------------------------------------


@query
def stream_counters(spark, sf):
    """Rendered pages as arriving files, parsed in micro-batches; the counters of all batches."""
    source, root = new_path(spark, "page-files"), new_path(spark, "page-stream")
    bind.activity_pages(spark, sf).select(*[f.name for f in StructType.fromDDL(schemas.RAW_PAGES)]).write.parquet(source)
    return jobs.stream_metrics(spark, source, f"{root}/metrics", f"{root}/checkpoint", f"{root}/progress", 3)


@query
def resume_pages(spark, sf):
    """The job run twice: first only some pages are there; the second run takes up the other ids and what failed."""
    root = new_path(spark, "resumed")
    writers.write_ids(_wanted(spark, sf), f"{root}/ids")
    every = bind.activity_pages(spark, sf)
    jobs.pull_metrics(spark, every.filter("status_code = 200"), f"{root}/ids", f"{root}/metrics")
    return jobs.pull_metrics(spark, every, f"{root}/ids", f"{root}/metrics")


@query
def resume_stream(spark, sf):
    """A stream that stops and starts again after more files have arrived: every page is parsed once."""
    root, every = new_path(spark, "resumed-stream"), bind.activity_pages(spark, sf)
    columns = [f.name for f in StructType.fromDDL(schemas.RAW_PAGES)]
    counters = None
    for arrived in (every.filter("status_code = 200"), every.filter("not coalesce(status_code = 200, false)")):
        arrived.select(*columns).write.mode("append").parquet(f"{root}/pages")
        counters = jobs.stream_metrics(spark, f"{root}/pages", f"{root}/metrics", f"{root}/checkpoint", f"{root}/progress", 2)
    return counters


EVENT_KEYS = ["user_id", "event_type"]


def _event_files(spark, sf) -> str:
    """The events in a folder per day, the way increments arrive; a large day is several files."""
    path = new_path(spark, "event-days")
    days = bind.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    days.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return path


EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string, day date"


@query
def incremental_ingest(spark, sf):
    target, checkpoint = new_path(spark, "ingested"), new_path(spark, "ingest-progress")
    source = _event_files(spark, sf)
    stream = incremental.stream_files(spark, source, EVENT_SCHEMA, 10)
    incremental.ingest(stream, target, checkpoint)
    rows = incremental.read_ingested(spark, target, EVENT_KEYS, ["ts"], ["event_id"])
    return shown(rows.select(*EVENT_KEYS, "event_id", "props", "value"))


@query
def incremental_upsert(spark, sf):
    target, checkpoint = new_path(spark, "upserted"), new_path(spark, "upsert-progress")
    source = _event_files(spark, sf)
    stream = incremental.stream_files(spark, source, EVENT_SCHEMA, 10)
    incremental.upsert_batches(stream, target, checkpoint, EVENT_KEYS, ["ts"], ["event_id"])
    rows = incremental.read_upserted(spark, target, stream.schema, EVENT_KEYS)
    return shown(rows.select(*EVENT_KEYS, "event_id", "props", "value"))
